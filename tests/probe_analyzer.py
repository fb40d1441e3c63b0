"""A probe analyzer factory for the U1 test: logs every load with the pid."""

import os


def probe_factory(log):
    with open(log, "a") as f:
        f.write(f"{os.getpid()}\n")
    return lambda texts: ["# sent_id = 1\n# text = x\n1\tx\tx\tX\t_\t_\t0\troot\t_\t_\n\n" for _ in texts]

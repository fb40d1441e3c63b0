"""A small stand-in analyzer for the U1 slot: it shows the contract a real
model wrapper fulfils (load once per worker, CoNLL-U string per text out).

Sentences are the non-blank lines; tokens are whitespace-separated words;
LEMMA is the lowercase form; UPOS is NUM for digits and X otherwise; every
token hangs from the root (HEAD 0, DEPREL ``root``).
"""

from __future__ import annotations


def toy_analyzer_factory():
    def analyze(texts: list[str]) -> list[str]:
        out = []
        for text in texts:
            blocks = []
            lines = [ln for ln in text.split("\n") if ln.strip()]
            for n, line in enumerate(lines, start=1):
                rows = [f"# sent_id = {n}", f"# text = {line}"]
                for i, w in enumerate(line.split(), start=1):
                    upos = "NUM" if w.isdigit() else "X"
                    rows.append("\t".join([str(i), w, w.lower(), upos, "_", "_", "0", "root", "_", "_"]))
                blocks.append("\n".join(rows) + "\n\n")
            out.append("".join(blocks))
        return out
    return analyze

import functools
import os
import tempfile

from corpusflow.operators.annotate import annotate_with
from corpusflow.sources.conllu import parse_conllu


def test_factory_loads_once_per_worker(spark):
    log = os.path.join(tempfile.mkdtemp(prefix="probe-"), "log")
    spark.sparkContext.addPyFile(os.path.join(os.path.dirname(__file__), "probe_analyzer.py"))
    from probe_analyzer import probe_factory
    arts = spark.range(0, 640, 1, 32).selectExpr("id as article_id", "cast(id as string) as text")
    toks = parse_conllu(annotate_with(arts, functools.partial(probe_factory, log)))
    assert toks.count() == 640
    loads = open(log).read().split()
    # 32 tasks, at most one load per Python worker process
    assert len(loads) == len(set(loads)) and len(loads) <= os.cpu_count()

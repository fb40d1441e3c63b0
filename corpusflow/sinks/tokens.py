"""TOKEN table sink and source: annotate once, scan many times.

Tokens are written as parquet partitioned by an article bucket
(``pmod(xxhash64(article_id), buckets)``), each bucket's files sorted by
``(article_id, sent_id, id)``.  Downstream queries read only the columns they
need, with label predicates (``upos IN (...)``) pushed into the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusflow.schemas import TOKEN, TOKEN_COLUMNS


def article_bucket(buckets: int):
    return F.pmod(F.xxhash64("article_id"), F.lit(buckets)).cast("int")


def write_tokens(tokens: DataFrame, path: str, buckets: int = 64, mode: str = "overwrite") -> None:
    """Write TOKEN rows; one shuffle by bucket, sorted within files."""
    (tokens.select(*TOKEN_COLUMNS).withColumn("bucket", article_bucket(buckets))
     .repartition("bucket").sortWithinPartitions("article_id", "sent_id", "id")
     .write.mode(mode).partitionBy("bucket").parquet(path))


def read_tokens(spark: SparkSession, path: str, upos: list[str] | None = None) -> DataFrame:
    """TOKEN rows from a written table; ``upos`` becomes a pushed-down filter."""
    schema = T.StructType(list(TOKEN.fields) + [T.StructField("bucket", T.IntegerType())])
    df = spark.read.schema(schema).parquet(path)
    if upos is not None:
        df = df.filter(F.col("upos").isin(list(upos)))
    return df.select(*TOKEN_COLUMNS)

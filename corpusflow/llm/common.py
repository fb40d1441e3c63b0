"""Helpers shared by the training-data operators."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from corpusflow.session import checkpoint_dir, load_table, ship_package


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents table."""
    return load_table(spark, sf_dir, "documents")


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Cuts lineage without keeping blocks on executors: a lost executor costs
    nothing, and several consumers share one computation.  The folder is
    removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return spark.read.schema(df.schema).parquet(path)


def workers_ready(df: DataFrame) -> DataFrame:
    """Make this package importable in the Python workers, then return ``df``."""
    ship_package(df.sparkSession)
    return df


def shuffle_partitions(spark: SparkSession) -> int:
    """The session's number of shuffle partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

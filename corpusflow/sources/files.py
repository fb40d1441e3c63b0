"""File sources of the on-disk corpus layout.

``N_raw.txt`` / ``N_meta.json`` files are read whole by Spark's own text and
JSON readers; the article id comes from the file name (``_metadata``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusflow.functions.paths import article_id_from_name
from corpusflow.schemas import META


def read_raw(spark: SparkSession, path: str, glob: str = "*_raw.txt") -> DataFrame:
    """``(article_id, text)``, one row per raw file."""
    return (spark.read.option("pathGlobFilter", glob).text(path, wholetext=True)
            .select(article_id_from_name(F.col("_metadata.file_name")).alias("article_id"),
                    F.col("value").alias("text")))


def read_raw_table(spark: SparkSession, path: str) -> DataFrame:
    """S1 on the table form of the raw texts (``sinks.files.write_raw``)."""
    return spark.read.schema("article_id long, text string").parquet(path)


def with_meta_defaults(meta: DataFrame) -> DataFrame:
    """Missing keys get defaults: ``id`` -> 0, ``title`` -> ""; others stay null."""
    return (meta.withColumn("id", F.coalesce(F.col("id"), F.lit(0).cast("bigint")))
            .withColumn("title", F.coalesce(F.col("title"), F.lit(""))))


def read_meta(spark: SparkSession, path: str, glob: str = "*_meta.json") -> DataFrame:
    """META rows with defaults; ``article_id`` is the file id and ``id`` the
    id written inside the file (they may differ)."""
    df = (spark.read.schema(META).option("multiLine", "true").option("pathGlobFilter", glob)
          .json(path)
          .withColumn("article_id", article_id_from_name(F.col("_metadata.file_name"))))
    return with_meta_defaults(df)


def parse_meta_json(df: DataFrame, json_col: str = "meta_json") -> DataFrame:
    """S2 on a column of JSON text: META fields with defaults."""
    m = F.from_json(F.col(json_col), META)
    return with_meta_defaults(df.select("*", m.alias("_m")).select(
        *[c for c in df.columns if c != json_col], "_m.*"))


def scan_corpus(raw: DataFrame, meta: DataFrame) -> DataFrame:
    """One article per id: raw text joined to its meta record.

    A raw file without meta is dropped here and reported by ``raw_meta_balance``.
    """
    return raw.join(meta, on="article_id", how="inner")


def read_corpus(spark: SparkSession, path: str) -> DataFrame:
    return scan_corpus(read_raw(spark, path), read_meta(spark, path).drop("pattern_matches"))


def list_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """``(path, name, length, modified)`` of the files in a folder.

    A metadata listing through the Hadoop file system (as Spark's own file
    index does): file sources skip zero-length files, and empty corpus files
    are exactly what the corpus check must see.  Contents are never read.
    """
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(path.rstrip("/") + "/" + glob)
    fs = pattern.getFileSystem(conf)
    statuses = fs.globStatus(pattern) or []
    rows = [(str(st.getPath().toString()), st.getPath().getName(), int(st.getLen()),
             int(st.getModificationTime())) for st in statuses if st.isFile()]
    df = spark.createDataFrame(rows, "path string, name string, length bigint, modified_ms bigint")
    return df.select("path", "name", "length",
                     F.timestamp_millis(F.col("modified_ms")).alias("modified"))

"""Session helpers: building a session, loading driver tables, checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Session settings every corpusflow job relies on.  AQE re-plans joins and
# coalesces shuffle partitions at run time; skew-join splitting handles hot
# articles / hosts; the UI stays off (no server is opened).
DEFAULT_CONF = {
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(master: str | None = None, app: str = "corpusflow",
              shuffle_partitions: int | None = None,
              extra: dict[str, str] | None = None) -> SparkSession:
    """Return the active session or build one with corpusflow's defaults."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Read one driver table (``<sf_dir>/<name>.parquet``)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder used to cut lineage (``spark.checkpoint.dir``).

    On a cluster the folder must be set by the cluster (a shared file system).
    Only a local-mode session without the setting (tests, laptops) gets a
    fresh folder of its own.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
        "spark.checkpoint.dir", None)
    if configured:
        sc.setCheckpointDir(configured)
        return sc.getCheckpointDir() or configured
    if not sc.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    folder = tempfile.mkdtemp(prefix="corpusflow-ckpt-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir() or folder


SPREAD_CONF = "spark.corpusflow.spreadPartitions"


def spread(df: DataFrame, partitions: int | None = None) -> DataFrame:
    """Deal rows round-robin into ``partitions`` before CPU-heavy per-row work.

    A scan yields one task per row group, so a table written as one row group
    is a single task however many cores there are.  Whether that is so is
    known to whoever runs the job, not to the plan: the number comes from the
    argument or the setting ``spark.corpusflow.spreadPartitions``, and without
    either the rows stay where they are.  No job runs to find out.
    """
    wanted = partitions or int(df.sparkSession.conf.get(SPREAD_CONF, "0"))
    if df.isStreaming or not wanted:
        return df
    return df.repartition(wanted)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back.

    Unlike a checkpoint it is one job, and the rows keep their compressed
    columns.  The folder is removed when the driver's JVM ends.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path under the shared checkpoint folder, removed when the driver's JVM ends."""
    path = f"{checkpoint_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(target)
    return path


_ZIP_BYTES: list[bytes] = []
_SHIPPED_TO: set[str] = set()


def _package_zip() -> bytes:
    import io
    import zipfile

    if not _ZIP_BYTES:
        pkg = os.path.dirname(os.path.abspath(__file__))
        root = os.path.dirname(pkg)
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w", zipfile.ZIP_DEFLATED) as z:
            for folder, _, files in os.walk(pkg):
                for name in files:
                    if name.endswith(".py"):
                        full = os.path.join(folder, name)
                        z.write(full, os.path.relpath(full, root))
        _ZIP_BYTES.append(buf.getvalue())
    return _ZIP_BYTES[0]


def ship_package(spark: SparkSession) -> None:
    """Make ``corpusflow`` importable in the Python workers of every executor.

    Functions run by ``mapInPandas`` / pandas UDFs refer to corpusflow
    modules.  The package is zipped in memory, written once per session to the
    shared checkpoint folder through the Hadoop file system, and distributed
    with ``addPyFile``.
    """
    sc = spark.sparkContext
    app = sc.applicationId
    if app in _SHIPPED_TO:
        return
    jvm = sc._jvm
    target = jvm.org.apache.hadoop.fs.Path(
        scratch_path(spark, "pyfiles") + "/corpusflow.zip")
    fs = target.getFileSystem(sc._jsc.hadoopConfiguration())
    out = fs.create(target, True)
    try:
        out.write(bytearray(_package_zip()))
    finally:
        out.close()
    sc.addPyFile(target.toString())
    _SHIPPED_TO.add(app)

"""Session settings and the shared folder used for intermediate results."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.showConsoleProgress": "false",
}


def build_session(master: str | None = None, app: str = "tabloom", **extra: str) -> SparkSession:
    """A session with this library's settings; ``extra`` keys use ``__`` for a dot."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a temporary folder; on a cluster a
    missing setting is an error, because a driver-local folder would not be shared.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="tabloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def ensure_checkpoints(spark: SparkSession) -> None:
    """Make ``DataFrame.checkpoint`` and the iterative estimators use the shared folder."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark)}/tabloom/{label}-{uuid.uuid4().hex}"


# Bytes of a row group of a scratch table: few enough that a small table too is read by many tasks.
ROW_GROUP = 4 << 20


def written(df: DataFrame, label: str) -> DataFrame:
    """The rows as a table in the shared folder: later jobs start from its files, and read it as often as they need."""
    path = scratch_path(df.sparkSession, label)
    df.write.option("parquet.block.size", str(ROW_GROUP)).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def default_slices(spark: SparkSession) -> int:
    """How many ordered slices a distributed ranking cuts its input into."""
    # Four per shuffle partition, so that hashing slices to partitions evens out.
    return max(8, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))

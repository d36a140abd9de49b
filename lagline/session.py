"""Session settings the library reads, and where it may keep intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

SERIES_ROWS = "spark.lagline.maxSeriesRows"
DEFAULT_SERIES_ROWS = 2_000_000


def local_session(cores: str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and benchmarks on one machine."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("lagline")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .getOrCreate()
    )


def series_row_limit(spark: SparkSession) -> int:
    """Most rows of one series (or group) that a single task may sort."""
    return int(spark.conf.get(SERIES_ROWS, str(DEFAULT_SERIES_ROWS)))


def scratch_dir(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a plain local master, whose tasks
    all run in the driver, may fall back to a folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    return tempfile.mkdtemp(prefix="lagline-")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder."""
    return f"{_checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and go on from there.

    Used where a later step needs the same rows twice in exactly the same order or
    partitions, or where a loop would otherwise grow the plan. It is a reliable
    checkpoint, so a lost executor costs a re-read and nothing else.
    """
    _checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def settle_table(df: DataFrame) -> DataFrame:
    """Like :func:`settle` for many rows: a Parquet table, of which later steps read only
    the columns they need."""
    path = scratch_path(df.sparkSession, "table")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _checkpoint_dir(spark: SparkSession) -> str:
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(scratch_dir(spark))
    return context.getCheckpointDir()


def release(spark: SparkSession) -> None:
    """Delete what this application has written to the shared folder, at the end of a job.

    Frames that read it cannot be used any more.
    """
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is not None:
        path = context._jvm.org.apache.hadoop.fs.Path(folder)
        files = path.getFileSystem(context._jsc.hadoopConfiguration())
        files.delete(path, True)
        files.mkdirs(path)

"""Tables and models that are replaced while others read them.

Below a path every version has a folder, named so that later ones sort last. The folder's
``meta``, a line of JSON, is written when all else is there; until then no reader looks at it.
"""

from __future__ import annotations

import json
import time
import uuid

from pyspark.sql import SparkSession

PREFIX = "version-"


def new_version(path: str) -> str:
    """A folder for a version that is about to be written."""
    return f"{path}/{PREFIX}{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"


def publish(spark: SparkSession, folder: str, meta: dict) -> str:
    """Make a written version the one that readers take."""
    text = spark.createDataFrame([(json.dumps(meta),)], "value string")
    text.coalesce(1).write.text(f"{folder}/meta")
    return folder


def versions(spark: SparkSession, path: str) -> list[tuple[str, bool]]:
    """The folders of all versions, oldest first, and whether they are complete."""
    context = spark.sparkContext
    root = context._jvm.org.apache.hadoop.fs.Path(path)
    files = root.getFileSystem(context._jsc.hadoopConfiguration())
    if not files.exists(root):
        return []
    found = sorted(s.getPath().getName() for s in files.listStatus(root) if s.isDirectory())
    named = [f"{path}/{name}" for name in found if name.startswith(PREFIX)]
    done = context._jvm.org.apache.hadoop.fs.Path
    return [(folder, files.exists(done(f"{folder}/meta/_SUCCESS"))) for folder in named]


def newest_version(spark: SparkSession, path: str) -> str | None:
    """The newest complete version below a path."""
    return next((folder for folder, done in reversed(versions(spark, path)) if done), None)


def prune_versions(spark: SparkSession, path: str, keep: int = 2) -> list[str]:
    """Delete all versions older than the newest ``keep`` complete ones; returns them."""
    if keep < 1:
        raise ValueError(f"keep must be at least 1, got {keep}")
    found = versions(spark, path)
    complete = [folder for folder, done in found if done]
    oldest = complete[-keep] if len(complete) >= keep else ""
    context = spark.sparkContext
    gone = [folder for folder, _ in found if folder < oldest]
    for folder in gone:
        at = context._jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)
    return gone

"""Intermediate tables in the shared folder named by ``spark.checkpoint.dir``.

Writing an intermediate result cuts its lineage, so a lost executor costs a re-read instead of a
recomputation, and every later read sees the same rows. The files also carry an exact size, which
lets the optimizer decide by itself whether a join side is small enough to broadcast.
"""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def staging_root(spark: SparkSession) -> str:
    """Folder for intermediate tables: the session's checkpoint folder.

    Only a local-mode session without that setting gets a temporary folder, deleted when Python
    ends. On a cluster the folder has to be reachable from every executor, so a missing setting is
    an error there; whether a path that is set is a shared one cannot be seen from its name.
    """
    context = spark.sparkContext
    root = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        root = tempfile.mkdtemp(prefix="autostrata-")
        atexit.register(shutil.rmtree, root, ignore_errors=True)
        context.setCheckpointDir(root)
    return root.rstrip("/")


_area: ContextVar[str | None] = ContextVar("staging area", default=None)


def staging_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the staging folder, or under the temporary area in use."""
    return f"{_area.get() or staging_root(spark)}/{label}-{uuid.uuid4().hex}"


@contextmanager
def temporary_area(spark: SparkSession) -> Iterator[None]:
    """Delete the intermediate tables written inside at the end, when results have been saved."""
    path = f"{staging_root(spark)}/area-{uuid.uuid4().hex}"
    token = _area.set(path)
    try:
        yield
    finally:
        _area.reset(token)
        context = spark.sparkContext
        folder = context._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once as parquet in the staging folder and return a scan of the copy."""
    path = staging_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize_counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """``materialize``, with the number of rows, which is observed while writing."""
    rows = Observation()
    copy = materialize(df.observe(rows, F.count(F.lit(1)).alias("n")), label)
    return copy, rows.get["n"]


def stored_bytes(copy: DataFrame) -> int:
    """Size of the files of a written frame, from the file system's own count; runs no job."""
    context = copy.sparkSession.sparkContext
    total = 0
    for root in {re.sub("/[^/]*$", "", file) for file in copy.inputFiles()}:
        folder = context._jvm.org.apache.hadoop.fs.Path(context._jvm.java.net.URI(root))
        fs = folder.getFileSystem(context._jsc.hadoopConfiguration())
        total += fs.getContentSummary(folder).getLength()
    return total

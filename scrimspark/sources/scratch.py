"""A folder that driver and executors share, for queries that write and read back."""

from __future__ import annotations

import gc
import tempfile
import threading
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: What the scopes of a thread have made.
_open = threading.local()


def scratch(spark: SparkSession, name: str) -> str:
    """A new path below spark.checkpoint.dir, or, where that is unset (tests), below a temporary folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    path = f"{folder.rstrip('/')}/scrimspark/{name}-{uuid.uuid4().hex}"
    if getattr(_open, "scopes", None):
        _open.scopes[-1].append(path)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """df, written once and read back: what several plans read is worked out once, and survives a lost executor."""
    path = scratch(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidy(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished steps now, not when the driver's heap happens to fill.
    It takes two rounds: what holds a shuffle is let go by the first."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Deletes, at its end, what was made in it: nothing returned from it may still read that."""
    _open.scopes = [*getattr(_open, "scopes", []), []]
    try:
        yield
    finally:
        for path in map(spark._jvm.org.apache.hadoop.fs.Path, _open.scopes.pop()):
            path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)

"""Helpers that several operators of this folder share."""

from __future__ import annotations

import gc
import math
import tempfile
import time
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A word: a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """The named input table, only the given columns, so that clashing extras never get in."""
    small_batches(spark)
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return df.select(*columns) if columns else df


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; a temporary one where it is unset (tests)."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        folder = tempfile.mkdtemp(prefix="spark-scratch-", dir="/tmp")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def keep(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: cuts the lineage, and Spark knows the size from the files."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/scrimspark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


#: A table of more rows is left in the partitions that it has.
SMALL = 1 << 17


def gathered(df: DataFrame, rows: int, each: int) -> DataFrame:
    """df, which has at most so many rows, in partitions of about ``each`` if they are few. Else a table of some hundred
    rows is written, and read again, as so many files as there are shuffle partitions."""
    return df.coalesce(max(1, math.ceil(rows / each))) if rows <= SMALL else df


def small_batches(spark: SparkSession) -> None:
    """Texts go to Python in batches of 1,000 rows, unless the session says otherwise: 10,000 texts, Spark's default, and
    what is made of them are some hundred megabytes in each worker."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, "1000")


def tidy(spark: SparkSession) -> None:
    """Lets Spark's cleaner delete the shuffle files of finished steps now, not when the driver's heap happens to fill.
    It takes two rounds: what holds a shuffle is let go by the first."""
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.5)


def drop(*kept: DataFrame) -> None:
    """Deletes what keep() wrote, once nothing reads it any more."""
    for df in kept:
        jvm = df.sparkSession._jvm
        for file in df.inputFiles()[:1]:
            path = jvm.org.apache.hadoop.fs.Path(file).getParent()
            path.getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def text_or_empty(column: str = "text"):
    return F.coalesce(F.col(column), F.lit(""))


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit words that spreads every input bit (splitmix64's finaliser)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x

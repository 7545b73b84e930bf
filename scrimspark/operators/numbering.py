"""Numbers rows in an order without bringing them, or the rows of a key, to one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import scratch

#: monotonically_increasing_id() is the partition's index and, in so many bits, the row's place in it.
PLACE_BITS = 33


def numbered(rows: DataFrame, name: str, order: list[str], keys: list[str] | None = None) -> DataFrame:
    """rows with ``name`` (long): 1, 2, ... in the given order, nulls first, within each value of keys.

    Rows are dealt into ranges of (keys, order), sorted there and written once, so that their ranges stay what they are;
    running counts of the ranges (a row for each range and key) are added to the places within them."""
    keys = keys or []
    spark, path = rows.sparkSession, scratch(rows.sparkSession, "numbered")
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    rows.repartitionByRange(*by).sortWithinPartitions(*by).withColumn("_at", F.monotonically_increasing_id()).write.parquet(path)
    at = spark.read.schema(T.StructType([*rows.schema.fields, T.StructField("_at", T.LongType())])).parquet(path)
    at = at.withColumn("_range", F.shiftright("_at", PLACE_BITS))
    counts = at.groupBy("_range", *keys).agg(F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    shift = counts.select(F.col("_range").alias("_r"), *[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first") + 1).alias("_shift"))
    on = F.col("_range") == F.col("_r")
    for i, k in enumerate(keys):
        on = on & F.col(k).eqNullSafe(F.col(f"_k{i}"))
    return at.join(F.broadcast(shift) if not keys else shift, on).withColumn(name, F.col("_at") + F.col("_shift")).drop("_at", "_range", "_r", "_shift", *[f"_k{i}" for i in range(len(keys))])

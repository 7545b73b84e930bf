"""As-of join by sorting and running values: no row of one side meets a history of the other."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.scratch import written


def as_of(left: DataFrame, right: DataFrame, by: str, left_time: str, right_time: str, ties: list[Column] | None = None) -> DataFrame:
    """left with the columns of right's latest row of the same ``by`` whose time is no later than left's; nulls where there
    is none. Of right rows with one time the last by ``ties`` (expressions over right) counts. A null key or time finds
    nothing and is found by nothing. Left's key and time are compared in the types that right has.

    Both sides are put in one order (key, time, right before left) and cut into ranges, so a key with most of the rows is in
    many of them; the cut rows are written once. Within a range a running last value does the work. What a range's first
    rows lack comes from the ranges before: the last right row of each key and range, one small row each, is carried on.
    """
    values = [c for c in right.columns if c != by]
    clash = set(values) & set(left.columns)
    if clash:
        raise ValueError(f"both sides have {sorted(clash)}")
    order = [f"_tie{i}" for i in range(len(ties or []))]
    none = lambda df: [F.lit(None).cast(df.schema[c].dataType).alias(c) for c in df.columns]
    snapshots = right.where(F.col(by).isNotNull() & F.col(right_time).isNotNull())
    snapshots = snapshots.select(F.col(by).alias("_key"), F.col(right_time).alias("_time"), F.lit(0).alias("_kind"), *[c.alias(n) for c, n in zip(ties or [], order, strict=True)], F.struct(*values).alias("_right"), F.struct(*none(left)).alias("_left"))
    kinds = {n: snapshots.schema[n].dataType for n in ("_right", "_key", "_time", *order)}
    asked = left.select(F.col(by).cast(kinds["_key"]).alias("_key"), F.col(left_time).cast(kinds["_time"]).alias("_time"), F.lit(1).alias("_kind"), *[F.lit(None).cast(kinds[n]).alias(n) for n in order], F.lit(None).cast(kinds["_right"]).alias("_right"), F.struct(*left.columns).alias("_left"))
    lost = F.col("_key").isNull() | F.col("_time").isNull()
    line = ["_key", "_time", "_kind", *order]
    # _at: the range and the place in it
    rows = written(snapshots.unionByName(asked.where(~lost)).repartitionByRange(*line).sortWithinPartitions(*line).withColumn("_at", F.monotonically_increasing_id()), "as-of")
    rows = rows.withColumn("_range", F.shiftright("_at", 33))
    so_far = Window.partitionBy("_key", "_range").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
    found = rows.withColumn("_found", F.last("_right", ignorenulls=True).over(so_far)).where("_kind = 1")
    ends = rows.where("_kind = 0").groupBy(F.col("_key").alias("_k"), "_range").agg(F.max_by("_right", "_at").alias("_last"))
    # every range of a key needs the one before it that has a right row: one row for each key and range
    spans = rows.select(F.col("_key").alias("_k"), "_range").distinct().join(ends, ["_k", "_range"], "left")
    before = Window.partitionBy("_k").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carried = spans.select("_k", F.col("_range").alias("_r"), F.last("_last", ignorenulls=True).over(before).alias("_carried")).where("_carried IS NOT NULL")
    out = found.join(carried, (F.col("_key") == F.col("_k")) & (F.col("_range") == F.col("_r")), "left").select("_left.*", F.coalesce("_found", "_carried").alias("_f"))
    nothing = asked.where(lost).select("_left.*", F.col("_right").alias("_f"))
    return out.unionByName(nothing).select(*left.columns, *[F.col(f"_f.{c}").alias(c) for c in values])

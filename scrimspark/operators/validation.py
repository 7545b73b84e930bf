"""Comparison of frames, event sets, headers and scoreboards."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..sources.scratch import written
from .as_of import as_of
from .matching import CELL_COLUMNS, most_pairs
from .numbering import numbered

# Events that only one side of a comparison knows.
UNTRACKED_EVENTS = (
    "cs_win_panel_match", "cs_round_final_beep", "round_time_warning", "player_connect", "player_ping",
    "round_announce_match_start", "round_announce_last_round_half", "cs_win_panel_round", "announce_phase_end",
    "round_announce_final", "round_mvp", "player_ping_stop", "player_connect_full", "player_activate",
    "server_message", "cs_pre_restart", "cs_intermission", "vote_cast", "round_end_upload_stats",
    "cs_round_start_beep", "chat_message", "round_announce_match_point",
)
#: The same, of the relay that spectators watch.
RELAY_EVENTS = "[a-z]+tv_(chase|fixed|versioninfo)"
COMPOSITE_EVENTS = ("grenade_data",)


def _pieces(rows: DataFrame, loose: int, abs_tol: float) -> DataFrame:
    """rows (_piece, _values) with a finer `_piece`: rows that could be paired stay in one. Column by column, values are put
    into cells of the tolerance's width; a cell without an occupied one below it begins a piece, and the cells after it
    belong to the latest beginning, which is an as-of join of cells."""
    for i in range(min(loose, CELL_COLUMNS)):
        v = F.col("_values")[i]
        whole = v.isNotNull() & ~F.isnan(v) & (F.abs(v) < 1e300)
        # where there are no cells the values themselves tell the pieces apart
        cell = F.when(whole, F.floor(v / abs_tol).cast("double")) if abs_tol else F.lit(None).cast("double")
        rows = rows.withColumn("_cell", cell).withColumn("_other", F.when(F.col("_cell").isNull(), F.coalesce(F.xxhash64(v.cast("string")), F.lit(0))))
        cells = rows.where("_cell IS NOT NULL").select(F.col("_piece").alias("_p"), F.col("_cell").alias("_c")).distinct()
        below = cells.select(F.col("_p").alias("_q"), (F.col("_c") + 1).alias("_d"))
        starts = cells.join(below, (F.col("_p") == F.col("_q")) & (F.col("_c") == F.col("_d")), "left_anti").select("_p", F.col("_c").alias("_start"))
        found = as_of(cells, starts, "_p", "_c", "_start")
        rows = rows.join(found, (F.col("_piece") == F.col("_p")) & (F.col("_cell") == F.col("_c")), "left")
        rows = rows.withColumn("_piece", F.sha2(F.concat_ws(" ", "_piece", F.lit(i), F.coalesce(F.col("_start").cast("string"), F.lit("-")), F.coalesce(F.col("_other").cast("string"), F.lit("-"))), 256)).drop("_p", "_c", "_start", "_cell", "_other")
    return rows


def _without_partner(rows: DataFrame, loose: int, abs_tol: float) -> DataFrame:
    """The rows (_piece, _left, _values and more) that a largest pairing inside their piece leaves over."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        def left_over(piece: pd.DataFrame) -> pd.DataFrame:
            values = np.array([[np.nan if x is None else x for x in v] for v in piece["_values"]], dtype=float).reshape(len(piece), loose)
            at_left, at_right = np.flatnonzero(piece["_left"]), np.flatnonzero(~piece["_left"].astype(bool))
            paired = most_pairs(values[at_left], values[at_right], abs_tol) if len(at_left) and len(at_right) else []
            gone = {at_left[i] for i, _ in paired} | {at_right[j] for _, j in paired}
            return piece.iloc[[n for n in range(len(piece)) if n not in gone]]

        waiting: list[pd.DataFrame] = []
        for b in batches:
            for name, piece in b.groupby("_piece", sort=False):
                if waiting and waiting[-1]["_piece"].iloc[0] != name:
                    yield left_over(pd.concat(waiting))
                    waiting = []
                waiting.append(piece)
        if waiting:
            yield left_over(pd.concat(waiting))

    return rows.repartition("_piece").sortWithinPartitions("_piece", "_left", "_values").mapInPandas(run, rows.schema)


def frames_equal(left: DataFrame, right: DataFrame, abs_tol: float = 5.0) -> DataFrame:
    """V1: the rows that differ: (side, the exact columns as JSON, left_* and right_* of the others). Order of rows and
    types of numbers don't matter, the order of columns does. As many rows as can be are paired with one of equal exact
    columns whose inexact ones are within the tolerance; a missing value only equals a missing one.

    side: "left" or "right" for a row that is left over; two of one exact columns, in the order of their values, are shown
    together as "both". Rows that are alone on a side are compared in one grouping; the others are cut into pieces between
    which nothing can be paired, so equal exact columns, or none at all, are no one task's work, and are paired piece by
    piece. A piece, that is rows each within reach of the next, is held by one task."""
    if left.columns != right.columns:
        raise ValueError(f"columns differ: {left.columns} and {right.columns}")
    loose = [c for c in left.columns if any(isinstance(d.schema[c].dataType, T.FractionalType) for d in (left, right))]
    exact = [c for c in left.columns if c not in loose]
    shown = lambda df: [F.to_json(F.struct(c)).alias(c) for c in exact]
    if not loose:
        a, b = left.select(*shown(left)), right.select(*shown(right))
        return a.exceptAll(b).select(F.lit("left").alias("side"), *exact).unionByName(b.exceptAll(a).select(F.lit("right").alias("side"), *exact))

    def side(df: DataFrame, is_left: bool) -> DataFrame:
        texts = shown(df)
        return df.select(F.array(*texts).cast("array<string>").alias("_exact"), F.array(*[F.col(c).cast("double") for c in loose]).alias("_values"), F.lit(is_left).alias("_left"))

    rows = side(left, True).unionByName(side(right, False)).withColumn("_key", F.sha2(F.to_json("_exact"), 256))
    rows = written(rows, "frames")
    mine = {s: F.when(F.col("_left") == (s == "left"), F.col("_values")) for s in ("left", "right")}
    keys = rows.groupBy("_key").agg(F.any_value("_exact").alias("_exact"), *[F.count(v).alias(f"_n_{s}") for s, v in mine.items()], *[F.max(v).alias(s) for s, v in mine.items()])
    off = F.exists(F.arrays_zip(F.col("left").alias("a"), F.col("right").alias("b")), lambda p: ~_near(p["a"], p["b"], abs_tol))
    alone = (F.col("_n_left") <= 1) & (F.col("_n_right") <= 1)
    single = keys.where(alone).withColumn("side", F.when(F.col("_n_right") == 0, "left").when(F.col("_n_left") == 0, "right").when(off, "both")).where("side IS NOT NULL").select("side", "_exact", "left", "right")
    # written, so that the join below may deal out a key with many rows
    several = written(keys.where(~alone).select("_key"), "frames-keys")
    show = lambda df: df.select("side", *[F.col("_exact")[i].alias(c) for i, c in enumerate(exact)], *[F.col(s)[i].alias(f"{s}_{c}") for i, c in enumerate(loose) for s in ("left", "right")])
    if several.isEmpty():
        return show(single)
    over = _without_partner(_pieces(rows.join(several, "_key").withColumn("_piece", F.col("_key")), len(loose), abs_tol), len(loose), abs_tol)
    over = written(over, "frames-over")
    a, b = (numbered(over.where(F.col("_left") == (s == "left")).select("_key", "_exact", F.col("_values").alias(s)), "_n", [s], ["_key"]) for s in ("left", "right"))
    which = F.when(F.col("right").isNull(), "left").when(F.col("left").isNull(), "right").otherwise("both")
    over = a.join(b.withColumnRenamed("_exact", "_there"), ["_key", "_n"], "full_outer").select(which.alias("side"), F.coalesce("_exact", "_there").alias("_exact"), "left", "right")
    return show(single.unionByName(over))


def _near(a: Column, b: Column, abs_tol: float) -> Column:
    """matching.near() for one column."""
    gone_a, gone_b = a.isNull() | F.isnan(a), b.isNull() | F.isnan(b)
    return F.when(gone_a | gone_b, gone_a & gone_b).otherwise((a == b) | (F.abs(a - b) <= abs_tol))


def event_set_diff(left: DataFrame, right: DataFrame, exclude_left: tuple[str, ...] = UNTRACKED_EVENTS, exclude_right: tuple[str, ...] = COMPOSITE_EVENTS, exclude_left_pattern: str = RELAY_EVENTS) -> DataFrame:
    """V2: (event_type, left_rows, right_rows) of names that are not as often in both lists (event_type). The left list is
    read without the names of exclude_left and without those that the whole of exclude_left_pattern matches."""
    a = left.where(F.col("event_type").isNotNull() & ~F.col("event_type").isin(*exclude_left) & ~F.col("event_type").rlike(f"^(?:{exclude_left_pattern})$")).select("event_type", F.lit(1).alias("l"), F.lit(0).alias("r"))
    b = right.where(F.col("event_type").isNotNull() & ~F.col("event_type").isin(*exclude_right)).select("event_type", F.lit(0).alias("l"), F.lit(1).alias("r"))
    return a.union(b).groupBy("event_type").agg(F.sum("l").alias("left_rows"), F.sum("r").alias("right_rows")).where("left_rows <> right_rows")


def header_match(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """V3: (key, same): whether map name and patch version of both sides are equal, nulls included."""
    r = right.select(*key, F.col("map_name").alias("_m"), F.col("patch_version").alias("_p"))
    same = F.col("map_name").eqNullSafe(F.col("_m")) & F.col("patch_version").eqNullSafe(F.col("_p"))
    return left.join(r, key).select(*key, same.alias("same"))


def scoreboard_vs_published(board: DataFrame, roster: DataFrame, player_stats: DataFrame, match_maps: DataFrame, threshold: float = 5.0) -> DataFrame:
    """V4: (match_id, player_id, measure, ours, published, pct, ok): a scoreboard's kills and deaths, summed over maps,
    against the published lines, both sides summed; pct is the difference in per cent of the published value."""
    ours = board.join(roster.select("match_id", F.lower("alias").alias("player"), "player_id"), ["match_id", "player"]).groupBy("match_id", "player_id").agg(F.sum("kills").alias("kills"), F.sum("deaths").alias("deaths"))
    theirs = player_stats.join(match_maps.select("match_map_id", "match_id"), "match_map_id").groupBy("match_id", "player_id").agg(F.sum("kills").alias("_kills"), F.sum("deaths").alias("_deaths"))
    pairs = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), F.col(m).cast("long").alias("ours"), F.col(f"_{m}").cast("long").alias("published")) for m in ("kills", "deaths")]))
    rows = ours.join(theirs, ["match_id", "player_id"]).select("match_id", "player_id", pairs.alias("p")).select("match_id", "player_id", "p.*")
    pct = F.abs(F.col("ours") - F.col("published")) * 100 / F.nullif(F.col("published"), F.lit(0))
    return rows.withColumn("pct", pct).withColumn("ok", F.coalesce(F.col("pct") <= threshold, F.col("ours") == F.col("published")))

"""Column helpers of the telemetry operators."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of a missing id.
MISSING_IDS = ("None", "nan", "NaN", "<NA>")


def clean_steamid(column: Column) -> Column:
    """T4: an id as text; spellings of a missing id are null. Ids are never doubles, which lose digits."""
    text = column.cast("string")
    return F.when(~text.isin(*MISSING_IDS), text)


def frame_file_name(path: Column, map_name: Column) -> Column:
    """The output name of a recording: its file name without extension, without its last dash-separated piece (two
    if the last one is a part number, p and digits), and the map's name."""
    name = F.regexp_replace(F.element_at(F.split(path, "/"), -1), r"\.[^.]*$", "")
    pieces = F.split(name, "-")
    keep = F.size(pieces) - F.when(F.element_at(pieces, -1).rlike(r"^p[0-9]+$"), 2).otherwise(1)
    return F.concat(F.array_join(F.slice(pieces, F.lit(1), F.greatest(keep, F.lit(0))), "-"), F.lit("-"), map_name, F.lit(".parquet"))

"""Ids of sides, veto actions and maps, and what spells them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# They equal the ids stored in the warehouse.
SIDES = {"T": 1, "CT": 2, "BOTH": 3}
PICK, BAN, REMAINING = 1, 2, 3
VETO_VERBS = {"picked": PICK, "removed": BAN, "was left over": REMAINING}
MAPS = {
    1: "Mirage",
    2: "Inferno",
    3: "Nuke",
    4: "Overpass",
    5: "Vertigo",
    6: "Ancient",
    7: "Anubis",
    8: "Dust2",
    9: "Train",
    10: "Cache",
    11: "Cobblestone",
}
MAP_IDS = {name.lower(): i for i, name in MAPS.items()}
#: Names of recorded maps: de_ and the name, but for one.
RECORDED_MAP_IDS = {"de_cbble" if name == "cobblestone" else f"de_{name}": i for name, i in MAP_IDS.items()}


def map_id(name: str | None) -> int | None:
    """The id of a map's name as pages write it, with or without spaces."""
    bare = (name or "").strip().lower()
    return MAP_IDS.get(bare) or MAP_IDS.get(bare.replace(" ", ""))


def lookup(values: dict, key: Column) -> Column:
    """values[key] or null, as a literal map."""
    return F.element_at(F.create_map(*[F.lit(x) for pair in values.items() for x in pair]), key)


def maps_table(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(list(MAPS.items()), "map_id int, map_name string")

"""The recurring load: picks up new payload files, loads each match once, and touches only the buckets that it changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.warehouse import flatten_player_stats, load_match_payload
from ..schemas import PAYLOAD, TABLES
from ..sources.frames import parse_payloads, split_payloads
from ..sources.scratch import scratch_scope, written
from ..sources.store import Conflict, Layout, Store, Version, bucket_of

#: How the tables are dealt to buckets: those of matches by match, players by alias, the others are small.
KEYS = dict.fromkeys(("matches", "match_maps", "match_veto", "match_players", "player_stats"), "match_id") | {"players": "alias"}
NUMBERS = {"matches": "match_id", "match_maps": "match_map_id", "match_veto": "veto_id", "player_stats": "stat_id", "players": "player_id", "teams": "team_id"}
LAYOUTS = {name: Layout(schema, KEYS.get(name), NUMBERS.get(name)) for name, schema in TABLES.items()}


def match_store(spark: SparkSession, root: str) -> Store:
    return Store(spark, root, LAYOUTS)


def create_tables(spark: SparkSession, root: str, tables: dict[str, DataFrame], buckets: int = 64) -> Version:
    """The first version. Stored lines of players carry their match: it is looked up where the table doesn't have it."""
    stats = tables.get("player_stats")
    if stats is not None and "match_id" not in stats.columns:
        tables = tables | {"player_stats": stats.join(tables["match_maps"].select("match_map_id", "match_id"), "match_map_id", "left")}
    return match_store(spark, root).replace(tables, buckets)


def current_tables(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    """The tables of the newest version."""
    return match_store(spark, root).tables()


def load_into(store: Store, version: Version, payloads: DataFrame) -> Version:
    """The version after the payloads (one for each match), written but not committed. Only the buckets of the payloads'
    matches and aliases are read and written again, and numbers go on from those that the version knows."""
    matches = payloads.select(bucket_of(F.col("matchID"), version.buckets).alias("b"))
    aliases = flatten_player_stats(payloads).select(bucket_of(F.col("alias"), version.buckets).alias("b"))
    of_match, of_alias = ({r.b for r in rows.distinct().collect()} for rows in (matches, aliases))
    touched = {n: of_alias if key == "alias" else of_match for n, key in KEYS.items()}
    tables = {n: store.table(version, n, touched[n], stored=True) for n in KEYS} | {"teams": store.table(version, "teams")}
    loaded = load_match_payload(tables, payloads, version.largest)
    return store.write(version, {n: loaded[n] for n in KEYS}, touched)


def load_payloads(spark: SparkSession, root: str, payloads: DataFrame, tries: int = 5) -> Version:
    """Loads payloads into the newest version, and again into a newer one where another writer came first. Of payloads
    for one match the last page by date counts. What the tables hold already is skipped, so a load may be repeated."""
    store = match_store(spark, root)
    with scratch_scope(spark):
        last = payloads.groupBy("matchID").agg(F.max_by(F.struct(*PAYLOAD.fieldNames()), F.coalesce("matchDate", F.lit(""))).alias("p")).select("p.*")
        last = written(last, "last-payloads")
        for left in reversed(range(tries)):
            try:
                return store.commit(load_into(store, store.read_version(), last))
            except Conflict:
                if not left:
                    raise
    raise AssertionError


def start_match_load(spark: SparkSession, in_dir: str, tables_dir: str, checkpoint: str) -> StreamingQuery:
    """Loads all payload files of in_dir that the checkpoint doesn't know, and stops. Lines that can't be loaded are in
    tables_dir/payloads/batch-<number>/kind=bad, with the reason. A batch that is run again after a failure writes there
    again and adds nothing twice."""

    def load(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        good, _, counts = split_payloads(parse_payloads(batch), f"{tables_dir}/payloads/batch-{number}")
        if counts["good"]:
            load_payloads(session, tables_dir, good)

    return spark.readStream.text(in_dir).writeStream.foreachBatch(load).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def bad_payloads(spark: SparkSession, tables_dir: str) -> DataFrame:
    """(raw, reason) of the lines that no batch could load."""
    return spark.read.schema("raw string, reason string, kind string").option("basePath", f"{tables_dir}/payloads").parquet(f"{tables_dir}/payloads/batch-*").where("kind = 'bad'").select("raw", "reason")

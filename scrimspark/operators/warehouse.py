"""Warehouse load: each operator takes the old table and new rows and returns the new table.

Joins that look something up in a table, or check that it is not there yet, are equi and anti joins on the key; Spark
broadcasts the smaller side when its measured size allows.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.lookups import PICK, RECORDED_MAP_IDS, REMAINING, lookup
from ..sources.scratch import written
from .numbering import numbered


def with_ids(new: DataFrame, old: DataFrame, id_col: str, order: list[str], largest: int | None = None) -> DataFrame:
    """New rows numbered on from old's largest id, or from ``largest`` where old is only a part of its table. The numbering
    sorts the new rows only, in ranges."""
    kind = old.schema[id_col].dataType
    if largest is not None:
        return numbered(new, "_number", order).withColumn(id_col, (F.col("_number") + largest).cast(kind)).drop("_number")
    top = old.agg(F.coalesce(F.max(id_col), F.lit(0)).alias("_top"))
    return numbered(new, "_number", order).crossJoin(F.broadcast(top)).withColumn(id_col, (F.col("_top") + F.col("_number")).cast(kind)).drop("_top", "_number")


def appended(old: DataFrame, new: DataFrame) -> DataFrame:
    """old and new rows in old's columns; what new lacks is null."""
    return old.unionByName(new.select(*[F.col(f.name).cast(f.dataType) if f.name in new.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in old.schema]))


def ensure_names(old: DataFrame, names: DataFrame, id_col: str, name_col: str, largest: int | None = None) -> DataFrame:
    """old with a row for each name of names (one column) that it lacks; names compare exactly, null is no name."""
    new = names.toDF(name_col).where(F.col(name_col).isNotNull()).distinct().join(old, name_col, "left_anti")
    return appended(old, with_ids(new, old, id_col, [name_col], largest))


def flatten_player_stats(payloads: DataFrame) -> DataFrame:
    """One row for each (match, player, map, side); players without lines vanish."""
    players = payloads.select(F.col("matchID").alias("match_id"), F.explode("players").alias("p"))
    rows = players.select("match_id", "p.alias", F.col("p.team").alias("team_name"), F.explode("p.stats").alias("s"))
    two = "decimal(5,2)"
    return rows.select(
        "match_id",
        "alias",
        "team_name",
        F.col("s.mapID").cast("int").alias("map_id"),
        F.col("s.sideID").cast("int").alias("side_id"),
        F.col("s.kills").cast("int").alias("kills"),
        F.col("s.deaths").cast("int").alias("deaths"),
        F.col("s.ADR").cast(two).alias("adr"),
        F.col("s.swingPct").cast(two).alias("swing_pct"),
        F.col("s.rating").cast(two).alias("rating"),
        F.col("s.ratingVersion").alias("rating_version"),
    )


def ensure_players(players: DataFrame, flat: DataFrame, largest: int | None = None) -> DataFrame:
    """Players with a row for each alias that is new."""
    return ensure_names(players, flat.select("alias"), "player_id", "alias", largest)


def insert_match_players(match_players: DataFrame, flat: DataFrame, teams: DataFrame, players: DataFrame) -> DataFrame:
    """match_players with each new (match, team, player); unknown teams and players are left out."""
    found = flat.select("match_id", "team_name", "alias").distinct().join(teams, "team_name").join(players.select("alias", "player_id"), "alias")
    new = found.select("match_id", "team_id", "player_id").distinct()
    return appended(match_players, new.join(match_players, ["match_id", "team_id", "player_id"], "left_anti"))


def insert_player_stats(player_stats: DataFrame, flat: DataFrame, teams: DataFrame, players: DataFrame, match_maps: DataFrame, largest: int | None = None) -> DataFrame:
    """player_stats with the lines whose (map of match, player, side) is not there yet. Lines that repeat within a
    payload are all kept."""
    found = (
        flat.join(teams.select("team_name"), "team_name", "left_semi")
        .join(players.select("alias", "player_id"), "alias")
        .join(match_maps.select("match_map_id", "match_id", "map_id"), ["match_id", "map_id"])
    )
    new = found.join(player_stats, ["match_map_id", "player_id", "side_id"], "left_anti")
    if "stat_id" in player_stats.columns:
        new = with_ids(new, player_stats, "stat_id", ["match_map_id", "player_id", "side_id", "kills", "deaths", "adr"], largest)
    return appended(player_stats, new)


def veto_rows(payloads: DataFrame) -> DataFrame:
    rows = payloads.select(F.col("matchID").alias("match_id"), F.explode("matchVeto").alias("v"))
    return rows.select("match_id", F.col("v.stepNumber").alias("step"), F.col("v.teamName").alias("team_name"), F.col("v.vetoActionID").alias("action_id"), F.col("v.mapID").alias("map_id"))


def replace_match_vetoes(veto: DataFrame, payloads: DataFrame, teams: DataFrame, largest: int | None = None) -> DataFrame:
    """Veto with the rows of the payloads' matches replaced; a name that is no team (left over) gives null."""
    matches = payloads.select(F.col("matchID").alias("match_id")).distinct()
    new = veto_rows(payloads).join(teams, "team_name", "left")
    if "veto_id" in veto.columns:
        new = with_ids(new, veto, "veto_id", ["match_id", "step"], largest)
    return appended(veto.join(matches, "match_id", "left_anti"), new)


def insert_played_maps(match_maps: DataFrame, payloads: DataFrame, largest: int | None = None) -> DataFrame:
    """match_maps with a row for each picked or left-over map that is new."""
    new = veto_rows(payloads).where(F.col("action_id").isin(PICK, REMAINING)).select("match_id", "map_id").distinct()
    new = new.join(match_maps, ["match_id", "map_id"], "left_anti")
    return appended(match_maps, with_ids(new, match_maps, "match_map_id", ["match_id", "map_id"], largest))


def update_match_page(matches: DataFrame, payloads: DataFrame) -> DataFrame:
    """Date, notes and demo link from the payloads; notes are overwritten even by null, a missing link says ERROR."""
    new = payloads.select(
        F.col("matchID").alias("match_id"),
        F.to_timestamp(F.nullif("matchDate", F.lit(""))).alias("_date"),
        F.col("matchNotes").alias("_notes"),
        F.coalesce("demoLink", F.lit("ERROR")).alias("_link"),
        F.lit(True).alias("_hit"),
    )
    rows = matches.join(new, "match_id", "left")
    for c, n in (("match_date", "_date"), ("match_notes", "_notes"), ("demo_link", "_link")):
        rows = rows.withColumn(c, F.when(F.col("_hit"), F.col(n).cast(matches.schema[c].dataType)).otherwise(F.col(c)))
    return rows.select(*matches.columns)


def set_map_results(match_maps: DataFrame, payloads: DataFrame) -> DataFrame:
    """The six scores from the payloads where (match, map) is known."""
    rows = payloads.select(F.col("matchID").alias("match_id"), F.explode("results").alias("r"))
    names = {f"team{n}_{s}score": f"r.team{n}{S}Score" for n in (1, 2) for s, S in (("", ""), ("t_", "T"), ("ct_", "CT"))}
    new = rows.select("match_id", F.col("r.mapID").alias("map_id"), *[F.col(there).alias(f"_{c}") for c, there in names.items()], F.lit(True).alias("_hit")).dropDuplicates(["match_id", "map_id"])
    out = match_maps.join(new, ["match_id", "map_id"], "left")
    for c in names:
        out = out.withColumn(c, F.when(F.col("_hit"), F.col(f"_{c}")).otherwise(F.col(c)))
    return out.select(*match_maps.columns)


def upsert_events(events: DataFrame, event_types: DataFrame, locations: DataFrame, new_events: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(events, event_types, locations) with what is new; an event whose page is known is skipped, and of those with
    one page the first (by ``seq``) counts. new_events: event_name, prize_pool, start_date, end_date, event_type,
    location, page_url, seq."""
    types = ensure_names(event_types, new_events.select("event_type"), "event_type_id", "event_type")
    places = ensure_names(locations, new_events.select("location"), "location_id", "location")
    first = F.row_number().over(Window.partitionBy("page_url").orderBy("seq"))
    rows = new_events.withColumn("_n", F.when(F.col("page_url").isNull(), 1).otherwise(first)).where("_n = 1").drop("_n")
    rows = rows.join(types, "event_type", "left").join(places, "location", "left").join(events.select("page_url"), "page_url", "left_anti")
    return appended(events, with_ids(rows, events, "event_id", ["seq"])), types, places


def insert_event_teams(event_teams: DataFrame, teams: DataFrame, new_event_teams: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(event_teams, teams) from rows (event_id, teams array<string>). Names compare without regard to case; of
    teams that differ by case the smallest id counts, and new names that do make one team."""
    named = new_event_teams.select("event_id", F.explode("teams").alias("team_name")).where("team_name IS NOT NULL").withColumn("_key", F.lower("team_name"))
    known = teams.groupBy(F.lower("team_name").alias("_key")).agg(F.min("team_id").alias("team_id"))
    fresh = named.join(known, "_key", "left_anti").groupBy("_key").agg(F.min("team_name").alias("team_name"))
    all_teams = appended(teams, with_ids(fresh, teams, "team_id", ["team_name"]))
    ids = all_teams.groupBy(F.lower("team_name").alias("_key")).agg(F.min("team_id").alias("team_id"))
    new = named.join(ids, "_key").select("event_id", "team_id").distinct().join(event_teams, ["event_id", "team_id"], "left_anti")
    if "event_team_id" in event_teams.columns:
        new = with_ids(new, event_teams, "event_team_id", ["event_id", "team_id"])
    return appended(event_teams, new), all_teams


def insert_matches(matches: DataFrame, teams: DataFrame, new_matches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(matches, teams) with rows (event_id, team1, team2, page_url, best_of) appended; pages may repeat."""
    all_teams = ensure_names(teams, new_matches.select("team1").union(new_matches.select("team2")), "team_id", "team_name")
    rows = new_matches
    for n in (1, 2):
        rows = rows.join(all_teams.select(F.col("team_name").alias(f"team{n}"), F.col("team_id").alias(f"team{n}_id")), f"team{n}", "left")
    return appended(matches, with_ids(rows, matches, "match_id", ["event_id", "page_url", "team1", "team2"])), all_teams


def insert_rankings(rankings: DataFrame, teams: DataFrame, new_rankings: DataFrame, run_ts: datetime) -> tuple[DataFrame, DataFrame]:
    """(rankings, teams) with a snapshot appended; rows without a date get the run's, one for all."""
    all_teams = ensure_names(teams, new_rankings.select("team_name"), "team_id", "team_name")
    kind = rankings.schema["ranking_date"].dataType
    rows = new_rankings.join(all_teams, "team_name").withColumn("ranking_date", F.coalesce(F.col("ranking_date").cast(kind), F.lit(run_ts).cast(kind)))
    if "ranking_id" in rankings.columns:
        rows = with_ids(rows, rankings, "ranking_id", ["ranking_date", "rank", "team_name"])
    return appended(rankings, rows), all_teams


def resolve_parquet_files(files: DataFrame, conversion_jobs: DataFrame, download_jobs: DataFrame, match_maps: DataFrame, map_ids: dict[str, int] | None = None) -> DataFrame:
    """(job_id, match_map_id, patch_version, path) of files (job_id, map_name, patch_version, path) through
    conversion_jobs (job_id, download_job_id) and download_jobs (download_job_id, match_id). A map that is not known is an
    error."""
    number = lookup(map_ids or RECORDED_MAP_IDS, F.lower(F.trim("map_name")))
    known = F.when(number.isNotNull(), number).otherwise(F.raise_error(F.concat(F.lit("no such map: "), F.coalesce("map_name", F.lit("null")))))
    rows = files.withColumn("map_id", known.cast("int")).join(conversion_jobs, "job_id").join(download_jobs, "download_job_id")
    return rows.join(match_maps.select("match_map_id", "match_id", "map_id"), ["match_id", "map_id"]).select("job_id", "match_map_id", "patch_version", "path")


def combine_rankings(primary: DataFrame, secondary: DataFrame | None = None) -> DataFrame:
    """(name, points, rank, vrs_points, vrs_rank) of two lists (name, points, rank[, seq]) by exact name; of a name
    that repeats on the second side the last (by seq) counts. Without a second list its columns are null."""
    if secondary is None:
        return primary.select("name", "points", "rank", F.lit(None).cast("int").alias("vrs_points"), F.lit(None).cast("int").alias("vrs_rank"))
    order: Column = F.col("seq") if "seq" in secondary.columns else F.col("rank")
    last = secondary.groupBy("name").agg(F.max_by("points", order).alias("vrs_points"), F.max_by("rank", order).alias("vrs_rank"))
    return primary.select("name", "points", "rank").join(last, "name").select("name", "points", "rank", "vrs_points", "vrs_rank")


def ranking_date_spine(spark: SparkSession, start: date = date(2023, 10, 16), end: date | None = None, secondary_from: date = date(2024, 1, 1)) -> DataFrame:
    """(date, day, month, year, secondary) every seven days from start; the second list exists from secondary_from."""
    last = F.lit(end) if end else F.current_date()
    dates = spark.range(1).select(F.explode(F.sequence(F.lit(start), last, F.expr("interval 7 days"))).alias("date"))
    return dates.select("date", F.dayofmonth("date").alias("day"), F.lower(F.date_format("date", "MMMM")).alias("month"), F.year("date").alias("year"), (F.col("date") >= F.lit(secondary_from)).alias("secondary"))


def load_match_payload(tables: dict[str, DataFrame], payloads: DataFrame, largest: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """All tables after the payloads: page, vetoes and maps, results, players and their lines, in this order. The
    tables aren't written here; a caller that stages and swaps them loads all or nothing. Payloads and their lines are
    written once, as six tables read them. largest: the tables' largest numbers, where only parts of them are given."""
    top = (largest or {}).get if largest is not None else lambda name, _: None
    payloads = written(payloads, "payloads")
    flat = written(flatten_player_stats(payloads), "stat-lines")
    out = dict(tables)
    out["matches"] = update_match_page(tables["matches"], payloads)
    out["match_veto"] = replace_match_vetoes(tables["match_veto"], payloads, tables["teams"], top("match_veto", 0))
    out["match_maps"] = set_map_results(insert_played_maps(tables["match_maps"], payloads, top("match_maps", 0)), payloads)
    out["players"] = ensure_players(tables["players"], flat, top("players", 0))
    out["match_players"] = insert_match_players(tables["match_players"], flat, tables["teams"], out["players"])
    out["player_stats"] = insert_player_stats(tables["player_stats"], flat, tables["teams"], out["players"], out["match_maps"], top("player_stats", 0))
    return out

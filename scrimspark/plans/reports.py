"""Reports: current ranking, teams, rosters, and per-map veto and win records for one team or for all."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookups import BAN, PICK, REMAINING

SCORES = ("score", "t_score", "ct_score")


def current_ranking(rankings: DataFrame, teams: DataFrame, top_x: int = 10, vrs: bool = False) -> DataFrame:
    """(ranking_date, team_name, rank, points) of the latest snapshot, best rank first. The scalar maximum is one
    row, so its join is a broadcast whatever the tables' sizes."""
    if top_x <= 0:
        raise ValueError("top_x must be positive")
    rank, points = ("vrs_rank", "vrs_points") if vrs else ("rank", "points")
    latest = rankings.agg(F.max("ranking_date").alias("ranking_date"))
    rows = rankings.join(F.broadcast(latest), "ranking_date").join(teams, "team_id")
    return rows.select("ranking_date", "team_name", F.col(rank).alias("rank"), F.col(points).alias("points")).orderBy(F.col("rank").asc_nulls_last(), "team_name").limit(top_x)


def teams_by_presence(rankings: DataFrame, teams: DataFrame, rank_below: int = 20) -> DataFrame:
    """R2: (team_name, team_id, snapshots), most often ranked above rank_below first, then by id."""
    counts = rankings.where(F.col("rank") < rank_below).groupBy("team_id").agg(F.count(F.lit(1)).alias("snapshots"))
    return counts.join(teams, "team_id").select("team_name", "team_id", "snapshots").orderBy(F.desc("snapshots"), "team_id")


def match_roster(match_players: DataFrame, players: DataFrame, teams: DataFrame, match_id: int | None = None) -> DataFrame:
    """The players of one match, or of all, with their teams."""
    rows = match_players if match_id is None else match_players.where(F.col("match_id") == match_id)
    return rows.join(players, "player_id").join(teams, "team_id").select("match_id", "team_id", "team_name", "player_id", "alias", "steamid").orderBy("match_id", "team_id", "player_id")


def default_window(from_date: date | None, to_date: date | None, as_of: date) -> tuple[date, date]:
    """The given bounds, or the three months up to as_of if either is missing."""
    if from_date is not None and to_date is not None:
        return from_date, to_date
    month = as_of.month - 4
    year, month = as_of.year + month // 12, month % 12 + 1
    for day in range(as_of.day, 0, -1):  # the last day that this month has
        try:
            return date(year, month, day), as_of
        except ValueError:
            continue
    raise AssertionError


def within(from_date: date, to_date: date) -> Column:
    """matchdate is a time and the bounds are dates, so a match after midnight of the last day is out."""
    return (F.col("match_date") >= F.lit(from_date)) & (F.col("match_date") <= F.lit(to_date))


def map_pool(matches: DataFrame, veto: DataFrame, from_date: date, to_date: date) -> DataFrame:
    """(map_id) that appear in any veto of the window."""
    return veto.join(matches.where(within(from_date, to_date)).select("match_id"), "match_id", "left_semi").select("map_id").distinct()


def team_match_maps(matches: DataFrame, match_maps: DataFrame, from_date: date, to_date: date, team_id: int | None = None) -> DataFrame:
    """Each played map from each side's view: (match_id, team_id, map_id, own_*, other_*), distinct. The matches are
    joined once; the two views come from the joined row."""
    played = matches.where(within(from_date, to_date)).select("match_id", "team1_id", "team2_id")
    if team_id is not None:
        played = played.where((F.col("team1_id") == team_id) | (F.col("team2_id") == team_id))

    def view(own: int, other: int) -> Column:
        scores = [F.col(f"team{n}_{s}").alias(f"{who}_{s}") for who, n in (("own", own), ("other", other)) for s in SCORES]
        return F.struct(F.col(f"team{own}_id").alias("team_id"), *scores)

    rows = played.join(match_maps, "match_id").select("match_id", "map_id", F.explode(F.array(view(1, 2), view(2, 1))).alias("v")).select("match_id", "map_id", "v.*")
    rows = rows.where("team_id IS NOT NULL") if team_id is None else rows.where(F.col("team_id") == team_id)
    return rows.distinct()


def map_record(team_maps: DataFrame) -> DataFrame:
    """(team_id, map_id) with round differences, wins and games of scored maps. A tie is neither won nor lost, so
    wins is null where every game was a tie."""
    won = F.when(F.col("own_score") > F.col("other_score"), 1).when(F.col("own_score") < F.col("other_score"), 0)
    return (
        team_maps.where("own_score IS NOT NULL")
        .groupBy("team_id", "map_id")
        .agg(
            F.sum(F.col("own_score") - F.col("other_score")).alias("round_dif"),
            F.sum(F.col("own_ct_score") - F.col("other_ct_score")).alias("ct_round_dif"),
            F.sum(F.col("own_t_score") - F.col("other_t_score")).alias("t_round_dif"),
            F.sum(won).alias("wins"),
            F.count(F.lit(1)).alias("times_played"),
        )
    )


def pick_ban_totals(veto: DataFrame, team_maps: DataFrame, maps: DataFrame, pool: DataFrame) -> DataFrame:
    """(team_id, map_id, map_name, pick_total, ban_total, remaining_total) for each team of team_maps and each map
    of the pool. A veto row counts for its own team, or, left over, for both teams of its match."""
    present = team_maps.select("match_id", F.col("team_id").alias("viewer")).distinct()
    seen = veto.join(present, "match_id").where(F.col("team_id").isNull() | (F.col("team_id") == F.col("viewer")))
    totals = seen.groupBy("viewer", "map_id").agg(*[F.sum(F.when(F.col("action_id") == a, 1).otherwise(0)).alias(n) for a, n in ((PICK, "pick_total"), (BAN, "ban_total"), (REMAINING, "remaining_total"))])
    # at most eleven maps for each team, so the product is bounded by the fixed list of maps
    grid = present.select("viewer").distinct().crossJoin(F.broadcast(maps.join(pool, "map_id", "left_semi")))
    rows = grid.join(totals, ["viewer", "map_id"], "left")
    return rows.select(F.col("viewer").alias("team_id"), "map_id", "map_name", *[F.coalesce(n, F.lit(0).cast("long")).alias(n) for n in ("pick_total", "ban_total", "remaining_total")])


def veto_report_all_teams(matches: DataFrame, match_maps: DataFrame, veto: DataFrame, maps: DataFrame, from_date: date, to_date: date, team_id: int | None = None) -> DataFrame:
    """The veto report of every team in one pass: R4 to R7 with (team_id, map_id) as the key."""
    team_maps = team_match_maps(matches, match_maps, from_date, to_date, team_id)
    totals = pick_ban_totals(veto, team_maps, maps, map_pool(matches, veto, from_date, to_date))
    rows = totals.join(map_record(team_maps), ["team_id", "map_id"], "left")
    share = F.round(F.col("wins").cast("decimal(20,0)") / F.nullif(F.col("times_played"), F.lit(0)).cast("decimal(20,0)"), 4)
    return rows.select("team_id", "map_name", "pick_total", "ban_total", "remaining_total", "round_dif", "ct_round_dif", "t_round_dif", "wins", "times_played", share.cast("double").alias("win_pct"))


def veto_report(matches: DataFrame, match_maps: DataFrame, veto: DataFrame, maps: DataFrame, from_date: date, to_date: date, team_id: int) -> DataFrame:
    """The veto report of one team, by map name; a team without matches has its pool with zeros."""
    report = veto_report_all_teams(matches, match_maps, veto, maps, from_date, to_date, team_id).drop("team_id")
    pool = maps.join(map_pool(matches, veto, from_date, to_date), "map_id", "left_semi").select("map_name")
    zero = F.lit(0).cast("long")
    rows = pool.join(report, "map_name", "left")
    return rows.select("map_name", *[F.coalesce(n, zero).alias(n) for n in ("pick_total", "ban_total", "remaining_total")], "round_dif", "ct_round_dif", "t_round_dif", "wins", "times_played", "win_pct").orderBy("map_name")

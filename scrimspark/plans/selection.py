"""Selection queries: what to fetch or follow next."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.as_of import as_of


@dataclass(frozen=True)
class NameRule:
    """An event's name holds ``part`` and none of ``but``."""

    part: str
    but: tuple[str, ...] = ()

    def holds(self, name: Column) -> Column:
        found = F.contains(name, F.lit(self.part))
        for x in self.but:
            found = found & ~F.contains(name, F.lit(x))
        return found


#: Series that are always followed.
NAME_RULES = (NameRule("BLAST"), NameRule("IEM", ("Qualifier",)), NameRule("Major", ("Open Qualifier",)), NameRule("ESL Pro League", ("Qualifier",)))


def high_value_events(events: DataFrame, event_teams: DataFrame, name_rules: tuple[NameRule, ...] = NAME_RULES, min_prize_len: int = 8) -> DataFrame:
    """Q1: (event_id, page_url) of undecided events without teams that have a large prize or a name that a rule wants,
    latest start first; a null start comes before all. One scan: the union of the two conditions is an OR, and the
    selected columns are then made distinct."""
    named = F.lit(False)
    for rule in name_rules:
        named = named | F.coalesce(rule.holds(F.col("event_name")), F.lit(False))
    prized = F.coalesce(F.contains("prize_pool", F.lit("$")) & (F.length("prize_pool") >= min_prize_len), F.lit(False))
    wanted = events.where(F.col("download_event").isNull() & (named | prized)).select("event_id", "page_url", "start_date", "download_event").distinct()
    return wanted.join(event_teams, "event_id", "left_anti").orderBy(F.desc_nulls_first("start_date"), "event_id").select("event_id", "page_url")


def latest_rank(events: DataFrame, event_teams: DataFrame, rankings: DataFrame) -> DataFrame:
    """(event_id, team_id, rank): each attending team's rank in its latest snapshot up to the event's start; of snapshots
    with one date the better rank counts. A team without a snapshot by then is left out."""
    pairs = event_teams.join(events.select("event_id", "start_date"), "event_id").where("start_date IS NOT NULL").select("event_id", "team_id", "start_date")
    worst_first = -F.coalesce(F.col("rank"), F.lit(2147483647))
    found = as_of(pairs, rankings.select("team_id", F.col("ranking_date").cast("timestamp").alias("ranking_date"), "rank"), "team_id", "start_date", "ranking_date", [worst_first])
    return found.where("ranking_date IS NOT NULL").select("event_id", "team_id", "rank")


def mark_events_for_download(events: DataFrame, event_teams: DataFrame, rankings: DataFrame, max_rank: int = 10) -> DataFrame:
    """Q2: events with download_event set where it was undecided and any attending team was ranked well at its start."""
    open_ = events.where("download_event IS NULL")
    good = latest_rank(open_, event_teams, rankings).where(F.col("rank") <= max_rank).select("event_id").distinct().withColumn("_good", F.lit(True))
    return events.join(good, "event_id", "left").withColumn("download_event", F.when(F.col("download_event").isNull() & F.col("_good"), True).otherwise(F.col("download_event"))).select(*events.columns)


def results_pages(events: DataFrame, matches: DataFrame, prefix: str, page_pattern: str) -> DataFrame:
    """Q3: (event_id, page_url) of the results page of each followed event that has no match yet. page_pattern: matches
    an event's page as a whole; its first group is the event's number."""
    rows = events.where("download_event").join(matches.select("event_id"), "event_id", "left_anti")
    return rows.select("event_id", F.concat(F.lit(prefix), F.regexp_replace("page_url", F.lit(page_pattern), F.lit("$1"))).alias("page_url"))


def pending_match_pages(matches: DataFrame) -> DataFrame:
    """Q4: (match_id, page_url) of matches whose page was not read yet."""
    return matches.where("demo_link IS NULL").select("match_id", "page_url")


def matches_missing_scores(matches: DataFrame, match_maps: DataFrame) -> DataFrame:
    """Q5: (match_id, page_url) of matches without a scored map."""
    scored = match_maps.where("team1_score IS NOT NULL").select("match_id")
    return matches.join(scored, "match_id", "left_anti").select("match_id", "page_url")

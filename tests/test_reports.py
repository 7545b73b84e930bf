from __future__ import annotations

from datetime import date, datetime

import pytest

from scrimspark.functions.lookups import maps_table
from scrimspark.plans import reports as R
from scrimspark.plans import selection as Q

FROM, TO = date(2024, 1, 1), date(2024, 1, 31)
MAP = "match_id int, map_id int, team1_score int, team2_score int, team1_t_score int, team1_ct_score int, team2_t_score int, team2_ct_score int"


@pytest.fixture
def world(spark):
    matches = spark.createDataFrame(
        [(1, 10, 20, datetime(2024, 1, 5)), (2, 20, 10, datetime(2024, 1, 31, 0, 0)), (3, 10, 30, datetime(2024, 1, 31, 15, 0)), (4, 10, 30, datetime(2024, 1, 9))],
        "match_id int, team1_id int, team2_id int, match_date timestamp_ntz",
    )
    maps = spark.createDataFrame(
        [(1, 1, 13, 5, 7, 6, 2, 3), (1, 2, 8, 8, 4, 4, 4, 4), (2, 1, 13, 9, 6, 7, 5, 4), (3, 1, 13, 0, 6, 7, 0, 0), (4, 3, None, None, 0, 0, 0, 0)], MAP
    )
    veto = spark.createDataFrame(
        [(1, 1, 10, 2, 4), (1, 2, 20, 1, 1), (1, 3, None, 3, 2), (2, 1, 10, 1, 1), (3, 1, 10, 1, 5), (4, 1, 30, 1, 3)],
        "match_id int, step int, team_id int, action_id int, map_id int",
    )
    return matches, maps, veto, maps_table(spark)


def test_window_ends_at_midnight(world):
    matches, maps, *_ = world
    seen = {r.match_id for r in R.team_match_maps(matches, maps, FROM, TO).collect()}
    assert seen == {1, 2, 4}  # match 3 is after midnight of the last day


def test_veto_report_of_one_team(world):
    rows = {r.map_name: r for r in R.veto_report(*world, FROM, TO, 10).collect()}
    assert set(rows) == {"Mirage", "Inferno", "Nuke", "Overpass"}
    mirage = rows["Mirage"]
    assert (mirage.pick_total, mirage.ban_total, mirage.wins, mirage.times_played, mirage.win_pct) == (1, 0, 1, 2, 0.5)
    assert (mirage.round_dif, mirage.t_round_dif, mirage.ct_round_dif) == (8 - 4, (7 - 2) + (5 - 6), (6 - 3) + (4 - 7))
    assert rows["Inferno"].wins is None and rows["Inferno"].times_played == 1 and rows["Inferno"].remaining_total == 1  # a tie
    assert rows["Nuke"].times_played is None  # no score


def test_team_without_matches_has_its_pool(world):
    rows = R.veto_report(*world, FROM, TO, 99).collect()
    assert len(rows) == 4 and all(r.pick_total == 0 and r.wins is None for r in rows)


def test_all_teams_agree_with_each_team(world):
    whole = R.veto_report_all_teams(*world, FROM, TO).collect()
    for team in (10, 20, 30):
        one = {tuple(r) for r in R.veto_report(*world, FROM, TO, team).collect()}
        assert one == {tuple(r)[1:] for r in whole if r.team_id == team}


def test_current_ranking_orders_before_it_limits(spark):
    rankings = spark.createDataFrame([(1, 50, 2, datetime(2024, 1, 8)), (2, 60, 1, datetime(2024, 1, 8)), (3, 99, 1, datetime(2024, 1, 1))], "team_id int, points int, rank int, ranking_date timestamp_ntz")
    teams = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "team_id int, team_name string")
    assert [r.team_name for r in R.current_ranking(rankings, teams, 1).collect()] == ["b"]
    with pytest.raises(ValueError):
        R.current_ranking(rankings, teams, 0)
    assert R.current_ranking(rankings.limit(0), teams).count() == 0


def test_presence_counts_below_the_bound_only(spark):
    rankings = spark.createDataFrame([(1, 19), (1, 20), (2, 3), (2, 4), (3, None)], "team_id int, rank int")
    teams = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "team_id int, team_name string")
    assert [(r.team_id, r.snapshots) for r in R.teams_by_presence(rankings, teams).collect()] == [(2, 2), (1, 1)]


def test_default_window():
    assert R.default_window(None, TO, date(2024, 5, 31)) == (date(2024, 2, 29), date(2024, 5, 31))
    assert R.default_window(FROM, TO, date(2024, 5, 31)) == (FROM, TO)
    assert R.default_window(FROM, None, date(2024, 1, 15)) == (date(2023, 10, 15), date(2024, 1, 15))


def test_high_value_events(spark):
    events = spark.createDataFrame(
        [
            (1, "Small", "$10,000", "u1", datetime(2024, 1, 1), None),
            (2, "Large", "$100,000", "u2", datetime(2024, 1, 2), None),
            (3, "IEM X Qualifier", "Spot", "u3", datetime(2024, 1, 3), None),
            (4, "IEM X", "Spot", "u4", None, None),
            (5, "BLAST", "$900,000", "u5", datetime(2024, 1, 5), False),
            (6, "BLAST Y", None, "u6", datetime(2024, 1, 6), None),
            (7, None, None, "u7", datetime(2024, 1, 7), None),
        ],
        "event_id int, event_name string, prize_pool string, page_url string, start_date timestamp, download_event boolean",
    )
    teams = spark.createDataFrame([(6, 1)], "event_id int, team_id int")
    assert [r.event_id for r in Q.high_value_events(events, teams).collect()] == [4, 2]


def test_mark_events_uses_the_latest_ranking_up_to_the_start(spark):
    start = datetime(2024, 2, 1)
    events = spark.createDataFrame([(1, start, None), (2, start, None), (3, start, False), (4, None, None), (5, start, None)], "event_id int, start_date timestamp, download_event boolean")
    teams = spark.createDataFrame([(1, 1), (2, 2), (3, 1), (4, 1), (5, 3)], "event_id int, team_id int")
    rankings = spark.createDataFrame(
        [(1, 30, datetime(2024, 1, 1)), (1, 10, start), (2, 1, datetime(2024, 1, 1)), (2, 11, datetime(2024, 1, 31)), (3, 1, datetime(2024, 2, 2))], "team_id int, rank int, ranking_date timestamp"
    )
    marked = {r.event_id: r.download_event for r in Q.mark_events_for_download(events, teams, rankings).collect()}
    assert marked == {1: True, 2: None, 3: False, 4: None, 5: None}


def test_no_product_in_the_plan(world):
    plan = R.veto_report_all_teams(*world, FROM, TO)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan

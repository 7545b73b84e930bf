"""As-of joins, pairing within a tolerance, player lookups, file layout, buckets and databases."""

from __future__ import annotations

import itertools
import re
import uuid
from datetime import datetime, timedelta

import numpy as np
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from scrimspark.operators import telemetry as T
from scrimspark.operators import validation as V
from scrimspark.operators.as_of import as_of
from scrimspark.operators.matching import most_pairs, near
from scrimspark.plans import reports as R
from scrimspark.plans import selection as Q
from scrimspark.schemas import TABLES
from scrimspark.sources import frames as S

rng = np.random.default_rng(5)


def executed(df) -> str:
    """The plan as it is before anything runs, its subqueries and reused exchanges included."""
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> list[str]:
    return re.findall(r"Exchange hashpartitioning\([^)]*\)|Exchange rangepartitioning[^\n]*|BroadcastExchange", executed(df))


# as-of -------------------------------------------------------------------------------------------------------------


def histories():
    """Snapshots and questions with ties and nulls; one team has nine tenths of the rows."""
    team = lambda: None if rng.random() < 0.03 else 1 if rng.random() < 0.9 else int(rng.integers(2, 9))
    when = lambda: None if rng.random() < 0.03 else datetime(2024, 1, 1) + timedelta(days=int(rng.integers(0, 300)))
    snapshots = [(team(), when(), None if rng.random() < 0.1 else int(rng.integers(1, 40))) for _ in range(1500)]
    asked = [(i, team(), when()) for i in range(1500)] + [(9000, 50, datetime(2024, 5, 5))]
    return snapshots, asked


@pytest.mark.parametrize("ranges", [1, 7])
def test_as_of(spark, ranges):
    snapshots, asked = histories()
    left = spark.createDataFrame(asked, "id int, team long, at timestamp")
    right = spark.createDataFrame(snapshots, "team int, day timestamp, rank int")
    spark.conf.set("spark.sql.shuffle.partitions", ranges)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = as_of(left, right, "team", "at", "day", [-F.coalesce("rank", F.lit(99))])
        got = {r.id: (r.day, r.rank) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", 4)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len(got) == len(asked)
    for i, team, at in asked:
        known = [(d, -(99 if r is None else r), r) for t, d, r in snapshots if team is not None and at is not None and t == team and d is not None and d <= at]
        best = max(known, key=lambda k: k[:2]) if known else (None, None, None)
        assert got[i] == (best[0], best[2])


def test_as_of_keeps_clashing_names_apart(spark):
    a = spark.createDataFrame([(1, 1, 5)], "k int, t int, v int")
    with pytest.raises(ValueError, match="both sides have"):
        as_of(a, a, "k", "t", "t")
    assert as_of(a.limit(0), spark.createDataFrame([(1, 2)], "k int, u int"), "k", "t", "u").collect() == []
    assert [tuple(r) for r in as_of(a, spark.createDataFrame([], "k int, u int"), "k", "t", "u").collect()] == [(1, 1, 5, None)]


def test_histories_are_never_joined(spark):
    events = spark.createDataFrame([(1, datetime(2024, 1, 2), None)], "event_id int, start_date timestamp, download_event boolean")
    teams = spark.createDataFrame([(1, 1)], "event_id int, team_id int")
    rankings = spark.createDataFrame([(1, 3, datetime(2024, 1, 2))], "team_id int, rank int, ranking_date timestamp_ntz")
    made = Q.latest_rank(events, teams, rankings)
    assert [tuple(r) for r in made.collect()] == [(1, 1, 3)]
    assert "ranking_date" not in " ".join(re.findall(r"\bJoin \w+, \([^\n]*", made._jdf.queryExecution().analyzed().toString()))
    # only one small row for each team and range is joined, and no window is without a partition
    for windows in re.findall(r"Window \[[^\n]*", executed(made)):
        assert re.search(r"windowspecdefinition\(_k", windows)


# pairing -----------------------------------------------------------------------------------------------------------


def largest_by_permutation(a, b, tol):
    if len(a) > len(b):
        a, b = b, a
    return max(sum(near(x, y, tol) for x, y in zip(a, order, strict=False)) for order in itertools.permutations(b, len(a)))


VALUE = st.one_of(st.integers(-6, 6).map(float), st.just(float("nan")), st.just(float("inf")))


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 3), st.data(), st.sampled_from([0.0, 1.0, 2.5]))
def test_pairs_are_as_many_as_any_permutation_gives(width, data, tol):
    side = st.lists(st.lists(VALUE, min_size=width, max_size=width), min_size=1, max_size=5)
    a, b = np.array(data.draw(side)), np.array(data.draw(side))
    pairs = most_pairs(a, b, tol)
    assert len({i for i, _ in pairs}) == len({j for _, j in pairs}) == len(pairs)
    assert all(near(a[i], b[j], tol) for i, j in pairs)
    assert len(pairs) == largest_by_permutation(list(a), list(b), tol)


def test_many_equal_rows_are_one_node():
    a, b = np.repeat([[0.0, 0.0], [3.0, 0.0]], 20_000, axis=0), np.repeat([[2.0, 0.0], [6.0, 0.0]], 20_000, axis=0)
    assert len(most_pairs(a, b, 3.0)) == 40_000


def test_two_inexact_columns(spark):
    a = spark.createDataFrame([(0.0, 100.0), (3.0, 0.0)], "x double, y double")
    b = spark.createDataFrame([(2.0, 0.0), (4.0, 100.0)], "x double, y double")
    assert V.frames_equal(a, b).count() == 0
    assert [tuple(r) for r in V.frames_equal(a, b, 3.0).collect()] == [("both", 0.0, 4.0, 100.0, 100.0)]
    # no window without a partition, and only one small row for each key and range in one
    assert all("_range" in w and re.search(r"\], \[_key", w) for w in re.findall(r"Window \[[^\n]*", executed(V.frames_equal(a, b))))


def test_frames_by_pieces_equal_one_matching(spark):
    """Random frames, with one exact column whose hot value has most rows: what is left over is as little as possible."""
    rows = [(int(rng.integers(0, 3)) if rng.random() < 0.3 else 7, *[None if rng.random() < 0.05 else float(rng.integers(0, 400)) for _ in range(2)]) for _ in range(700)]
    moved = [(k, *[None if x is None else x + float(rng.integers(-6, 7)) for x in v]) for k, *v in rows[40:]]
    a, b = (spark.createDataFrame(r, "k int, x double, y double").repartition(3) for r in (rows, moved))
    out = V.frames_equal(a, b, 5.0).collect()
    left_over = {s: sum(r.side in (s, "both") for r in out) for s in ("left", "right")}
    want = {"left": 0, "right": 0}
    for k in (0, 1, 2, 7):
        x, y = (np.array([[np.nan if c is None else c for c in v] for kk, *v in r if kk == k]) for r in (rows, moved))
        n = len(most_pairs(x, y, 5.0))
        want = {"left": want["left"] + len(x) - n, "right": want["right"] + len(y) - n}
    assert left_over == want


def test_exact_frames_are_multisets(spark):
    a, b = (spark.createDataFrame([(x, [x]) for x in r], "k int, l array<int>") for r in ([1, 1, 2, None], [1, 3, None]))
    assert sorted(r.side + r.k for r in V.frames_equal(a, b).collect()) == ['left{"k":1}', 'left{"k":2}', 'right{"k":3}']


# player state ------------------------------------------------------------------------------------------------------

STATE = "match_id int, map_name string, tick long, steamid string, seq int, health int, team_name string"
EVENTS = "match_id int, map_name string, tick long, event_type string, seq int, attacker_steamid string, user_steamid string, user_health int"


def test_one_lookup_serves_all_roles(spark):
    state = spark.createDataFrame([(1, "m", 4, "a", 2, 40, "CT"), (1, "m", 4, "a", 1, 41, "T"), (1, "m", 4, "b", 3, None, "T"), (1, "m", 5, "a", 4, 50, "CT"), (1, "m", 0, "a", 5, 7, "T"), (1, "m", 4, None, 6, 1, "T"), (2, "m", 4, "a", 7, 99, "T")], STATE)
    events = spark.createDataFrame([(1, "m", 5, "hit", 1, "a", "b", 3), (1, "m", 5, "inferno_expire", 2, "a", None, 3), (1, "m", 0, "hit", 3, "a", "z", 3), (1, None, 5, "hit", 4, "a", "b", 3), (1, "m", None, "hit", 5, "a", "a", 3)], EVENTS)
    out = T.enrich_players(events, state, props=["health", "team_name"])
    got = {r.seq: (r.attacker_health, r.attacker_team_name, r.user_health, r.user_team_name) for r in out.collect()}
    assert got == {1: (41, "T", 3, "T"), 2: (50, "CT", 3, None), 3: (7, "T", 3, None), 4: (None, None, 3, None), 5: (None, None, 3, None)}
    assert out.columns == [*events.columns, "attacker_health", "attacker_team_name", "user_team_name"]


def test_events_and_state_are_dealt_once(spark):
    ticks = spark.range(1000).selectExpr("CAST(id % 2 AS INT) AS match_id", "concat('m', id % 3) AS map_name", "id AS tick", "CAST(id % 10 AS STRING) AS steamid", "CAST(id AS INT) AS seq", "1 AS health", "'T' AS team_name")
    hits = spark.range(50).selectExpr("CAST(id % 2 AS INT) AS match_id", "concat('m', id % 3) AS map_name", "id AS tick", "'hit' AS event_type", "CAST(id AS INT) AS seq", "'1' AS attacker_steamid", "'2' AS user_steamid", "'3' AS assister_steamid")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        out = T.enrich_players(hits, ticks, props=["health"])
        plan = executed(out)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # events: by tick for the lookup, and their distinct ticks; state: once, by tick
    wide = [line for line in plan.split("\n") if "Exchange hashpartitioning" in line]
    assert len(wide) == 3 and "steamid" not in "".join(wide), plan
    assert plan.count("SortMergeJoin") == 2 and plan.index("LeftSemi") > plan.index("Aggregate")  # the semi join stands below the grouping


def test_views_take_one_pass(spark):
    rows = [(1, "m", "player_death", 1, None, 5, None), (1, "m", "bomb_planted", None, 2, None, None), (1, "m", "bomb_defused", None, None, 3, None)]
    frame = spark.createDataFrame(rows, "match_id int, map_name string, event_type string, a int, b int, c int, d int")
    status = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("views", "views")
    views = T.event_views(frame)
    jobs = len(status.getJobIdsForGroup("views"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 2  # one action; adaptive execution runs its stages as jobs
    assert {n: v.columns[3:] for n, v in views.items() if n in ("kills", "bomb", "smokes")} == {"kills": ["a", "c"], "bomb": ["b", "c"], "smokes": ["a", "b", "c", "d"]}
    assert views["bomb"].count() == 2 and T.event_view(frame, "kills").columns == views["kills"].columns


# layout ------------------------------------------------------------------------------------------------------------


def test_frames_are_laid_out_by_tick(spark, tmp_path):
    """A map with nine tenths of the rows is several tasks' work, and a condition on ticks skips files."""
    rows = spark.range(100_000).selectExpr("1 AS match_id", "CASE WHEN id % 10 = 0 THEN concat('m', id % 30) ELSE 'hot' END AS map_name", "(id * 7919) % 100000 AS tick", "CAST(id % 10 AS STRING) AS steamid").repartition(6)
    S.write_frames(rows, str(tmp_path / "f"), rows_per_file=10_000)
    hot = sorted((tmp_path / "f" / "match_id=1" / "map_name=hot").glob("*.parquet"))
    assert len({re.match(r"part-(\d+)", f.name)[1] for f in hot}) >= 6
    spans, sizes = [], []
    for f in hot:
        meta = pq.ParquetFile(f).metadata
        sizes.append(meta.num_rows)
        stats = [meta.row_group(i).column(0).statistics for i in range(meta.num_row_groups)]
        spans.append((min(s.min for s in stats), max(s.max for s in stats)))
    assert max(sizes) <= 10_000 and sum(sizes) == 90_000
    assert sum(low <= 50_500 and high >= 50_000 for low, high in spans) <= 2
    assert S.read_frames(spark, str(tmp_path / "f")).count() == 100_000
    S.write_frames(rows.limit(0), str(tmp_path / "none"))


def test_buckets_save_the_joins_exchanges(spark, tmp_path):
    match = "match_id int, team1_id int, team2_id int, match_date timestamp"
    matches = spark.createDataFrame([(i, i % 4, (i + 1) % 4, datetime(2024, 1, 1)) for i in range(40)], match)
    maps = spark.createDataFrame([(i, i % 3, 13, 5, 7, 6, 2, 3) for i in range(40)], "match_id int, map_id int, team1_score int, team2_score int, team1_t_score int, team1_ct_score int, team2_t_score int, team2_ct_score int")
    veto = spark.createDataFrame([(i, 1, i % 4, 1, i % 3) for i in range(40)], "match_id int, step int, team_id int, action_id int, map_id int")
    names = spark.createDataFrame([(0, "a"), (1, "b"), (2, "c")], "map_id int, map_name string")
    there = S.write_bucketed({"matches": matches, "match_maps": maps, "match_veto": veto}, f"{tmp_path}/t-{uuid.uuid4().hex}", buckets=4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        report = R.veto_report_all_teams(there["matches"], there["match_maps"], there["match_veto"], names, datetime(2023, 1, 1).date(), datetime(2025, 1, 1).date())
        dealt = [x for x in exchanges(report) if "match_id" in x]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert not dealt and exchanges(report)
    plain = R.veto_report_all_teams(matches, maps, veto, names, datetime(2023, 1, 1).date(), datetime(2025, 1, 1).date())
    assert sorted(map(repr, report.collect())) == sorted(map(repr, plain.collect()))


# databases ---------------------------------------------------------------------------------------------------------


def test_tables_from_a_database(spark):
    """All tables, through the database that comes with Spark: schemas, rows, tasks by measured bounds, conditions."""
    url = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true"
    filled = {}
    for name, schema in TABLES.items():
        values = {"int": "CAST(id - 500 AS INT)", "string": "IF(id % 7 = 0, NULL, concat('t ', id))", "timestamp": "TIMESTAMP '2024-01-01 10:00:00'", "timestamp_ntz": "TIMESTAMP_NTZ '2024-01-01 10:00:00'", "boolean": "IF(id % 3 = 0, NULL, id % 2 = 0)", "decimal(5,2)": "CAST(id / 10 AS DECIMAL(5,2))"}
        filled[name] = spark.range(1000).selectExpr(*[f"{values[f.dataType.simpleString()]} AS {f.name}" for f in schema])
        filled[name].write.format("jdbc").options(url=url, dbtable=name).save()
    read = S.load_tables_jdbc(spark, url, rows_per_task=300, where={"players": '"player_id" >= 0'})
    for name, df in read.items():
        assert df.schema.simpleString() == TABLES[name].simpleString()
        assert df.rdd.getNumPartitions() == (2 if name == "players" else 4)
        want = filled[name].where("player_id >= 0") if name == "players" else filled[name]
        assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))
    some = read["matches"].where("match_id = 7").select("match_id")
    assert re.search(r"PushedFilters: \[[^\]]*EqualTo\(match_id,7\)|MATCH_ID.* = 7|\"match_id\" = 7", some._jdf.queryExecution().executedPlan().toString())
    spark.createDataFrame([], TABLES["teams"]).write.format("jdbc").options(url=url, dbtable="teams").mode("overwrite").save()
    assert S.load_tables_jdbc(spark, url, ("teams",))["teams"].count() == 0

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from scrimspark.functions.columns import clean_steamid, frame_file_name
from scrimspark.operators import telemetry as M
from scrimspark.operators import validation as V
from scrimspark.sources import frames as S

TICKS = "match_id int, map_name string, part_id int, tick long, steamid string, health int, team_name string, team_clan_name string, total_rounds_played int, seq int"


def ticks(spark, *rows):
    return spark.createDataFrame([(1, "m", 0, t, s, h, team, clan, 4, i) for i, (t, s, h, team, clan) in enumerate(rows)], TICKS)


def hurt(spark, *rows):
    return spark.createDataFrame([(1, "m", t, "player_hurt", a, v, v, d) for t, a, v, d in rows], "match_id int, map_name string, tick long, event_type string, attacker_name string, player_name string, user_steamid string, dmg_health int")


def test_effective_damage(spark):
    state = ticks(spark, (9, "v", 30, "CT", None), (9, "v", 99, "CT", None))
    rows = [r.effective_damage for r in M.effective_damage(hurt(spark, (10, "a", "v", 50), (10, "a", "w", 50)), state).orderBy("user_steamid").collect()]
    assert rows == [30, 50]  # no more than the health that was left, of the first row; all of it where nothing is known


def test_equal_hits_collapse_unless_told_by_tick(spark):
    damage = M.effective_damage(hurt(spark, (10, "a", "v", 50), (11, "a", "v", 50), (12, None, "v", 9)), ticks(spark))
    assert M.dedupe_damage(damage).count() == 1
    assert M.dedupe_damage(damage, "tick").count() == 2


def test_scoreboard_keeps_players_without_kills(spark):
    deaths = spark.createDataFrame([(1, "m", "A", "b"), (1, "m", None, "c"), (1, "m", "A", "A")], "match_id int, map_name string, attacker_name string, player_name string")
    roster = spark.createDataFrame([(1, "a", "T1"), (1, "B", "T0")], "match_id int, alias string, team_name string")
    board = M.scoreboard(deaths, hurt(spark, (10, "A", "b", 40)), ticks(spark, (1, "x", 100, "CT", None)), roster).collect()
    assert [(r.team_name, r.player, r.kills, r.deaths, r.adr) for r in board] == [("T0", "b", 0, 1, 0.0), ("T1", "a", 2, 1, 10.0), (None, "c", 0, 1, 0.0)]


def test_players_state_is_that_of_the_tick_before(spark):
    state = ticks(spark, (0, "p", 1, "CT", None), (4, "p", 2, "CT", None), (5, "p", 3, "CT", None), (5, "p", 4, "CT", None))
    events = spark.createDataFrame([(1, "m", 5, "player_hurt", "p", None), (1, "m", 5, "inferno_expire", "p", 7), (1, "m", 0, "player_hurt", "p", None), (1, "m", 5, "player_hurt", None, None)], "match_id int, map_name string, tick long, event_type string, user_steamid string, user_team_name int")
    rows = {(r.event_type, r.tick, r.user_steamid): (r.user_health, r.user_team_name) for r in M.enrich_players(events, state).collect()}
    assert rows == {("player_hurt", 5, "p"): (2, None), ("inferno_expire", 5, "p"): (3, 7), ("player_hurt", 0, "p"): (1, None), ("player_hurt", 5, None): (None, None)}


def test_world_state(spark):
    w = M.world_state(ticks(spark, (1, "b", 1, "CT", None), (1, "a", 2, "TERRORIST", "clan"), (1, "c", 3, "CT", "home")), ["total_rounds_played"]).head()
    assert (w.ct_team_name, w.t_team_name, w.ct_team_clan_name, w.t_team_clan_name, w.total_rounds_played) == ("CT", "TERRORIST", "home", "clan", 4)
    events = spark.createDataFrame([(1, "m", 1, "server_cvar", 0), (1, "m", 1, "player_hurt", 0)], "match_id int, map_name string, tick long, event_type string, total_rounds_played int")
    rows = {r.event_type: r.total_rounds_played_world for r in M.enrich_world(events, M.world_state(ticks(spark, (1, "b", 1, "CT", None)), ["total_rounds_played"])).collect()}
    assert rows == {"server_cvar": None, "player_hurt": 4}


def test_parts_follow_each_other(spark):
    parts = spark.createDataFrame([(1, "m", 7, 20, 99), (1, "m", 8, 10, 49)], "match_id int, map_name string, part_id int, total_rounds_played int, max_tick long")
    frame = spark.createDataFrame([(1, "m", 7, 0), (1, "m", 8, 5)], "match_id int, map_name string, part_id int, tick long")
    assert {(r.part_id, r.tick) for r in M.stitch_parts(frame, parts).collect()} == {(8, 5), (7, 50)}


def test_names(spark):
    row = spark.range(1).select(
        frame_file_name(F.lit("/a/x-vs-y-m1-p2.dem"), F.lit("de_nuke")).alias("p"),
        frame_file_name(F.lit("x-vs-y-m1.v2.dem"), F.lit("de_nuke")).alias("q"),
        clean_steamid(F.lit("<NA>")).alias("a"),
        clean_steamid(F.lit(76561198000000001)).alias("b"),
    ).head()
    assert tuple(row) == ("x-vs-y-de_nuke.parquet", "x-vs-y-de_nuke.parquet", None, "76561198000000001")


def test_floors_are_open_below(spark):
    rows = [(1, "m", float(z)) for z in [0] + [150] * 100 + [151] * 99]
    out = M.floor_slices(spark.createDataFrame(rows, "match_id int, map_name string, z double"))
    assert [(r.floor, r["count"]) for r in out.groupBy("floor").count().collect()] == [(0, 100)]


def test_union_resolves_types(spark):
    a = spark.createDataFrame([(1, True, [1])], "n int, b boolean, l array<int>")
    b = spark.createDataFrame([(2.5, 3, None, "x")], "n double, b int, l array<int>, only string")
    c = spark.range(1).select(F.lit(None).alias("n"), F.array().alias("l"))
    out = S.union_resolved([c, a, b])
    assert out.columns == ["n", "l", "b", "only"]
    assert [type(f.dataType) for f in out.schema] == [T.DoubleType, T.ArrayType, T.StringType, T.StringType]
    assert sorted(map(str, (r.b for r in out.collect()))) == ["3", "None", "true"]


def test_frames_equal(spark):
    a = spark.createDataFrame([(1, 1.0), (1, 9.0), (2, None)], "k int, x double")
    b = spark.createDataFrame([(1, 13.9), (1, 2.0), (2, None)], "k int, x double")
    assert V.frames_equal(a, b).count() == 0
    assert [r.side for r in V.frames_equal(a, b.where("x > 2 OR k = 2")).collect()].count("left") == 1
    assert V.frames_equal(a, b, 1.0).count() == 1


def test_event_sets_are_multisets(spark):
    a = spark.createDataFrame([("x",), ("x",), ("grenade_data",), (None,)], "event_type string")
    b = spark.createDataFrame([("x",), ("grenade_data",)], "event_type string")
    assert [tuple(r) for r in V.event_set_diff(a, b).collect()] == [("grenade_data", 1, 0), ("x", 2, 1)] or V.event_set_diff(a, b).count() == 2


def test_bad_payload_lines_are_kept(spark, tmp_path):
    (tmp_path / "p.json").write_text('{"matchID": 5}\nnot json\n')
    assert sorted((r.matchID or 0, r.raw) for r in S.read_payloads(spark, str(tmp_path)).collect()) == [(0, "not json"), (5, '{"matchID": 5}')]

from __future__ import annotations

from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from scrimspark.operators import warehouse as W
from scrimspark.operators.numbering import numbered
from scrimspark.plans import sample_pages as SP
from scrimspark.schemas import PAYLOAD, TABLES
from scrimspark.sources import frames as S
from scrimspark.sources.store import Conflict
from scrimspark.streaming.load import bad_payloads, create_tables, current_tables, load_into, load_payloads, match_store, start_match_load


def line(map_id, side=1, kills=10):
    return {"mapID": map_id, "sideID": side, "kills": kills, "deaths": 5, "ADR": 71.126, "swingPct": None, "rating": 1.1, "ratingVersion": "3.0"}


def payload(**more):
    return {
        "matchID": 1,
        "matchDate": "2024-01-05T10:00:00",
        "matchNotes": "notes",
        "demoLink": None,
        "matchVeto": [{"stepNumber": 1, "teamName": "A", "vetoActionID": 2, "mapID": 4}, {"stepNumber": 2, "teamName": "B", "vetoActionID": 1, "mapID": 1}, {"stepNumber": 3, "teamName": "", "vetoActionID": 3, "mapID": 2}],
        "players": [{"alias": "x", "team": "A", "stats": [line(1), line(1), line(2)]}, {"alias": "y", "team": "Unknown", "stats": [line(1)]}, {"alias": "z", "team": "B", "stats": []}],
        "results": [{"mapID": 1, "team1Score": 13, "team2Score": 5, "team1TScore": 7, "team1CTScore": 6, "team2TScore": 2, "team2CTScore": 3}],
    } | more


@pytest.fixture
def tables(spark):
    empty = {n: spark.createDataFrame([], TABLES[n]) for n in TOUCHED}
    empty["teams"] = spark.createDataFrame([(1, "A"), (2, "B")], TABLES["teams"])
    empty["matches"] = spark.createDataFrame([(1, 9, 1, 2, 3, None, "u", None, None), (2, 9, 1, 2, 3, None, "u", None, None)], TABLES["matches"])
    return empty


TOUCHED = ("matches", "match_maps", "match_veto", "match_players", "players", "player_stats", "teams")


def counts(tables):
    return {n: tables[n].count() for n in TOUCHED}


def test_load_and_load_again(spark, tables):
    once = W.load_match_payload(tables, spark.createDataFrame([payload()], PAYLOAD))
    n = counts(once)
    assert (n["match_veto"], n["match_maps"], n["players"], n["match_players"], n["player_stats"]) == (3, 2, 2, 1, 3)  # repeated lines are kept
    match = once["matches"].where("match_id = 1").head()
    assert (match.match_notes, match.demo_link, match.match_date) == ("notes", "ERROR", datetime(2024, 1, 5, 10))
    assert once["matches"].where("match_id = 2").head().demo_link is None
    scored = once["match_maps"].where("map_id = 1").head()
    assert (scored.team1_score, scored.team2_ct_score) == (13, 3)
    assert once["match_maps"].where("map_id = 2").head().team1_score is None
    assert str(once["player_stats"].head().adr) == "71.13"
    left_over = once["match_veto"].where("step = 3").head()
    assert left_over.team_id is None
    again = W.load_match_payload(once, spark.createDataFrame([payload(matchNotes=None, matchDate="")], PAYLOAD))
    assert counts(again) == n
    assert again["matches"].where("match_id = 1").head().match_notes is None


def test_event_teams_by_case(spark):
    teams = spark.createDataFrame([(5, "Alpha"), (3, "ALPHA")], "team_id int, team_name string")
    links = spark.createDataFrame([(1, 3)], "event_id int, team_id int")
    new = spark.createDataFrame([(1, ["alpha", "New", "NEW"]), (2, ["new", None])], "event_id int, teams array<string>")
    links, teams = W.insert_event_teams(links, teams, new)
    assert teams.count() == 3
    assert {tuple(r) for r in links.collect()} == {(1, 3), (1, 6), (2, 6)}


def test_matches_by_exact_name_and_repeats(spark):
    teams = spark.createDataFrame([(1, "a")], "team_id int, team_name string")
    old = spark.createDataFrame([], "match_id int, event_id int, team1_id int, team2_id int, page_url string, best_of int")
    new = spark.createDataFrame([(1, "a", "A", "u", 3), (1, "a", "A", "u", 3)], "event_id int, team1 string, team2 string, page_url string, best_of int")
    matches, teams = W.insert_matches(old, teams, new)
    assert teams.count() == 2 and matches.count() == 2
    assert {(r.team1_id, r.team2_id) for r in matches.collect()} == {(1, 2)}


def test_events_first_page_wins(spark):
    events = spark.createDataFrame([(1, "old", None, None, None, 1, 1, "u1", None)], TABLES["events"])
    kinds, places = spark.createDataFrame([(1, "LAN")], TABLES["event_types"]), spark.createDataFrame([(1, "X")], TABLES["locations"])
    rows = [("again", "u1", "LAN", "X", 1), ("first", "u2", "Online", "X", 2), ("second", "u2", "Other", "Y", 3)]
    new = spark.createDataFrame([(n, None, None, None, k, p, u, s) for n, u, k, p, s in rows], "event_name string, prize_pool string, start_date timestamp, end_date timestamp, event_type string, location string, page_url string, seq int")
    events, kinds, places = W.upsert_events(events, kinds, places, new)
    assert sorted(r.event_name for r in events.collect()) == ["first", "old"]
    assert kinds.count() == 3 and places.count() == 2


def test_rankings_share_the_runs_date(spark):
    rankings, teams = spark.createDataFrame([], TABLES["rankings"]), spark.createDataFrame([], TABLES["teams"])
    new = spark.createDataFrame([("a", 1, 2, None, None, None), ("b", 1, 3, None, None, datetime(2023, 1, 1))], "team_name string, points int, rank int, vrs_points int, vrs_rank int, ranking_date timestamp_ntz")
    rows, teams = W.insert_rankings(rankings, teams, new, datetime(2024, 1, 1))
    assert {r.ranking_date for r in rows.collect()} == {datetime(2024, 1, 1), datetime(2023, 1, 1)}
    assert teams.count() == 2


def test_combine_rankings(spark):
    a = spark.createDataFrame([("x", 10, 1), ("y", 9, 2)], "name string, points int, rank int")
    b = spark.createDataFrame([("x", 5, 7, 1), ("x", 6, 8, 2), ("X", 1, 1, 3)], "name string, points int, rank int, seq int")
    assert [tuple(r) for r in W.combine_rankings(a, b).collect()] == [("x", 10, 1, 6, 8)]
    assert all(r.vrs_rank is None for r in W.combine_rankings(a).collect())


def test_unknown_map_is_an_error(spark):
    files = spark.createDataFrame([(1, "de_moon", "p", "x")], "job_id int, map_name string, patch_version string, path string")
    jobs = spark.createDataFrame([(1, 2)], "job_id int, download_job_id int")
    down = spark.createDataFrame([(2, 3)], "download_job_id int, match_id int")
    with pytest.raises(Exception, match="no such map"):
        W.resolve_parquet_files(files, jobs, down, spark.createDataFrame([(9, 3, 1)], "match_map_id int, match_id int, map_id int")).collect()
    good = files.replace("de_moon", "de_mirage")
    assert W.resolve_parquet_files(good, jobs, down, spark.createDataFrame([(9, 3, 1)], "match_map_id int, match_id int, map_id int")).head().match_map_id == 9


def test_stream_loads_once(spark, tables, tmp_path):
    root, inbox = str(tmp_path / "w"), tmp_path / "in"
    inbox.mkdir()
    create_tables(spark, root, tables)
    spark.createDataFrame([payload()], PAYLOAD).write.mode("append").json(str(inbox))
    for _ in range(2):
        start_match_load(spark, str(inbox), root, str(tmp_path / "marks")).awaitTermination()
    loaded = current_tables(spark, root)
    assert counts(loaded)["player_stats"] == 3 and counts(loaded)["teams"] == 2


def test_numbering_in_ranges(spark):
    """Numbers follow the order within keys, null ones too, and no window deals all rows to one task."""
    rows = spark.range(5000).selectExpr("id", "nullif(id % 3, 0) AS k", "nullif(hash(id), hash(7L)) AS o").repartition(7)
    want = {}
    for k in (None, 1, 2):
        own = sorted((r for r in rows.collect() if r.k == k), key=lambda r: (r.o is not None, r.o or 0))
        want |= {r.id: i + 1 for i, r in enumerate(own)}
    assert {r.id: r.n for r in numbered(rows, "n", ["o"], ["k"]).collect()} == want
    old = spark.createDataFrame([(40, 0)], "new_id int, o int")
    out = W.with_ids(rows, old, "new_id", ["o"])
    assert [r.new_id for r in out.orderBy(F.col("o").asc_nulls_first()).collect()] == list(range(41, 5041))
    assert "row_number" not in out._jdf.queryExecution().toString()
    assert numbered(rows.limit(0), "n", ["o"]).count() == 0


def store_of(spark, tables, root, matches=60, buckets=24):
    """A store with many matches, of which each has a veto, a map, a line-up and a line."""
    ids = spark.range(1, matches + 1).select(F.col("id").cast("int").alias("match_id"))
    fill = lambda name, **columns: ids.select(*[(columns[f.name] if f.name in columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in TABLES[name]])
    m = F.col("match_id")
    whole = tables | {
        "matches": fill("matches", match_id=m, page_url=F.lit("u")),
        "match_maps": fill("match_maps", match_map_id=m * 10, match_id=m, map_id=F.lit(7)),
        "match_veto": fill("match_veto", veto_id=m, match_id=m, step=F.lit(1), action_id=F.lit(1), map_id=F.lit(7)),
        "match_players": fill("match_players", match_id=m, team_id=F.lit(1), player_id=F.lit(1)),
        "players": spark.createDataFrame([(i, f"p{i}", None, None) for i in range(1, 100)], TABLES["players"]),
        "player_stats": fill("player_stats", stat_id=m, match_map_id=m * 10, player_id=F.lit(1), side_id=F.lit(1), kills=F.lit(0), deaths=F.lit(0)),
    }
    create_tables(spark, root, whole, buckets)
    return match_store(spark, root)


def rows_of(tables):
    return {n: sorted(repr(tuple(r)) for r in tables[n].select(sorted(tables[n].columns)).collect()) for n in TOUCHED}


def test_a_batch_writes_its_buckets_only(spark, tables, tmp_path):
    store = store_of(spark, tables, str(tmp_path / "w"))
    before = store.read_version()
    whole = store.tables(before)
    batch = spark.createDataFrame([payload(matchID=i) for i in range(5, 15)], PAYLOAD)
    after = load_payloads(spark, store.root, batch)
    assert after.number == before.number + 1
    for name in ("matches", "match_maps", "match_veto", "match_players", "player_stats", "players"):
        changed = {b for b, f in after.folders[name].items() if f != before.folders[name].get(b)}
        assert 0 < len(changed) <= 10
        assert set(before.folders[name]) <= set(after.folders[name])
    # the same as loading into whole tables, numbers too
    want = W.load_match_payload(whole, batch)
    assert rows_of(store.tables()) == rows_of(want)
    # readers of the version before still have it
    assert store.table(before, "match_veto").count() == 60
    # again: nothing is added
    load_payloads(spark, store.root, batch)
    n = counts(store.tables())
    assert n == counts(want)
    store.drop_old_versions(keep=1)
    assert counts(store.tables()) == n and len(store.version_numbers()) == 1
    assert not any("numbered" in str(p) for p in tmp_path.rglob("*"))


def test_numbers_outgrow_32_bits(spark, tables, tmp_path):
    top, root = 5_400_000_000, str(tmp_path / "w")
    maps, veto, stats = (top, 2, 1, *[None] * 6), (top, 2, 1, 1, 1, 1), (top, top, 1, 1, *[None] * 6)
    old = {n: spark.createDataFrame([row], TABLES[n]) for n, row in (("match_maps", maps), ("match_veto", veto), ("player_stats", stats))}
    create_tables(spark, root, tables | old, 4)
    load_payloads(spark, root, spark.createDataFrame([payload()], PAYLOAD))
    now = current_tables(spark, root)
    numbers = {n: sorted(r[0] - top for r in now[n].select(c).collect()) for n, c in (("match_maps", "match_map_id"), ("match_veto", "veto_id"), ("player_stats", "stat_id"))}
    assert numbers == {"match_maps": [0, 1, 2], "match_veto": [0, 1, 2, 3], "player_stats": [0, 1, 2, 3]}
    assert {r[0] - top for r in now["player_stats"].select("match_map_id").collect()} == {0, 1, 2}


def test_a_killed_batch_leaves_the_old_version(spark, tables, tmp_path):
    store = store_of(spark, tables, str(tmp_path / "w"), 20, 4)
    before = rows_of(store.tables())
    load_into(store, store.read_version(), spark.createDataFrame([payload()], PAYLOAD))  # never committed
    assert rows_of(store.tables()) == before
    folders = len(list((tmp_path / "w" / "data").iterdir()))
    store.drop_old_versions()
    assert rows_of(store.tables()) == before and len(list((tmp_path / "w" / "data").iterdir())) == folders - 1


def test_of_two_loads_one_wins_and_one_retries(spark, tables, tmp_path, monkeypatch):
    store = store_of(spark, tables, str(tmp_path / "w"), 20, 4)
    base = store.read_version()
    first, second = (spark.createDataFrame([payload(matchID=i)], PAYLOAD) for i in (1, 2))
    a, b = load_into(store, base, first), load_into(store, base, second)
    store.commit(a)
    with pytest.raises(Conflict):
        store.commit(b)
    assert store.read_version().number == base.number + 1

    other = spark.createDataFrame([payload(matchID=3)], PAYLOAD)
    plain = type(store).write
    overtaken = []

    def slow(self, version, *args):
        out = plain(self, version, *args)
        if not overtaken:  # someone else commits between our reading and our commit
            overtaken.append(1)
            self.commit(load_into(self, version, other))
        return out

    monkeypatch.setattr(type(store), "write", slow)
    load_payloads(spark, store.root, second)
    notes = {r.match_id: r.match_notes for r in store.tables()["matches"].collect()}
    assert [notes[i] for i in (1, 2, 3, 4)] == ["notes", "notes", "notes", None]
    ids = [r.stat_id for r in store.tables()["player_stats"].collect()]
    assert len(ids) == len(set(ids))


def test_a_match_with_most_rows_is_written_by_several_tasks(spark, tmp_path):
    """Its bucket is dealt out by size; every row is there."""
    store = match_store(spark, str(tmp_path / "w"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64k")
    try:
        big = spark.range(200_000).selectExpr("id AS veto_id", "CAST(CASE WHEN id % 10 = 0 THEN id ELSE 1 END AS INT) AS match_id", "1 AS step", "1 AS team_id", "1 AS action_id", "1 AS map_id")
        version = store.replace({"match_veto": big}, 8)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = max(len(list((tmp_path / "w" / f).glob("part-*"))) for f in version.folders["match_veto"].values())
    assert files > 2 and store.tables()["match_veto"].count() == 200_000 and version.largest["match_veto"] == 199_999


BAD = {
    '{"matchID": 5, ': S.NOT_JSON, "": S.NOT_JSON, "3": S.WRONG_TYPE, '{"matchID": "x"}': S.WRONG_TYPE, '{"matchID": 1, "players": {}}': S.WRONG_TYPE, "{}": S.NO_ID, '{"matchID": null, "results": [{"mapID": 99}]}': S.NO_ID,
    '{"matchID": 1, "results": [{"mapID": 12}]}': S.NO_MAP, '{"matchID": 1, "matchVeto": [{"mapID": 1}, {"stepNumber": 2}]}': S.NO_MAP, '{"matchID": 1, "players": [{"stats": [{"mapID": 0}]}]}': S.NO_MAP,
}
GOOD = ['{"matchID": 7}', '{"matchID": 8, "matchVeto": null, "players": [{"alias": "x", "stats": null}], "more": 1}', '{"matchID": 9, "results": [{"mapID": 11}]}']


def test_bad_lines_are_put_aside_with_their_reason(spark, tables, tmp_path):
    lines = spark.createDataFrame([(x,) for x in [*BAD, *GOOD]], "value string")
    good, bad, counts = S.split_payloads(S.parse_payloads(lines), str(tmp_path / "split"))
    assert {r.raw: r.reason for r in bad.collect()} == BAD
    assert sorted(r.matchID for r in good.collect()) == [7, 8, 9]
    assert counts == {"good": 3, S.NOT_JSON: 2, S.WRONG_TYPE: 3, S.NO_ID: 2, S.NO_MAP: 3}
    root = str(tmp_path / "w")
    create_tables(spark, root, tables)
    lines.where("value <> ''").write.text(str(tmp_path / "in"))
    start_match_load(spark, str(tmp_path / "in"), root, str(tmp_path / "marks")).awaitTermination()
    assert {r.raw: r.reason for r in bad_payloads(spark, root).collect()} == {k: v for k, v in BAD.items() if k}


def bytes_below(path):
    return sum(p.stat().st_size for p in path.rglob("*") if p.is_file())


def test_payload_files_are_compressed(spark, tmp_path):
    """As text the payloads are many times the tables that they are made from."""
    lines = SP.payload_json(spark, "/root/testdata/sf0.001")
    SP.write_payloads(lines, str(tmp_path / "in"))
    back = spark.read.text(str(tmp_path / "in"))
    length = back.agg(F.sum(F.octet_length("value"))).head()[0]
    assert back.count() == 1500 and bytes_below(tmp_path / "in") * 5 < length


def test_what_a_split_writes_is_compressed_well(spark, tmp_path):
    S.split_payloads(S.parse_payloads(spark.createDataFrame([("x" * 1000,), ("{}",)], "value string")), str(tmp_path / "split"))
    files = [pq.ParquetFile(p) for p in (tmp_path / "split").rglob("*.parquet")]
    assert files and {f.metadata.row_group(0).column(0).compression for f in files} == {"ZSTD"}


def test_payloads_and_pages_exchange_maps_once(spark):
    """What is grouped by match is dealt out by match already: neither the maps' scores nor the lines of players are
    exchanged again."""
    for frame, most in ((SP.payload_json(spark, "/root/testdata/sf0.001"), 5), (SP.match_pages(spark, "/root/testdata/sf0.001"), 5)):
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") <= most

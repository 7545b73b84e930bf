from __future__ import annotations

import random

import duckdb
from pyspark.sql import functions as F

from scrimspark import catalog
from scrimspark.functions import dom
from scrimspark.functions.dom import parse
from scrimspark.functions.lookups import MAPS as MAP_NAMES
from scrimspark.operators import pages as P
from scrimspark.plans import sample_pages as SP
from scrimspark.plans.adapters import view

VETO = """<div class="veto-box"><div class="padding preformatted-text"><div>1. A removed Nuke</div></div></div>
<div class="veto-box"><div class="padding"><div>2. Team  B
 picked Dust 2</div><div>1. A removed Nuke</div><div>3. A banned Train</div><div>4. Mirage was  left over</div><div>5. A removed Moon</div><p>6. A removed Nuke</p></div></div>"""
MAPS = """<div class="mapholder"><div class="mapname">Mirage</div><div class="results-left"><div class="results-team-score">16</div></div>
<div class="results-center-half-score">(<span class="ct">8</span>:<span class="t">4</span>; <span class="t">4</span>:<span class="ct">8</span>) (<span>4</span>:<span>1</span>)</div>
<div class="results-right"><div class="results-team-score">13</div></div></div>
<div class="mapholder"><div class="mapname">Nuke</div><div class="results-left"><div class="results-team-score">-</div></div><div class="results-right"><div class="results-team-score">-</div></div></div>
<div class="mapholder"><div class="mapname">Inferno</div><div class="results-left"><div class="results-team-score">1</div></div><div class="results-right"><div class="results-team-score">2</div></div></div>"""
STATS = """<div class="lineups"><div class="lineup standard-box"><div class="box-headline">A</div><div class="players"><a href="/player/1"><span class="player-nick">x</span></a><a href="/player/1">x</a><a href="/team/1">no</a></div></div></div>
<div class="stats-menu-link"><div class="dynamic-map-name-full" id="all">All maps</div><div class="dynamic-map-name-full" id="7">Mirage</div></div>
<div id="7-content"><table class="table tstats"><tr class="header-row"><th>x</th></tr><tr><td class="players"><span class="player-nick">x</span></td><td class="kd">11 - 9</td><td class="adr">71.5</td><td class="roundSwing">+2.5%</td></tr>
<tr><td class="players"><a>stranger</a></td></tr></table><table class="table ctstats"><tr><td class="players">x</td><td class="kd">n/a</td><td class="adr">-</td></tr></table></div>"""


def pages(spark, html):
    return spark.createDataFrame([(1, 5, html), (2, 6, None), (3, 7, "")], "page_id long, match_id int, html string")


def test_vetoes(spark):
    rows = [tuple(r) for r in P.extract_vetoes(pages(spark, VETO)).collect()]
    assert rows == [(1, 1, "A", 2, 3), (1, 2, "Team B", 1, 8), (1, 4, "", 3, 1)]


def test_map_results(spark):
    assert [tuple(r)[1:] for r in P.extract_map_results(pages(spark, MAPS)).collect()] == [(1, 16, 13, 4, 8, 4, 8), (2, 1, 2, 0, 0, 0, 0)]


def test_player_stats(spark):
    rows = [tuple(r)[1:] for r in P.extract_player_stats(pages(spark, STATS)).collect()]
    assert rows == [("x", "A", 1, 1, 11, 9, 71.5, 2.5, 0.0, "3.0"), ("x", "A", 1, 2, 0, 0, 0.0, None, 0.0, "3.0")]


def test_match_page_needs_map_tabs(spark):
    html = VETO + MAPS + STATS + '<div class="date" data-unix="1704449400000"></div><div class="vod-popup"><div class="vod-text-box"><a href="/download/demo/9">d</a></div></div>'
    row = P.extract_match_page(pages(spark, html)).collect()
    assert len(row) == 1
    m = row[0]
    assert (m.matchID, m.matchDate, m.demoLink, len(m.matchVeto), len(m.results), m.players[0].stats[0].kills) == (5, "2024-01-05T10:10:00+00:00", "https://stats.example/download/demo/9", 3, 2, 11)
    assert P.extract_match_page(pages(spark, VETO + MAPS)).count() == 0


def test_rankings_skip_bad_records(spark):
    good = '<div class="ranked-team"><span class="position">#3</span><span class="name"> A </span><span class="points">(1,234 points)</span></div>'
    assert [tuple(r)[1:] for r in P.extract_rankings(pages(spark, '<div class="ranked-team"></div>' + good)).collect()] == [("A", 1234, 3)]


def test_results(spark):
    one = '<div class="result-con"><a class="a-reset" href="/m/1"><div class="team1"><i class="team">A</i></div><div class="team2"><i class="team">B</i></div><i class="map-text">{}</i></a></div>'
    rows = [r.best_of for r in P.extract_results(pages(spark, one.format("bo3") + one.format("nuke") + "<div class='result-con'><p><a class='a-reset'></a></p></div>")).collect()]
    assert rows == [3, 1]


def test_selectors():
    page = parse('<div class="a b"><p id="x">1<b>2</b></p></div><p class="a">3')
    assert [n.text() for n in page.select(".a p, p.a")] == ["12", "3"]
    assert page.first("div.a > b") is None and page.first("p > b").text() == "2"
    assert page.first("#x").text(" ") == "1 2"


def test_listing_pages_hold_a_bounded_number_of_records(spark):
    d = "/root/testdata/sf0.01"
    for made, mark, whole in ((SP.event_pages, "small-event", view(spark, d, "tournaments")), (SP.result_pages, "result-con", view(spark, d, "matches"))):
        sizes = [r.html.count(mark) for r in made(spark, d).select("html").collect()]
        assert max(sizes) <= 25 and sum(sizes) == whole.count()


def read_vetoes(spark, lines):
    rows = spark.createDataFrame(list(enumerate(lines)), "i int, line string").select("i", P.veto_of(F.col("line")).alias("v")).collect()
    return [tuple(r.v) if r.v else None for r in sorted(rows)]


def test_veto_lines(spark):
    known = [
        ("1. Team B picked Dust 2", (1, "Team B", 1, 8)),
        ("2. A Removed nuke", (2, "A", 2, 3)),
        ("7. Mirage was left over", (7, "", 3, 1)),
        ("7. Nuke was left over(decider)", (7, "", 3, 3)),
        ("7.Dust 2 left-over (decider)", (7, "", 3, 8)),
        ("7. Train LEFTOVER", (7, "", 3, 9)),
        ("7. Train left\u00a0over", (7, "", 3, 9)),
        ("3. pick picked Train", (3, "pick", 1, 9)),
        ("3. A banned Train", None),
        ("3. A pick Train", None),
        ("3. A picked Train (2nd)", None),
        ("x. A picked Train", None),
        ("3 A picked Train", None),
        ("3. picked Train", None),
        ("3. A picked", None),
        ("4. was left over", None),
        ("4. Moon was left over", None),
        ("4. left over picked Train", (4, "left over", 1, 9)),
        ("99999999999. A picked Train", None),
        ("4.", None),
        ("", None),
        (None, None),
    ]
    assert read_vetoes(spark, [line for line, _ in known]) == [v for _, v in known]


def test_lines_of_the_grammar_are_read_back(spark):
    """Lines made from steps, teams, maps and all spellings tell what they were made from."""
    r = random.Random(7)
    teams = ["A", "Team B", "picker", "9 lives", "left", "Ünïted", "a.b", "the (decider)"]
    lines, want = [], []
    for step in range(1, 1500):
        number, name = r.choice(list(MAP_NAMES.items()))
        name = "".join(r.choice((c.lower(), c.upper())) for c in (name.replace("Dust2", r.choice(("Dust2", "Dust 2")))))
        gap = lambda least=1: " " * r.randint(least, 3) if r.random() < 0.9 else "\t" * max(least, 1)
        if r.random() < 0.5:
            over = r.choice(("left over", "leftover", "left-over", "left -over", "Left Over", "LEFT-OVER"))
            lines.append(f"{gap(0)}{step}.{gap(0)}{name}{gap()}{r.choice(('was' + gap(), 'WAS ', ''))}{over}{r.choice(('', '(decider)', gap() + '(Decider)'))}{gap(0)}")
            want.append((step, "", 3, number))
        else:
            team, verb = r.choice(teams), r.choice(("picked", "removed", "banned", "ban", "pick", "Picked", "REMOVED"))
            lines.append(f"{step}.{gap(0)}{team}{gap()}{verb}{gap()}{name}{gap(0)}")
            action = {"picked": 1, "removed": 2}.get(verb.lower())
            want.append((step, team, action, number) if action else None)
    assert read_vetoes(spark, lines) == want


def test_malformed_events_and_event_teams(spark):
    event = '<a class="small-event" href="/events/{}"><div class="event-col"><div class="text-ellipsis">{}</div></div><span class="prizePoolEllipsis">$1</span></a>'
    html = event.format(1, " Cup ") + '<a class="small-event" href="/events/2"><p>no name</p></a>' + event.format(3, "Cup 3").replace(' href="/events/3"', "")
    assert [r.name for r in P.extract_events(pages(spark, html)).collect()] == ["Cup"]
    teams = '<div class="team-box"><div class="team-name"><div class="text">A</div></div></div><div class="team-box"><div class="team-name">B</div></div><div class="team-box">'
    assert [r.team_name for r in P.extract_event_teams(pages(spark, teams)).collect()] == ["A"]


def test_titles_of_the_query_are_those_of_its_sql(spark, tmp_path):
    """Of character references in a title only three count, and only complete ones; the operator reads them all."""
    titles = ["a &amp; b &lt;i&gt;", "token = &quot;x&quot;", "cut off &amp", "&amp;lt;", "&eacute;", ""]
    rows = [(i, f"<html><head><title>{t}</title></head><body><nav><a href='/'>x</a></nav></body></html>") for i, t in enumerate(titles)]
    rows += [(90, "<p>no title</p>"), (91, None)]
    spark.createDataFrame(rows, "page_id long, html string").write.parquet(f"{tmp_path}/pages.parquet")
    got = {tuple(r) for r in catalog.QUERIES["h0_page_titles"](spark, str(tmp_path)).collect()}
    duck = duckdb.connect()
    duck.sql(f"CREATE VIEW pages AS SELECT * FROM '{tmp_path}/pages.parquet/*.parquet'")
    assert got == set(duck.sql(catalog.ORACLE_SQL["h0_page_titles"]).fetchall())
    whole = {r.page_id: r.title for r in P.extract_titles(spark.read.parquet(f"{tmp_path}/pages.parquet")).collect()}
    assert (whole[1], whole[2], whole[4]) == ('token = "x"', "cut off &", "é")


def test_a_selector_looks_only_at_elements_that_can_fit(monkeypatch):
    page = parse('<div class="holder"><div class="name">A</div>' + '<p class="other"><i>x</i></p>' * 500 + '</div><div id="7">B</div>')
    looked, fits = [], dom._fits
    monkeypatch.setattr(dom, "_fits", lambda node, *more: looked.append(node) or fits(node, *more))
    assert (page.first(".holder .name").text(), page.first("[id='7']").text()) == ("A", "B")
    assert page.first(".missing") is None
    assert len(looked) < 10


def test_plain_pages_are_read_as_html_parser_reads_them(monkeypatch):
    bits = ['<div class="a b">', "<div>", "</div>", '<p id="x">', "</p>", '<i class="c">', "</i>", "<br>", "<br/>", "<div/>", "t", " a &amp; b&lt", "<P CLASS='a'>", "<!-- c -->", "< ", "<a b>", '<a href="?a=1&copy=2">', "</ i>"]
    r = random.Random(3)

    def shape(n):
        return n.tag, n.attrs, n.classes, n.text(" "), [shape(c) if isinstance(c, dom.Node) else c for c in n.children], [len(n.select(s)) for s in (".a", "i", "#x", "div > .c", ".a.b, p", "[href^='?']")]

    htmls = ["".join(r.choices(bits[: r.choice((12, len(bits)))], k=r.randint(0, 12))) for _ in range(3000)]
    plain = [dom._plain(h) is not None for h in htmls]
    assert 500 < sum(plain) < 2900
    fast = [shape(parse(h)) for h in htmls]
    monkeypatch.setattr(dom, "_plain", lambda html: None)
    assert fast == [shape(parse(h)) for h in htmls]

"""Pages and payloads made from the adapter views, so that extraction can be compared with what went in."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .adapters import view


#: Records on a listing page, at most: pages grow in number with the tables, not in size.
PER_PAGE = 25


def joined(parts: Column) -> Column:
    """Pieces (rows struct(order, html)) of a group as one text."""
    return F.array_join(F.transform(F.array_sort(F.collect_list(parts)), lambda p: p["html"]), "\n")


def ranking_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "rankings").join(view(spark, d, "teams"), "team_id")
    html = F.format_string('<div class="ranked-team standard-box"><span class="position">#%d</span><span class="name"> %s </span><span class="points">(%d points)</span></div>', "rank", "team_name", "points")
    broken = F.lit('<div class="ranked-team"><span class="position">#x</span></div>')
    pages = rows.groupBy((F.year("ranking_date") * 100 + F.month("ranking_date")).cast("long").alias("page_id")).agg(joined(F.struct("rank", "team_id", html.alias("html"))).alias("body"))
    return pages.select("page_id", F.concat(F.lit("<html><body>"), broken, "body", F.lit("</body></html>")).alias("html"))


def event_pages(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, page_no, html): event_id modulo 40, in pages of PER_PAGE events."""
    rows = view(spark, d, "tournaments")
    ms = (F.unix_seconds(F.col("start_date").cast("timestamp")) * 1000).cast("string")
    html = F.concat(
        F.lit('<a class="a-reset small-event" href="/events/'), F.col("event_id").cast("string"), F.lit('"><table><tr><td class="col-value event-col"><div class="text-ellipsis"> '), "event_name",
        F.lit('</div></td><td class="col-value prizePoolEllipsis"'), F.when(F.col("event_id") % 2 == 0, F.concat(F.lit(' title="'), "prize_pool", F.lit('">short'))).otherwise(F.concat(F.lit("> "), "prize_pool")),
        F.lit('</td><td class="gtSmartphone-only">Online</td></tr><tr class="eventDetails"><td><span class="col-desc">Town'), (F.col("event_id") % 9).cast("string"), F.lit(" | </span>"),
        F.when(F.col("event_id") % 5 != 0, F.concat(F.lit('<span data-unix="'), ms, F.lit('">x</span>'))).otherwise(F.lit("")), F.lit("</td></tr></table></a>"),
    )
    page_no = F.floor(F.col("event_id") / (40 * PER_PAGE)).alias("page_no")
    return rows.groupBy((F.col("event_id") % 40).alias("page_id"), page_no).agg(joined(F.struct("event_id", html.alias("html"))).alias("html"))


def event_team_pages(spark: SparkSession, d: str) -> DataFrame:
    rows = view(spark, d, "event_teams").join(view(spark, d, "teams"), "team_id")
    html = F.concat(F.lit('<div class="team-box"><div class="team-name"><div class="text"> '), "team_name", F.lit("</div></div></div>"))
    return rows.groupBy(F.col("event_id").alias("page_id")).agg(F.concat(F.lit('<div class="team-box"></div>'), joined(F.struct("team_id", html.alias("html")))).alias("html"))


def named_matches(spark: SparkSession, d: str) -> DataFrame:
    teams, rows = view(spark, d, "teams"), view(spark, d, "matches")
    for n in (1, 2):
        rows = rows.join(teams.toDF(f"team{n}_id", f"team{n}"), f"team{n}_id")
    return rows


def result_pages(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, page_no, html): the matches of an event (match_id modulo 500), in pages of PER_PAGE at most."""
    length = F.when(F.col("match_id") % 3 == 0, "bo3").when(F.col("match_id") % 3 == 1, "BO5").otherwise("nuke")
    html = F.concat(
        F.lit('<div class="result-con"><a class="a-reset" href="/matches/'), F.col("match_id").cast("string"), F.lit('"><div class="team1"><span class="team">'), "team1",
        F.lit('</span></div><div class="team2"><span class="team">'), "team2", F.lit('</span></div><span class="map-text">'), length, F.lit("</span></a></div>"),
    )
    page_no = F.floor(F.col("match_id") / (500 * PER_PAGE)).alias("page_no")
    return named_matches(spark, d).groupBy(F.col("event_id").cast("long").alias("page_id"), page_no).agg(joined(F.struct("match_id", html.alias("html"))).alias("html"))


def match_pages(spark: SparkSession, d: str) -> DataFrame:
    """(page_id, match_id, html): a page for each match with date, maps, vetoes, one line-up, and a tab for each map."""
    maps, teams, given = view(spark, d, "maps"), view(spark, d, "teams"), by_match(spark, d)
    text = F.col
    s = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("-"))
    played = view(spark, d, "match_maps", given).join(F.broadcast(maps), "map_id")
    span = lambda kind, c: F.concat(F.lit(f'<span class="{kind}">'), s(c), F.lit("</span>"))
    holder = F.concat(
        F.lit('<div class="mapholder"><div class="mapname">'), "map_name", F.lit('</div><div class="results-left"><div class="results-team-score">'), s("team1_score"),
        F.lit('</div></div><div class="results-center-half-score">'), span("t", "team1_t_score"), span("ct", "team2_ct_score"), span("ct", "team1_ct_score"), span("t", "team2_t_score"),
        F.lit('<span>4</span></div><div class="results-right"><div class="results-team-score">'), s("team2_score"), F.lit("</div></div></div>"),
    )
    tab = F.concat(F.lit('<div class="stats-menu-link"><div class="dynamic-map-name-full" id="m'), s("map_id"), F.lit('">'), "map_name", F.lit("</div></div>"))
    by_map = played.groupBy("match_id").agg(joined(F.struct("map_id", holder.alias("html"))).alias("holders"), joined(F.struct("map_id", tab.alias("html"))).alias("tabs"))
    veto = view(spark, d, "match_veto", given).join(F.broadcast(maps), "map_id").join(teams, "team_id", "left")
    # in the spellings that pages have
    spelled = lambda *of: F.element_at(F.array(*map(F.lit, of)), (F.col("match_id") % len(of) + 1).cast("int"))
    over = spelled(" was left over", " was left over(decider)", " Left-Over (decider)", " WAS  LEFTOVER", " left over")
    said = F.when(F.col("action_id") == 3, F.concat("map_name", over)).when(F.col("action_id") == 1, F.concat("team_name", spelled(" picked ", "  PICKED ", " Picked  "), F.upper("map_name"))).otherwise(F.concat("team_name", F.lit(" removed "), "map_name"))
    line = F.concat(F.lit("<div>"), s("step"), spelled(". ", ".", ".\n "), said, F.lit("</div>"))
    by_veto = veto.groupBy("match_id").agg(joined(F.struct("step", "map_id", "action_id", F.coalesce("team_id", F.lit(-1)).alias("t"), line.alias("html"))).alias("vetoes"))
    players = view(spark, d, "match_players").join(view(spark, d, "players"), "player_id").join(teams, "team_id")
    row = F.concat(F.lit('<tr><td class="players"><span class="player-nick">'), text("alias"), F.lit('</span></td><td class="kd">'), s("team1_t_score"), F.lit(" - "), s("team2_t_score"), F.lit('</td><td class="adr">'), s("team1_ct_score"), F.lit('.5</td><td class="roundSwing">+1.25%</td><td class="rating">1.'), s("team2_ct_score"), F.lit("</td></tr>"))
    table = F.concat(F.lit('<div id="m'), s("map_id"), F.lit('-content"><table class="table tstats"><tr><th>x</th></tr>'), row, F.lit("</table></div>"))
    stats = played.join(players, "match_id").groupBy("match_id").agg(joined(F.struct("map_id", "player_id", table.alias("html"))).alias("tables"))
    lineup = F.concat(F.lit('<div class="lineup standard-box"><div class="box-headline"><a class="text-ellipsis">'), text("team_name"), F.lit('</a></div><div class="players"><a href="/player/'), s("player_id"), F.lit('"><span class="player-nick">'), text("alias"), F.lit("</span></a></div></div>"))
    lineups = players.groupBy("match_id").agg(joined(F.struct("player_id", lineup.alias("html"))).alias("lineups"))
    rows = view(spark, d, "matches").join(by_map, "match_id").join(by_veto, "match_id").join(stats, "match_id").join(lineups, "match_id")
    ms = (F.unix_seconds(F.col("match_date").cast("timestamp")) * 1000).cast("string")
    demo = F.when(F.col("demo_link").isNotNull(), F.concat(F.lit('<div class="vod-popup"><div class="vod-text-box"><a href="/download/demo/'), s("match_id"), F.lit('">demo</a></div></div>'))).otherwise("")
    html = F.concat(
        F.lit('<html><body><div class="date" data-unix="'), ms, F.lit('">x</div><div class="veto-box"><div class="padding preformatted-text">Best of 3</div></div><div class="veto-box"><div class="padding">'), "vetoes",
        F.lit("<div>9. Someone banned Nuke</div><div>9 Someone picked Nuke</div><div>9. Moon was left over</div><div>Nuke was left over</div><div> </div></div></div>"), "holders", demo, F.lit('<div class="lineups">'), "lineups", F.lit("</div>"), "tabs", "tables", F.lit("</body></html>"),
    )
    return rows.select(F.col("match_id").alias("page_id"), "match_id", html.alias("html"))


def by_match(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    """The largest table dealt out by match, so that what the views and pages group by match isn't exchanged again."""
    return {"lineitem": view(spark, d, "lineitem").repartition("l_orderkey")}


def payload_json(spark: SparkSession, d: str) -> DataFrame:
    """(value): a JSON document for each match. Every player of a match has the lines of all its maps, as often as the
    line-up names the player."""
    teams, given = view(spark, d, "teams"), by_match(spark, d)
    veto = view(spark, d, "match_veto", given).join(teams, "team_id", "left")
    vetoes = veto.groupBy("match_id").agg(F.collect_list(F.struct(F.col("step").alias("stepNumber"), F.coalesce("team_name", F.lit("")).alias("teamName"), F.col("action_id").alias("vetoActionID"), F.col("map_id").alias("mapID"))).alias("matchVeto"))
    names = {f"team{n}{S}Score": f"team{n}_{s}score" for n in (1, 2) for s, S in (("", ""), ("t_", "T"), ("ct_", "CT"))}
    result = F.struct(F.col("map_id").alias("mapID"), *[F.col(c).alias(n) for n, c in names.items()])
    line = F.struct(F.col("map_id").alias("mapID"), F.lit(1).alias("sideID"), F.col("team1_t_score").alias("kills"), F.col("team2_t_score").alias("deaths"), (F.col("team1_ct_score") + 0.5).alias("ADR"), F.lit(1.25).alias("swingPct"), (F.col("team2_ct_score") / 4).alias("rating"), F.lit("3.0").alias("ratingVersion"))
    maps = view(spark, d, "match_maps", given).groupBy("match_id").agg(F.collect_list(F.when(F.col("team1_score").isNotNull(), result)).alias("results"), F.collect_list(line).alias("lines"))
    player = view(spark, d, "match_players").join(view(spark, d, "players"), "player_id").join(teams, "team_id")
    named = player.groupBy("match_id", "alias", "team_name").agg(F.count(F.lit(1)).cast("int").alias("n"))
    line_ups = named.groupBy("match_id").agg(F.collect_list(F.struct("alias", "team_name", "n")).alias("line_up"))
    rows = view(spark, d, "matches").join(vetoes, "match_id", "left").join(maps, "match_id", "left").join(line_ups, "match_id", "left")
    of_player = lambda p: F.struct(p["alias"].alias("alias"), p["team_name"].alias("team"), F.flatten(F.array_repeat("lines", p["n"])).alias("stats"))
    players = F.when(F.col("lines").isNotNull(), F.transform("line_up", of_player)).alias("players")
    results = F.when(F.size("results") > 0, F.col("results")).alias("results")
    when = F.when(F.col("match_id") % 10 == 0, "").otherwise(F.date_format(F.col("match_date").cast("timestamp"), "yyyy-MM-dd'T'HH:mm:ss"))
    return rows.select(F.to_json(F.struct(F.col("match_id").alias("matchID"), when.alias("matchDate"), F.concat(F.lit("note "), F.col("match_id").cast("string")).alias("matchNotes"), F.col("demo_link").alias("demoLink"), "matchVeto", players, results)).alias("value"))


def write_payloads(lines: DataFrame, path: str) -> None:
    """lines (value) as compressed text. Such a file is one task's to read, so it holds no more than 100,000 lines."""
    lines.write.option("compression", "gzip").option("maxRecordsPerFile", 100_000).text(path)

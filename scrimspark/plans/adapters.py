"""The driver's test tables in the shape of the warehouse, as SQL that Spark and DuckDB both read.

Library code takes domain frames and knows nothing of these views.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..functions.lookups import MAPS

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

VIEWS: dict[str, str] = {
    "teams": "SELECT n_nationkey AS team_id, n_name AS team_name FROM {nation}",
    "maps": "SELECT * FROM (VALUES " + ", ".join(f"({i}, '{n}')" for i, n in MAPS.items()) + ") AS t(map_id, map_name)",
    "matches": """SELECT o_orderkey AS match_id, CAST(o_orderkey % 500 AS INT) AS event_id, CAST(o_custkey % 25 AS INT) AS team1_id,
      CAST((o_custkey + 1 + o_orderkey % 24) % 25 AS INT) AS team2_id, o_orderdate AS match_date, concat('https://stats.example/matches/', o_orderkey) AS page_url,
      CAST(NULL AS STRING) AS match_notes, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE concat('demo/', o_orderkey) END AS demo_link FROM {orders}""",
    "match_maps": """SELECT l_orderkey * 100 + l_partkey % 11 + 1 AS match_map_id, l_orderkey AS match_id, CAST(l_partkey % 11 + 1 AS INT) AS map_id,
      CASE WHEN max(l_suppkey) % 10 = 0 THEN NULL ELSE max(CAST(floor(l_quantity) AS INT)) % 17 END AS team1_score,
      CASE WHEN max(l_suppkey) % 10 = 0 THEN NULL ELSE max(CAST(floor(l_extendedprice) AS INT)) % 17 END AS team2_score,
      max(l_linenumber) % 13 AS team1_t_score, min(CAST(floor(l_quantity) AS INT)) % 13 AS team1_ct_score,
      min(l_linenumber) % 13 AS team2_t_score, min(CAST(floor(l_extendedprice) AS INT)) % 13 AS team2_ct_score
      FROM {lineitem} GROUP BY l_orderkey, l_partkey % 11""",
    "match_veto": """SELECT l_orderkey AS match_id, l_linenumber AS step, CASE l_returnflag WHEN 'A' THEN 1 WHEN 'R' THEN 2 ELSE 3 END AS action_id,
      CASE WHEN l_returnflag = 'N' THEN NULL WHEN l_suppkey % 2 = 0 THEN team1_id ELSE team2_id END AS team_id, CAST(l_partkey % 11 + 1 AS INT) AS map_id
      FROM {lineitem} JOIN {matches} ON l_orderkey = match_id""",
    "monthly": """SELECT date_trunc('month', o_orderdate) AS ranking_date, c_nationkey AS team_id, sum(CAST(floor(o_totalprice) AS BIGINT)) AS points, count(*) AS vrs_points
      FROM {orders} JOIN {customer} ON o_custkey = c_custkey GROUP BY date_trunc('month', o_orderdate), c_nationkey""",
    "rankings": """SELECT ranking_date, team_id, CAST(points AS BIGINT) AS points, CAST(rank() OVER (PARTITION BY ranking_date ORDER BY points DESC) AS INT) AS rank, vrs_points,
      CAST(rank() OVER (PARTITION BY ranking_date ORDER BY vrs_points DESC) AS INT) AS vrs_rank FROM {monthly}""",
    "tournaments": """SELECT p_partkey AS event_id, concat(p_name, ' ', p_type) AS event_name, concat('$', CAST(floor(p_retailprice) AS BIGINT) * p_size * 100) AS prize_pool,
      CAST(DATE '1995-01-01' + CAST(p_partkey % 2400 AS INT) AS TIMESTAMP) AS start_date, concat('https://stats.example/events/', p_partkey, '/', p_type) AS page_url,
      CASE WHEN p_partkey % 7 = 0 THEN true WHEN p_partkey % 11 = 0 THEN false END AS download_event FROM {part}""",
    "event_teams": "SELECT DISTINCT l_partkey AS event_id, CAST(l_suppkey % 25 AS INT) AS team_id FROM {lineitem} WHERE l_partkey % 8 = 0",
    "players": "SELECT CAST(c_custkey AS INT) AS player_id, lower(c_name) AS alias, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('7656', c_custkey) END AS steamid FROM {customer}",
    "match_players": "SELECT o_orderkey AS match_id, c_nationkey AS team_id, CAST(c_custkey AS INT) AS player_id FROM {orders} JOIN {customer} ON o_custkey = c_custkey",
    # telemetry: 150 users of a click stream on 11 maps, in parts by the day of the month
    "stream": """SELECT event_id, CAST(floor(date_part('epoch', ts) / 21600) AS BIGINT) AS tick, CAST(user_id AS STRING) AS steamid, event_type AS kind,
      CAST(floor(value) AS INT) AS amount, CAST(user_id % 11 + 1 AS INT) AS map_no, CAST(date_part('day', ts) AS INT) % 3 AS part_id, user_id, ts FROM {events}""",
    "ticks": """SELECT 1 AS match_id, concat('map', map_no) AS map_name, part_id, tick, steamid, concat('user', steamid) AS name, amount % 101 AS health,
      CAST(amount AS DOUBLE) AS x, CAST(user_id AS DOUBLE) AS y, CAST(event_id % 997 AS DOUBLE) AS z, event_id % 5 <> 0 AS is_alive, event_id % 4 = 0 AS is_airborne,
      CASE WHEN user_id % 2 = 0 THEN 'CT' ELSE 'TERRORIST' END AS team_name, CASE WHEN event_id % 3 = 0 THEN NULL ELSE concat('clan', user_id % 5) END AS team_clan_name,
      CAST(tick % 30 AS INT) AS total_rounds_played, tick + 3 AS next_primary_attack_tick, CASE WHEN event_id % 2 = 0 THEN tick + 4 END AS next_secondary_attack_tick,
      event_id AS seq FROM {stream} WHERE kind IN ('view', 'signup')""",
    "player_hurt": """SELECT 1 AS match_id, concat('map', map_no) AS map_name, part_id, tick, 'player_hurt' AS event_type, concat('user', (user_id * 7 + amount) % 150) AS attacker_name,
      CAST((user_id * 7 + amount) % 150 AS STRING) AS attacker_steamid, concat('user', user_id) AS player_name, steamid AS user_steamid, amount AS dmg_health, event_id AS seq FROM {stream} WHERE kind = 'click'""",
    "player_death": """SELECT 1 AS match_id, concat('map', map_no) AS map_name, part_id, tick, 'player_death' AS event_type,
      CASE WHEN event_id % 9 = 0 THEN NULL ELSE concat('user', (user_id * 7 + amount) % 150) END AS attacker_name, concat('user', user_id) AS player_name, steamid AS user_steamid, event_id AS seq FROM {stream} WHERE kind = 'purchase'""",
}

#: Where the dialects differ.
IN_SPARK = (("date_part('epoch', ts)", "unix_micros(CAST(ts AS TIMESTAMP)) / 1000000.0D"),)


def view(spark: SparkSession, sf_dir: str, name: str, given: dict[str, DataFrame] | None = None) -> DataFrame:
    """The view, or the driver's table of that name, as a DataFrame. given: what stands for some of the tables."""
    if given and name in given:
        return given[name]
    if name not in VIEWS:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")
    sql = VIEWS[name]
    for there, here in IN_SPARK:
        sql = sql.replace(there, here)
    return spark.sql(sql, **{n: view(spark, sf_dir, n, given) for n in dict.fromkeys(re.findall(r"\{(\w+)\}", sql))})


def with_views(*names: str, body: str) -> str:
    """DuckDB SQL: the named views, and those that they read, as common table expressions before body."""
    order: list[str] = []

    def add(name: str) -> None:
        if name in VIEWS and name not in order:
            for inner in re.findall(r"\{(\w+)\}", VIEWS[name]):
                add(inner)
            order.append(name)

    for n in names:
        add(n)
    parts = [f"{n} AS ({re.sub(r'[{}]', '', VIEWS[n])})" for n in order]
    body = body.strip()
    if not parts:
        return body
    if body.upper().startswith("WITH "):
        return "WITH " + ",\n".join(parts) + ",\n" + body[5:]
    return "WITH " + ",\n".join(parts) + "\n" + body

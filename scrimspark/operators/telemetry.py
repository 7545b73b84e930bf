"""Telemetry: stitches parts of recordings, enriches events with the state around them, and reduces them to scoreboards
and positions. Every key starts with (match_id, map_name), so many recordings go through one plan."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import numbered

KEY = ["match_id", "map_name"]

# Names of recorded properties and events.
TICK_COLUMNS = ("tick", "next_primary_attack_tick", "next_secondary_attack_tick")
PLAYER_PROPS = (
    "team_name", "team_clan_name", "X", "Y", "Z", "last_place_name", "velocity_X", "velocity_Y", "velocity_Z",
    "pitch", "yaw", "health", "armor_value", "inventory", "current_equip_value", "has_defuser", "has_helmet",
    "flash_duration", "accuracy_penalty", "zoom_lvl", "ping",
)
WORLD_PROPS = (
    "game_time", "is_bomb_planted", "which_bomb_zone", "is_freeze_period", "is_warmup_period", "is_terrorist_timeout",
    "is_ct_timeout", "is_technical_timeout", "is_waiting_for_resume", "is_match_started", "game_phase",
)
SAME_TICK_EVENTS = ("inferno_startburn", "inferno_expire")
NO_WORLD_EVENTS = ("server_cvar",)
EVENT_VIEWS = {
    "kills": ("player_death",),
    "damages": ("player_hurt",),
    "shots": ("weapon_fire",),
    "footsteps": ("player_sound",),
    "bomb": ("bomb_planted", "bomb_defused", "bomb_exploded", "bomb_dropped", "bomb_pickup"),
    "smokes": ("smokegrenade_detonate", "smokegrenade_expired"),
    "infernos": ("inferno_startburn", "inferno_expire"),
    "server_cvars": ("server_cvar",),
}
CT, TERRORIST = "CT", "TERRORIST"


def group_parts(ticks: DataFrame, headers: DataFrame) -> DataFrame:
    """(match_id, map_name, part_id, patch_version, total_rounds_played, max_tick) of each part that has ticks.
    headers: match_id, part_id, map_name, patch_version, seq; a map's patch is that of its first file by seq."""
    ends = ticks.groupBy("match_id", "part_id").agg(F.max("total_rounds_played").alias("total_rounds_played"), F.max("tick").alias("max_tick"))
    parts = headers.join(ends, ["match_id", "part_id"])
    patches = parts.groupBy(*KEY).agg(F.min_by("patch_version", "seq").alias("patch_version"))
    return parts.drop("patch_version").join(patches, KEY).select(*KEY, "part_id", "patch_version", "total_rounds_played", "max_tick")


def part_offsets(parts: DataFrame) -> DataFrame:
    """(match_id, map_name, part_id, offset): the ticks of the earlier parts, by rounds played."""
    earlier = Window.partitionBy(*KEY).orderBy("total_rounds_played", "part_id").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select(*KEY, "part_id", F.coalesce(F.sum(F.col("max_tick") + 1).over(earlier), F.lit(0)).cast("long").alias("offset"))


def stitch_parts(frame: DataFrame, parts: DataFrame) -> DataFrame:
    """Frame with its tick columns moved on by the ticks of earlier parts. The offsets are one row for each part of a
    recording; Spark broadcasts them when they are small."""
    rows = frame.join(part_offsets(parts), [*KEY, "part_id"])
    for c in TICK_COLUMNS:
        if c in frame.columns:
            rows = rows.withColumn(c, F.col(c) + F.col("offset"))
    return rows.select(*frame.columns)


def world_state(state: DataFrame, props: list[str] | None = None) -> DataFrame:
    """T5: one row for each tick: the world's properties as the smallest steamid saw them, and each side's name and first
    clan name. One aggregate."""
    props = [c for c in (props or WORLD_PROPS) if c in state.columns]

    def first(c: str, when: Column | None = None) -> Column:
        order = F.struct("steamid") if when is None else F.when(when, F.struct("steamid"))
        return F.min_by(c, order)

    ct, t = F.col("team_name") == CT, F.col("team_name") == TERRORIST
    clan = F.col("team_clan_name").isNotNull()
    return state.groupBy(*KEY, "tick").agg(
        *[first(c).alias(c) for c in props],
        F.max(F.when(ct, F.col("team_name"))).alias("ct_team_name"),
        F.max(F.when(t, F.col("team_name"))).alias("t_team_name"),
        first("team_clan_name", ct & clan).alias("ct_team_clan_name"),
        first("team_clan_name", t & clan).alias("t_team_clan_name"),
    )


def enrich_world(events: DataFrame, world: DataFrame) -> DataFrame:
    """Events with the world's state at their tick; a column that the events have already gets the suffix _world.
    Settings events are left as they are."""
    names = {c: f"{c}_world" if c in events.columns else c for c in world.columns if c not in (*KEY, "tick")}
    side = world.select(*[F.col(c).alias(f"_{c}") for c in (*KEY, "tick")], *[F.col(c).alias(n) for c, n in names.items()])
    on = (~events["event_type"].isin(*NO_WORLD_EVENTS)) & (events["tick"] == side["_tick"])
    for c in KEY:
        on = on & (events[c] == side[f"_{c}"])
    return events.join(side, on, "left").drop(*[f"_{c}" for c in (*KEY, "tick")])


def lookup_tick(tick_offset: int = -1) -> Column:
    """The tick at which an event's players are looked up: its own for inferno events, never before 0."""
    return F.when(F.col("tick").isNull() | F.col("event_type").isin(*SAME_TICK_EVENTS), F.col("tick")).otherwise(F.greatest(F.col("tick") + tick_offset, F.lit(0)))


def needed_state(state: DataFrame, events: DataFrame, *ticks: Column) -> DataFrame:
    """The rows of state at the given ticks of events (by default at the events' own): the tick table is by far the largest,
    so it is cut down to these before anything groups it. Ticks are distinct rows of a key; Spark broadcasts them where
    they are few."""
    wanted = None
    for t in ticks or (F.col("tick"),):
        part = events.select(*KEY, t.alias("tick"))
        wanted = part if wanted is None else wanted.unionByName(part)
    return state.join(wanted.distinct(), [*KEY, "tick"], "left_semi")


def enrich_players(events: DataFrame, state: DataFrame, roles: list[str] | None = None, tick_offset: int = -1, props: list[str] | None = None) -> DataFrame:
    """Events with each role's state, prefixed by the role, one tick before (inferno events: at the tick). Roles are
    the columns <role>_steamid. Columns that are there are never overwritten. Of state rows that repeat a (tick, steamid)
    the one with the lowest ``seq``, if there is one, counts.

    One lookup serves all roles, as an event looks at one tick: state is cut down to the ticks that are needed and grouped
    by tick, some ten players each; events are dealt by tick once, and each role takes its player's entry. An id that is
    null takes none, so such rows don't gather anywhere."""
    roles = roles or [c.removesuffix("_steamid") for c in events.columns if c.endswith("_steamid")]
    props = [c for c in (props or PLAYER_PROPS) if c in state.columns]
    entry = F.struct(F.col("steamid").cast("string").alias("id"), F.col("seq" if "seq" in state.columns else "tick").alias("seq"), F.struct(*props).alias("s"))
    needed = needed_state(state.where(F.col("steamid").isNotNull()), events, lookup_tick(tick_offset))
    there = needed.groupBy(*[F.col(c).alias(f"_{c}") for c in (*KEY, "tick")]).agg(F.array_sort(F.collect_list(entry)).alias("_players"))
    found = events.withColumn("_at", lookup_tick(tick_offset)).join(there, [F.col(c) == F.col(f"_{c}") for c in KEY] + [F.col("_at") == F.col("_tick")], "left")

    def of(role: str) -> Column:
        mine = F.filter("_players", lambda p: p["id"] == F.col(f"{role}_steamid").cast("string"))
        return F.get(mine, F.lit(0))["s"]

    found = found.select(*events.columns, *[of(role).alias(f"_of_{role}") for role in roles])
    return found.select(*events.columns, *[F.col(f"_of_{role}.{c}").alias(f"{role}_{c}") for role in roles for c in props if f"{role}_{c}" not in events.columns])


def enrich_events(events: DataFrame, ticks: DataFrame, roles: list[str] | None = None, tick_offset: int = -1, world_props: list[str] | None = None, props: list[str] | None = None) -> DataFrame:
    """T5 to T7 in one: events with the world's state at their tick and each role's a tick before. Of the tick table only
    the ticks that either needs are grouped."""
    needed = needed_state(ticks, events, F.col("tick"), lookup_tick(tick_offset))
    return enrich_players(enrich_world(events, world_state(needed, world_props)), needed, roles, tick_offset, props)


def event_view(frame: DataFrame, name: str, drop: tuple[str, ...] | None = None) -> DataFrame:
    """The events of one view, without the columns that it never fills, or without those of ``drop``."""
    if drop is None:
        return event_views(frame, (name,))[name]
    return frame.where(F.col("event_type").isin(*EVENT_VIEWS[name])).drop(*drop)


def event_views(frame: DataFrame, names: tuple[str, ...] = tuple(EVENT_VIEWS)) -> dict[str, DataFrame]:
    """All views of a frame, each without the columns that it never fills; a view without rows keeps its columns. One
    pass over the frame, a row for each event type, finds those of all views."""
    columns = [c for c in frame.columns if c not in (*KEY, "event_type")]
    kinds = [k for n in names for k in EVENT_VIEWS[n]]
    filled = frame.where(F.col("event_type").isin(*kinds)).groupBy("event_type").agg(F.array(*[F.bool_or(F.col(c).isNotNull()) for c in columns]).alias("some")).collect()
    out = {}
    for name in names:
        seen = [r.some for r in filled if r.event_type in EVENT_VIEWS[name]]
        empty = [c for c, *some in zip(columns, *seen, strict=True) if some and not any(some)]
        out[name] = event_view(frame, name, tuple(empty))
    return out


def kills_deaths(deaths: DataFrame, attacker: str = "attacker_name", victim: str = "player_name") -> DataFrame:
    """(match_id, map_name, player, kills, deaths). Each death is a kill of its attacker, if it has one, and a death
    of its victim, so one grouping counts both."""
    sides = F.array(F.struct(F.col(attacker).alias("player"), F.lit(1).alias("k"), F.lit(0).alias("d")), F.struct(F.col(victim).alias("player"), F.lit(0).alias("k"), F.lit(1).alias("d")))
    rows = deaths.select(*KEY, F.explode(sides).alias("s")).select(*KEY, "s.*").where("player IS NOT NULL")
    return rows.groupBy(*KEY, "player").agg(F.sum("k").alias("kills"), F.sum("d").alias("deaths"))


def effective_damage(hurts: DataFrame, ticks: DataFrame, victim_id: str = "user_steamid", health: str = "health") -> DataFrame:
    """Hurts with prev_health, the victim's health one tick before (of rows that repeat a tick and player, the one
    with the lowest seq), and effective_damage, no more than that health."""
    order = "seq" if "seq" in ticks.columns else health
    once = ticks.groupBy(*KEY, (F.col("tick") + 1).alias("tick"), F.col("steamid").alias(victim_id)).agg(F.min_by(health, order).alias("prev_health"))
    rows = hurts.join(once, [*KEY, "tick", victim_id], "left")
    return rows.withColumn("effective_damage", F.least("dmg_health", "prev_health"))


def dedupe_damage(damage: DataFrame, dedupe: str = "values", attacker: str = "attacker_name", victim: str = "player_name") -> DataFrame:
    """Hits of a known attacker, distinct by their values, or with dedupe="tick" by tick and values."""
    columns = [*KEY, attacker, victim, "dmg_health", "prev_health", "effective_damage"] + ["tick"] * (dedupe == "tick")
    return damage.where(F.col(attacker).isNotNull()).select(*columns).distinct()


def adr(damage: DataFrame, ticks: DataFrame, attacker: str = "attacker_name") -> DataFrame:
    """(match_id, map_name, player, adr): damage for each round played."""
    rounds = ticks.groupBy(*KEY).agg(F.greatest(F.max("total_rounds_played"), F.lit(1)).alias("rounds"))
    sums = damage.groupBy(*KEY, F.col(attacker).alias("player")).agg(F.sum("effective_damage").alias("damage"))
    return sums.join(rounds, KEY).select(*KEY, "player", (F.col("damage") / F.col("rounds")).alias("adr"))


def scoreboard(deaths: DataFrame, hurts: DataFrame, ticks: DataFrame, roster: DataFrame, dedupe: str = "values") -> DataFrame:
    """(match_id, map_name, team_name, player, kills, deaths, adr) of everyone who killed, died or hit, by team, then
    kills; names in lower case, which roster's (match_id, alias, team_name) are matched with."""
    kd = kills_deaths(deaths)
    per_round = adr(dedupe_damage(effective_damage(hurts, ticks), dedupe), ticks)
    both = kd.unionByName(per_round, allowMissingColumns=True).withColumn("player", F.lower("player"))
    zero = F.lit(0).cast("long")
    board = both.groupBy(*KEY, "player").agg(F.coalesce(F.sum("kills"), zero).alias("kills"), F.coalesce(F.sum("deaths"), zero).alias("deaths"), F.coalesce(F.sum("adr"), F.lit(0.0)).alias("adr"))
    names = roster.select("match_id", F.lower("alias").alias("player"), "team_name")
    rows = board.join(names, ["match_id", "player"], "left").select(*KEY, "team_name", "player", "kills", "deaths", "adr")
    return rows.orderBy(*KEY, F.asc_nulls_last("team_name"), F.desc("kills"), "player")


def adr_by_side(damage: DataFrame, rounds: DataFrame, team_dmg: bool = True, self_dmg: bool = False) -> DataFrame:
    """(match_id, map_name, steamid, side, adr) from damage (attacker_steamid, attacker_side, user_steamid,
    user_side, effective_damage) and rounds (match_id, map_name, side, rounds)."""
    rows = damage.where("attacker_steamid IS NOT NULL")
    if not self_dmg:
        rows = rows.where(~F.col("attacker_steamid").eqNullSafe(F.col("user_steamid")))
    if not team_dmg:
        rows = rows.where(~F.col("attacker_side").eqNullSafe(F.col("user_side")))
    sums = rows.groupBy(*KEY, F.col("attacker_steamid").alias("steamid"), F.col("attacker_side").alias("side")).agg(F.sum("effective_damage").alias("damage"))
    return sums.join(rounds, [*KEY, "side"]).select(*KEY, "steamid", "side", (F.col("damage") / F.greatest("rounds", F.lit(1))).alias("adr"))


def standing_positions(ticks: DataFrame) -> DataFrame:
    """Where players stood: alive, on the ground, with a position."""
    rows = ticks.where(F.col("is_alive") & ~F.col("is_airborne") & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    return rows.select(*KEY, *[c for c in ("tick", "seq") if c in ticks.columns], "steamid", "x", "y", "z")


def map_bounds(positions: DataFrame) -> DataFrame:
    """The box with equal sides around a map's positions: middle and half side."""
    axes = ("x", "y", "z")
    ends = positions.groupBy(*KEY).agg(*[f(c).alias(f"{n}_{c}") for c in axes for f, n in ((F.min, "min"), (F.max, "max"))])
    half = F.greatest(*[F.col(f"max_{c}") - F.col(f"min_{c}") for c in axes]) / 2
    return ends.select(*KEY, *[f"{n}_{c}" for c in axes for n in ("min", "max")], *[((F.col(f"min_{c}") + F.col(f"max_{c}")) / 2).alias(f"mid_{c}") for c in axes], half.alias("half_range"))


def downsample_positions(positions: DataFrame, n: int = 5, order: tuple[str, ...] = ("tick", "steamid")) -> DataFrame:
    """Every n-th position of a map from the first, in the given order."""
    return numbered(positions, "_n", list(order), KEY).where((F.col("_n") - 1) % n == 0).drop("_n")


def floor_slices(positions: DataFrame, floor_height: float = 150, min_points: int = 100) -> DataFrame:
    """Positions with their floor: slices of z from the map's lowest, open below and closed above (so the lowest
    position itself is in none); slices with fewer than min_points go. Two small aggregates, joined back."""
    low = positions.groupBy(*KEY).agg(F.min("z").alias("_low"))
    rows = positions.join(low, KEY).withColumn("floor", (F.ceil((F.col("z") - F.col("_low")) / floor_height) - 1).cast("int")).where("floor >= 0").drop("_low")
    full = rows.groupBy(*KEY, "floor").agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") >= min_points).select(*KEY, "floor")
    return rows.join(full, [*KEY, "floor"], "left_semi")

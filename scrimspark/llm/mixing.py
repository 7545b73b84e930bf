"""Operator 10: mixing sources to target weights by Sainte-Laguë apportionment of equal-token blocks.

Each source's words, in a seeded order, form streams (shards) that are cut into blocks of ``block_words``. The budget of
blocks goes to the sources by the highest quotients target / (2k + 1), each source's quota to groups of shards and each
group's to its shards by the quotients of their sizes. In each shard the blocks with the smallest keyed hashes are picked,
as many as its quota says. A quota above the shard's number of blocks takes the whole shard once and picks the rest again.

Nulls, ties, empty input: a null or empty text has size 0 and is never taken; a null source is a source of its own, the
last; a null doc_id is like any other, and rows that repeat a doc_id are separate stretches of the stream, ordered by their
digests of doc_id and text and then by the rest of the row, so reruns agree; a text of any length is one row, and its blocks a
list of its length / ``block_words``; an empty table gives an empty result. Columns of the input that are named like an
output column are replaced; other names can't clash.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, keep, table, text_or_empty

#: Shards that are apportioned together.
SHARD_GROUP = 1024


def sainte_lague(votes: DataFrame, group: list[str], votes_col: str, seats_col: str, order: list[str], out: str) -> DataFrame:
    """Gives each row of a group its share of the group's seats (seats_col, the same in all its rows) by the highest
    quotients votes / (2k + 1); equal quotients go by ``order``. Zero votes get nothing. group and order hold no nulls.

    The seats with a quotient of at least half of votes per seat are floor(votes * seats / all + 1/2). That is the wanted
    set but for a few of the highest quotients left out or of the lowest taken in, which are then ranked.
    """
    per = Window.partitionBy(*group)
    start = F.floor(F.col(votes_col) * F.col(seats_col) / F.sum(votes_col).over(per) + 0.5)
    rows = votes.withColumn(out, F.when(F.col(votes_col) > 0, start).otherwise(0).cast("long"))
    rows = rows.withColumn("_off", F.when(F.sum(votes_col).over(per) > 0, F.col(seats_col) - F.sum(out).over(per)).otherwise(0))
    step = F.sign("_off").cast("long")
    # the quotients next in line: those of seats out, out + 1, ... to add, or of seats out - 1, out - 2, ... to give back
    tried = (
        rows.where((F.col("_off") != 0) & (F.col(votes_col) > 0))
        .withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.abs("_off") - 1)))
        .withColumn("_seat", F.when(step > 0, F.col(out) + F.col("_k")).otherwise(F.col(out) - 1 - F.col("_k")))
        .where("_seat >= 0")
        .withColumn("_quotient", F.col(votes_col) / (2 * F.col("_seat") + 1))
    )
    best = [(-step * F.col("_quotient")).asc(), *[(F.col(c).asc_nulls_last()) for c in order]]
    moved = (
        tried.withColumn("_rank", F.row_number().over(per.orderBy(*best)))
        .where(F.col("_rank") <= F.abs("_off"))
        .groupBy(*group, *order)
        .agg(F.sum(step).alias("_moved"))
    )
    return rows.join(moved, [*dict.fromkeys([*group, *order])], "left").select(
        *votes.columns, (F.col(out) + F.coalesce("_moved", F.lit(0))).alias(out)
    )


def source_targets(sizes: DataFrame, weights: tuple[float, ...], share: float, cap: float) -> DataFrame:
    """(source, source_size, rank, target). Sources by code point, null last, get the weights in turn and share
    ``share`` times all words; a target stops at ``cap`` times its source, and the excess is shared again by weight.

    The caps that bind are those of the lowest size per weight, so a running sum in that order finds them at once. The
    windows without a partition see one row for each source.
    """
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    ranked = totals.withColumn("rank", F.row_number().over(by_name) - 1).withColumn("weight", weight)
    everything = Window.partitionBy(F.lit(1))
    filling = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), "rank").rowsBetween(Window.unboundedPreceding, -1)
    level = (
        F.sum("source_size").over(everything) * share - cap * F.coalesce(F.sum("source_size").over(filling), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(filling), F.lit(0.0)))
    # level: words for each unit of weight if all sources before this one stop at their cap
    free = F.when(F.col("weight") * F.col("level") <= cap * F.col("source_size"), F.col("level"))
    return (
        ranked.withColumn("level", level)
        .withColumn("free", F.max(free).over(everything))
        .withColumn("target", F.least(cap * F.col("source_size"), F.col("weight") * F.coalesce("free", F.lit(float("inf")))))
        .select("source", "source_size", "rank", "target")
    )


def words() -> Column:
    return F.regexp_count(text_or_empty(), F.lit(WORD)).cast("long")


def _digest(seed: str) -> Column:
    """Of doc_id and text, so that rows that share a doc_id, or have none, are dealt out like others."""
    return F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.sha2(text_or_empty(), 256)))


def _tie(docs: DataFrame) -> Column:
    """Puts rows of one doc_id and text in an order by their other columns; rows equal in all of them are interchangeable."""
    return F.xxhash64(*[F.to_json(F.struct(c)) if "map<" in kind else F.col(c) for c, kind in docs.dtypes])


OUTPUT = ("size", "source_size", "target", "taken", "copies", "ranges")


def _mixed(light: DataFrame, rows: DataFrame, weights: tuple[float, ...], share: float, cap: float, block_words: int, shard_words: int, seed: str) -> DataFrame:
    """rows (doc_id, source, size, _digest, _mix_tie and any more that start with _mix) with the other columns of OUTPUT. light: the
    same documents' source, size and _digest.

    A source of any size is cut into shards of about ``shard_words``, so no task holds a source. Only the tables of
    sources and of shards are kept between the passes; both are small and Spark joins them by their measured size.
    """
    sources = keep(source_targets(light, weights, share, cap), "mix-sources")
    blocks = sources.agg(F.floor(F.sum("target") / block_words + 0.5).cast("long").alias("_all"))
    quota = sainte_lague(sources.crossJoin(F.broadcast(blocks)).withColumn("_one", F.lit(1)), ["_one"], "target", "_all", ["rank"], "_quota")
    quota = keep(quota.withColumn("_shards", F.greatest(F.lit(1), F.ceil(F.col("source_size") / shard_words)).cast("long")).drop("_all", "_one"), "mix-quota")

    def placed(left: DataFrame) -> DataFrame:
        there = quota.withColumnRenamed("source", "_source")
        shard = F.conv(F.substring("_digest", 1, 8), 16, 10).cast("long") % F.col("_shards")
        return left.join(there, left["source"].eqNullSafe(there["_source"])).withColumn("_shard", shard).drop("_source", "_shards")

    group = F.floor(F.col("_shard") / SHARD_GROUP).alias("_group")
    shards = placed(light).groupBy("rank", group, "_shard", "_quota").agg(F.sum("size").alias("_words"))
    shards = keep(shards, "mix-shards")
    groups = sainte_lague(shards.groupBy("rank", "_group", "_quota").agg(F.sum("_words").alias("_words")), ["rank"], "_words", "_quota", ["_group"], "_seats")
    shards = sainte_lague(shards.drop("_quota").join(groups.select("rank", "_group", "_seats"), ["rank", "_group"]), ["rank", "_group"], "_words", "_seats", ["_shard"], "_take")

    def key(b: Column) -> Column:
        return F.md5(F.concat_ws(":", F.lit(seed), "rank", "_shard", b))

    keys = F.array_sort(F.transform(F.sequence(F.lit(0).cast("long"), F.col("_blocks") - 1), key))
    shards = (
        shards.withColumn("_blocks", F.greatest(F.lit(1), F.ceil(F.col("_words") / block_words)).cast("long"))
        .withColumn("_take", F.least(F.col("_take"), (F.floor(F.lit(cap)) * F.col("_blocks")).cast("long")))
        .withColumn("copies", F.expr("_take div _blocks"))
        .withColumn("_more", F.col("_take") % F.col("_blocks"))
        .withColumn("_last", F.when(F.col("_more") > 0, F.element_at(keys, F.col("_more").cast("int"))))
        .select(F.col("rank").alias("_r"), F.col("_shard").alias("_s"), "copies", "_last")
    )
    shards = keep(shards, "mix-picks")
    stream = Window.partitionBy("rank", "_shard").orderBy("_digest", "_mix_tie").rowsBetween(Window.unboundedPreceding, -1)
    rows = placed(rows).withColumn("_start", F.coalesce(F.sum("size").over(stream), F.lit(0)))
    rows = rows.join(shards, (rows["rank"] == shards["_r"]) & (rows["_shard"] == shards["_s"]))
    chosen = F.filter(F.sequence(F.expr(f"_start div {block_words}"), F.expr(f"(_start + size - 1) div {block_words}")), lambda b: key(b) <= F.col("_last"))
    ranges = F.transform(
        chosen,
        lambda b: F.struct(
            F.greatest(b * block_words - F.col("_start"), F.lit(0)).alias("first"),
            F.least((b + 1) * block_words - F.col("_start"), F.col("size")).alias("end"),
        ),
    )
    empty = F.array().cast("array<struct<first:bigint,end:bigint>>")
    rows = rows.withColumn("ranges", F.when((F.col("size") > 0) & F.col("_last").isNotNull(), ranges).otherwise(empty))
    more = F.aggregate("ranges", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["first"])
    return rows.withColumn("taken", F.col("size") * F.col("copies") + more)


def mix_sources(
    docs: DataFrame,
    weights: tuple[float, ...] = (5, 2, 1),
    share: float = 1.5,
    cap: float = 2.0,
    block_words: int = 64,
    shard_words: int = 1 << 18,
    seed: str = "mix",
) -> DataFrame:
    """docs (doc_id, source, text and any more) with size, source_size, target, taken (words, repeats counted), copies
    (times that the whole text is taken) and ranges (word ranges [first, end) that are taken once more). Words are counted
    in two passes: for the plan, and with the texts that it is applied to."""
    docs = docs.drop(*OUTPUT)
    light = keep(docs.select("source", words().alias("size"), _digest(seed).alias("_digest")), "mix-sizes")
    rows = docs.select(F.struct(*docs.columns).alias("_mix_row"), "doc_id", "source", words().alias("size"), _digest(seed).alias("_digest"), _tie(docs).alias("_mix_tie"))
    return _mixed(light, rows, weights, share, cap, block_words, shard_words, seed).select("_mix_row.*", *OUTPUT)


def mix_report(docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, cap: float = 2.0, block_words: int = 64, shard_words: int = 1 << 18, seed: str = "mix") -> DataFrame:
    """As mix_sources(), with doc_id and source in place of the other columns: words are counted once."""
    light = keep(docs.select("doc_id", "source", words().alias("size"), _digest(seed).alias("_digest"), F.lit(0).cast("long").alias("_mix_tie")), "mix-sizes")
    return _mixed(light.drop("doc_id", "_mix_tie"), light, weights, share, cap, block_words, shard_words, seed).select("doc_id", "source", *OUTPUT)


#: A word and the white space after it.
SPACED_WORD = WORD + r"[\x20\x09-\x0D]*"


def mixed_documents(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """The texts of the mix, from what mix_sources returns: each whole copy is a row, and the further ranges of a
    document are one more row, with the white space that the words have in the text."""
    found = F.regexp_extract_all(text_or_empty(), F.lit(SPACED_WORD), F.lit(0))
    part = F.array_join(F.flatten(F.transform("ranges", lambda r: F.slice(found, (r["first"] + 1).cast("int"), (r["end"] - r["first"]).cast("int")))), "")
    whole = mixed.where("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    rest = mixed.where(F.size("ranges") > 0).withColumn("text", F.when(F.col("taken") == F.col("size") * (F.col("copies") + 1), F.col("text")).otherwise(part))
    rest = rest.withColumn("_copy", F.lit(0).cast("long"))
    out = whole.unionByName(rest)
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast("long"))
    return out.select(*columns)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "source", "text")
    return mix_report(docs).select("doc_id", "size", "source_size", "target", "taken")


def _apportion(name: str, rows: str, group: str, votes: str, seats: str, order: str, out: str) -> str:
    """sainte_lague() as DuckDB common table expressions."""
    return f"""
{name}_a AS (SELECT *, CASE WHEN {votes} > 0 THEN CAST(floor({votes}::DOUBLE * {seats} / sum({votes}) OVER (PARTITION BY {group}) + 0.5) AS BIGINT) ELSE 0 END AS s0 FROM {rows}),
{name}_b AS (SELECT *, CASE WHEN sum({votes}) OVER (PARTITION BY {group}) > 0 THEN {seats} - sum(s0) OVER (PARTITION BY {group}) ELSE 0 END::BIGINT AS off FROM {name}_a),
{name}_c AS (SELECT *, sign(off)::BIGINT AS step, unnest(range(0, abs(off))) AS k FROM {name}_b WHERE off <> 0 AND {votes} > 0),
{name}_d AS (SELECT *, CASE WHEN step > 0 THEN s0 + k ELSE s0 - 1 - k END AS seat FROM {name}_c),
{name}_e AS (SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY -step * ({votes}::DOUBLE / (2 * seat + 1)), {order}) AS place FROM {name}_d WHERE seat >= 0),
{name}_f AS (SELECT {group} AS g, {order} AS o, sum(step)::BIGINT AS moved FROM {name}_e WHERE place <= abs(off) GROUP BY {group}, {order}),
{name} AS (SELECT b.* EXCLUDE (s0, off), s0 + coalesce(moved, 0) AS {out} FROM {name}_b b LEFT JOIN {name}_f f ON f.g = b.{group} AND f.o = b.{order})"""


ORACLE = f"""
WITH docs AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size, md5('mix:' || coalesce(doc_id::VARCHAR, '') || ':' || sha256(coalesce(text, ''))) AS digest FROM documents),
totals AS (SELECT source, sum(size)::BIGINT AS source_size FROM docs GROUP BY source),
ranked AS (SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) - 1 AS rank FROM totals),
weighed AS (SELECT *, CASE rank % 3 WHEN 0 THEN 5.0::DOUBLE WHEN 1 THEN 2.0::DOUBLE ELSE 1.0::DOUBLE END AS weight FROM ranked),
levels AS (SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - 2.0::DOUBLE * coalesce(sum(source_size) OVER w, 0)) / (sum(weight) OVER () - coalesce(sum(weight) OVER w, 0)) AS level
  FROM weighed WINDOW w AS (ORDER BY source_size / weight, rank ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT source, source_size, rank, least(2.0::DOUBLE * source_size, weight * max(CASE WHEN weight * level <= 2.0::DOUBLE * source_size THEN level END) OVER ()) AS target FROM levels),
seats AS (SELECT *, 1 AS one, (SELECT CAST(floor(sum(target) / 64 + 0.5) AS BIGINT) FROM targets) AS blocks_all FROM targets),
{_apportion("quota", "seats", "one", "target", "blocks_all", "rank", "quota")},
cut AS (SELECT *, greatest(1, ceil(source_size / {1 << 18}))::BIGINT AS shards FROM quota),
placed AS (SELECT d.*, source_size, target, rank, quota, ('0x' || substr(digest, 1, 8))::BIGINT % shards AS shard FROM docs d JOIN cut c ON d.source IS NOT DISTINCT FROM c.source),
shard_words AS (SELECT rank, shard // {SHARD_GROUP} AS grp, rank || ':' || shard // {SHARD_GROUP} AS group_key, shard, quota, sum(size)::BIGINT AS words FROM placed GROUP BY ALL),
group_words AS (SELECT rank, grp, group_key, quota, sum(words)::BIGINT AS words FROM shard_words GROUP BY ALL),
{_apportion("groups_", "group_words", "rank", "words", "quota", "grp", "seats")},
shard_seats AS (SELECT s.*, seats FROM shard_words s JOIN groups_ g USING (group_key)),
{_apportion("shares", "shard_seats", "group_key", "words", "seats", "shard", "take0")},
shard_plan AS (SELECT *, greatest(1, ceil(words / 64))::BIGINT AS blocks FROM shares),
shard_take AS (SELECT *, least(take0, 2 * blocks) // blocks AS copies, least(take0, 2 * blocks) % blocks AS more,
  CASE WHEN least(take0, 2 * blocks) % blocks > 0 THEN list_sort(list_transform(range(blocks), lambda b: md5('mix:' || rank || ':' || shard || ':' || b)))[least(take0, 2 * blocks) % blocks] END AS last_key FROM shard_plan),
streams AS (SELECT p.*, coalesce(sum(size) OVER (PARTITION BY p.rank, p.shard ORDER BY digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start FROM placed p)
SELECT doc_id, size, source_size, target,
  (size * copies + CASE WHEN size > 0 AND last_key IS NOT NULL THEN coalesce(list_sum(list_transform(
    list_filter(range(start // 64, (start + size - 1) // 64 + 1), lambda b: md5('mix:' || s.rank || ':' || s.shard || ':' || b) <= last_key),
    lambda b: least((b + 1) * 64 - start, size) - greatest(b * 64 - start, 0))), 0) ELSE 0 END)::BIGINT AS taken
FROM streams s JOIN shard_take t ON s.rank = t.rank AND s.shard = t.shard
"""

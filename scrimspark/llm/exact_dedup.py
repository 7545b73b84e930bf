"""Operator 4: exact dedup by content-defined chunk recipes. DataFrame operations only.

A text is cut where its own characters say so (a full stop or line end that follows certain letters, between 256 and
4096 characters), so equal texts have equal chunks. Chunks are deduplicated to identifiers: a 64-bit hash, and an ordinal
for the rare chunks that share a hash with a different chunk, which is found by comparing the chunks themselves. Each
document becomes its ordered list of identifiers, some eight bytes for a thousand characters; equal lists mean equal
texts, and only the lists are grouped and joined. Each distinct chunk moves once.

Nulls, ties, empty input: a null text counts as empty, and all empty texts form one group; of rows that share text and
doc_id exactly one stays; a null doc_id comes below every other; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import keep, table, text_or_empty

#: A chunk ends after a vowel-like letter, a mark and white space, or where it reaches 4096 characters.
CHUNK = r"(?s).{256,4096}?(?:[aeiouäöüéèst][.,;:]?[\n ](?=[\p{Lu}a-d])|\z)|.{4096}|.{1,256}\z"


def chunk_ids(docs: DataFrame, hash_bits: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """docs with `_hashes` (array of the chunks' hashes), the hashes that belong to several chunks (usually none), and
    those chunks with their ordinal: (_hash, _chunk, _ordinal)."""
    chunks = F.regexp_extract_all(text_or_empty(), F.lit(CHUNK), F.lit(0))
    mask = F.lit((1 << hash_bits) - 1 if hash_bits < 64 else -1)
    hashed = docs.withColumn("_chunks", chunks).withColumn("_hashes", F.transform("_chunks", lambda c: F.xxhash64(c).bitwiseAND(mask)))
    distinct = hashed.select(F.explode(F.arrays_zip("_hashes", "_chunks")).alias("c")).select(F.col("c._hashes").alias("_hash"), F.col("c._chunks").alias("_chunk")).distinct()
    # verified: a hash with one distinct chunk behind it identifies that chunk
    shared = keep(distinct.groupBy(F.col("_hash").alias("_h")).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1"), "dedup-shared")
    clashes = distinct.join(shared, F.col("_hash") == F.col("_h"), "left_semi")  # not run unless there is a shared hash
    ordinal = F.row_number().over(Window.partitionBy("_hash").orderBy("_chunk")) - 1
    return hashed, shared, clashes.withColumn("_ordinal", ordinal.cast("long"))


def exact_groups(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """docs (doc_id, text and any more) with text_sha256, keep_id, group_size, kept. Input columns named so are replaced.

    hash_bits: of the chunk hash; fewer bits make clashes, for tests.
    """
    for c in ("text_sha256", "keep_id", "group_size", "kept"):
        docs = docs.drop(c)
    hashed, shared, clashes = chunk_ids(docs.select("doc_id", "text"), hash_bits)
    # the recipes are written once, so that row numbers hold whatever is recomputed
    row = F.monotonically_increasing_id()
    plain = hashed.select(row.alias("_row"), "doc_id", F.sha2(text_or_empty(), 256).alias("text_sha256"), F.length(text_or_empty()).alias("_length"), F.col("_hashes").alias("_recipe"))
    if shared.isEmpty():
        recipes = keep(plain, "dedup-recipes")
    else:  # the documents that hold a clashing chunk get its ordinal into their lists
        numbered = hashed.withColumn("_row", row).withColumn("text_sha256", F.sha2(text_or_empty(), 256)).withColumn("_length", F.length(text_or_empty()))
        parts = numbered.select("_row", "doc_id", "text_sha256", "_length", F.posexplode_outer(F.arrays_zip("_hashes", "_chunks")).alias("_at", "c"))
        parts = parts.select("_row", "doc_id", "text_sha256", "_length", "_at", F.col("c._hashes").alias("_hash"), F.col("c._chunks").alias("_chunk"))
        parts = parts.join(clashes, ["_hash", "_chunk"], "left").withColumn("_id", F.array("_hash", F.coalesce("_ordinal", F.lit(0).cast("long"))))
        lists = F.flatten(F.transform(F.array_sort(F.collect_list(F.when(F.col("_at").isNotNull(), F.struct("_at", "_id")))), lambda x: x["_id"]))
        recipes = keep(parts.groupBy("_row", "doc_id", "text_sha256", "_length").agg(lists.alias("_recipe")), "dedup-recipes")
    key = ["_recipe", "_length"]
    last = F.max(F.struct(F.coalesce("doc_id", F.lit(-(1 << 63))).alias("d"), "_row"))
    groups = recipes.groupBy(*key).agg(last.alias("_last"), F.count(F.lit(1)).alias("group_size"), F.max("doc_id").alias("keep_id")).where("group_size > 1")
    # written, so that the join below has two plain exchanges (or a broadcast, by the measured size): a large group is a
    # skewed key of that join, which adaptive execution then splits by row; single texts don't join
    groups = keep(groups, "dedup-groups")
    out = recipes.join(groups, key, "left").select(
        "_row",
        "doc_id",
        F.coalesce("keep_id", "doc_id").alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (F.col("_last").isNull() | (F.col("_last._row") == F.col("_row"))).alias("kept"),
        "text_sha256",
    )
    return out


def drop_copies(docs: DataFrame, hash_bits: int = 64) -> DataFrame:
    """The rows of docs that stay, with all their columns."""
    rows = exact_groups(docs, hash_bits).where("kept")
    # the caller's columns are one, so no name of theirs meets ours
    sums = docs.select(F.struct(*docs.columns).alias("_row"), F.col("doc_id").alias("_doc"), F.sha2(text_or_empty(), 256).alias("_sha"))
    match = sums["_doc"].eqNullSafe(rows["doc_id"]) & (sums["_sha"] == rows["text_sha256"])
    stay = sums.join(rows.select("doc_id", "text_sha256"), match, "left_semi")
    # rows that repeat both doc_id and text are one document; they are few, so the window's keys are single rows
    return stay.dropDuplicates(["_doc", "_sha"]).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents", "doc_id", "text")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


ORACLE = """
WITH rows_ AS (SELECT row_number() OVER () AS r, doc_id, sha256(coalesce(text, '')) AS text_sha256, coalesce(text, '') AS t FROM documents),
groups_ AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM rows_ GROUP BY t)
SELECT doc_id, keep_id, group_size, (doc_id = keep_id) AS kept, text_sha256 FROM rows_ JOIN groups_ USING (t)
"""

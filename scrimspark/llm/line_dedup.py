"""Operator 12: line dedup with two Bloom filters, for hashes seen once and hashes seen twice.

Each task runs its documents' line hashes through two filters of its own: a hash that the first has goes into the second,
and every hash goes into the first. Filters of two tasks make one: a bit of the second is set where either second has it
or both firsts have it, so a hash that is in two documents anywhere is never missed. Only lines that the merged second
filter has, some of them by chance, leave their task: these are grouped by their whole keys, counted exactly, and the
largest document of each repeated key is chosen. Texts of documents without such a line don't move.

A filter gets 16 bits for each line, in powers of two, up to ``most_bits`` (2**28 by default, 32 MB, which bounds what is
sent to tasks). Beyond some 2**25 different lines it gets fuller, and more lines than necessary are counted exactly: the
result is the same, and the exchange of lines grows towards that of a plain grouping. Tasks' filters are merged 64 at a
time, in segments, so no task holds those of all.

Nulls, ties, empty input: a null or empty text is one empty line; documents are told apart by doc_id, so rows that share
one are one document, a null doc_id is a document of its own below all others, and of a key's lines all those in rows with
the largest doc_id stay, repeats within it included; a text of any length is one row, its lines one list; an empty table
gives an empty result. Columns of the input that are named like an output column are replaced; other names can't clash.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import drop, keep, mix64, table, text_or_empty

OUTPUT = ("n_lines", "n_dropped", "kept_text")
#: What the contract calls white space.
SPACE = " \t\n\x0b\x0c\r"
BITS_PER_LINE, PROBES = 16, 3
#: Bits of a filter that are merged, and travel, together.
SEGMENT = 1 << 16
#: Filters that are merged in one group.
FAN_IN = 64


def lines(text: Column) -> Column:
    return F.split(text, "\n", -1)


def with_lines(f: Callable[[Column], Column]) -> Column:
    """f of the lines of `_text`, which are split once, not again for each element that f takes from them."""
    return F.element_at(F.transform(F.array(lines(F.col("_text"))), f), 1)


def long_lines(texts: pa.Array, min_chars: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(number of the text, number of the line, key, 64-bit hash of the key) of the lines with a key of min_chars or more."""
    parts = pc.split_pattern(texts, "\n")
    keys = pc.ascii_lower(pc.ascii_trim(parts.flatten(), characters=SPACE))
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    doc = np.repeat(np.arange(len(sizes)), sizes)
    place = np.arange(len(doc)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    at = np.flatnonzero(pc.greater_equal(pc.utf8_length(keys), min_chars).to_numpy(zero_copy_only=False))
    key = keys.take(pa.array(at)).to_numpy(zero_copy_only=False)
    return doc[at], place[at], key, pd.util.hash_array(key, categorize=False)


def probes(h: np.ndarray, bits: int) -> np.ndarray:
    """The bits of each hash, a row for each: (n, PROBES). bits is a power of two."""
    h = h.view(np.uint64)
    return np.stack([mix64(h + np.uint64(i * 0x9E3779B97F4A7C15 % (1 << 64))) & np.uint64(bits - 1) for i in range(PROBES)], axis=1).astype(np.int64)


def has(filter_: np.ndarray, places: np.ndarray) -> np.ndarray:
    """Whether all bits of each row of places are set."""
    return ((filter_[places >> 3] >> (7 - (places & 7)).astype(np.uint8)) & 1).all(axis=1)


def put(filter_: np.ndarray, places: np.ndarray) -> None:
    p = np.unique(places)
    if len(p):
        starts = np.flatnonzero(np.diff(p >> 3, prepend=-1))
        filter_[p[starts] >> 3] |= np.bitwise_or.reduceat((0x80 >> (p & 7)).astype(np.uint8), starts)


class Filters:
    """The two filters of a task, eight bits to a byte."""

    def __init__(self, bits: int):
        self.bits, self.once, self.twice = bits, np.zeros(bits // 8, dtype=np.uint8), np.zeros(bits // 8, dtype=np.uint8)

    def add(self, h: np.ndarray) -> None:
        """Hashes that are all of different lines or documents."""
        distinct, counts = np.unique(h, return_counts=True)
        places = probes(distinct, self.bits)
        again = (counts > 1) | has(self.once, places)
        put(self.twice, places[again])
        put(self.once, places)

    def segments(self) -> Iterator[tuple[int, bytes, bytes]]:
        size = SEGMENT // 8
        for s in range(0, self.bits // 8, size):
            once = self.once[s : s + size]
            if once.any():
                yield s // size, zlib.compress(once.tobytes(), 1), zlib.compress(self.twice[s : s + size].tobytes(), 1)


def unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), dtype=np.uint8)


def merged_segment(group: pd.DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """(once, twice) of a segment's filters, as packed bytes; both are symmetric in the filters."""
    once, twice = 0, 0
    for a, b in zip(group["once"], group["twice"], strict=True):
        more = unpacked(a)
        twice = twice | unpacked(b) | (once & more)
        once = once | more
    return once, twice


def twice_seen(hashes: DataFrame, bits: int) -> DataFrame:
    """(segment, twice) of the filters of all rows (hash), merged in groups of FAN_IN tasks."""

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        filters = Filters(bits)
        for b in batches:
            filters.add(b["hash"].to_numpy(dtype=np.int64))
        rows = list(filters.segments())
        yield pd.DataFrame({"task": TaskContext.get().partitionId(), "segment": [r[0] for r in rows], "once": [r[1] for r in rows], "twice": [r[2] for r in rows]})

    def merge(group: pd.DataFrame) -> pd.DataFrame:
        once, twice = merged_segment(group)
        return pd.DataFrame({"task": [group["task"].iloc[0] // FAN_IN], "segment": [group["segment"].iloc[0]], "once": [zlib.compress(once.tobytes(), 1)], "twice": [zlib.compress(twice.tobytes(), 1)]})

    schema = "task long, segment long, once binary, twice binary"
    filters = keep(hashes.mapInPandas(build, schema), "lines-filters")
    tasks = filters.agg(F.max("task")).first()[0] or 0
    while True:
        filters = filters.groupBy("segment", F.floor(F.col("task") / FAN_IN)).applyInPandas(merge, schema)
        tasks //= FAN_IN
        if not tasks:
            return filters.select("segment", "twice")


def repeated_lines(docs: DataFrame, min_chars: int, min_docs: int, most_bits: int) -> tuple[DataFrame, DataFrame]:
    """docs (doc_id, _text and any more) with `_sha` and `_suspects` (the lines that the filter has: number from 0, key), and
    (doc_id, _sha, _lines): which of these lines are dropped."""
    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            doc, _, _, h = long_lines(b.column("_text"), min_chars)
            pairs = np.unique(np.stack([doc.astype(np.uint64), h], axis=1), axis=0) if len(h) else np.zeros((0, 2), dtype=np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 1].view(np.int64))], names=["hash"])  # once for each document

    found = keep(docs.select("_text").mapInArrow(hashed, "hash bigint"), "lines-hashes")
    bits = min(max(1 << (found.count() * BITS_PER_LINE).bit_length(), SEGMENT), most_bits)
    twice = np.zeros(bits // 8, dtype=np.uint8)
    for r in twice_seen(found, bits).collect():  # bits / 8 bytes at most
        twice[r.segment * SEGMENT // 8 : (r.segment + 1) * SEGMENT // 8] = unpacked(r.twice)
    drop(found)
    filter_ = docs.sparkSession.sparkContext.broadcast(twice.tobytes())

    @F.arrow_udf("array<struct<_at: int, _key: string>>")
    def suspected(texts: pa.Array) -> pa.Array:
        seen = np.frombuffer(filter_.value, dtype=np.uint8)
        doc, place, key, h = long_lines(texts, min_chars)
        at = np.flatnonzero(has(seen, probes(h, len(seen) * 8)))
        found = pa.StructArray.from_arrays([pa.array(place[at].astype(np.int32)), pa.array(key[at], pa.string())], names=["_at", "_key"])
        ends = np.searchsorted(doc[at], np.arange(len(texts) + 1))
        return pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), found)

    tested = docs.withColumn("_sha", F.sha2("_text", 256)).withColumn("_suspects", suspected("_text"))
    lines_ = tested.select("doc_id", "_sha", F.explode("_suspects").alias("_line")).select("doc_id", "_sha", "_line.*")
    lines_ = keep(lines_, "lines-suspects")
    counts = lines_.groupBy("_key").agg(F.count_distinct(F.struct("doc_id")).alias("_n"), F.max("doc_id").alias("_stays")).where(F.col("_n") >= min_docs)
    # written, so that the join below has two plain exchanges and a very common line is split among tasks
    counts = keep(counts.select(F.col("_key").alias("_k"), "_stays"), "lines-repeated")
    gone = lines_.join(counts, F.col("_key") == F.col("_k")).where(~F.col("doc_id").eqNullSafe(F.col("_stays"))).select("doc_id", "_sha", "_at")
    return tested, keep(gone.groupBy("doc_id", "_sha").agg(F.collect_set("_at").alias("_lines")), "lines-dropped")


def drop_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, most_bits: int = 1 << 28) -> DataFrame:
    """docs (doc_id, text and any more) with n_lines, n_dropped and kept_text: keys of at least ``min_chars`` code points
    in at least ``min_docs`` documents keep their lines only in the largest doc_id that holds them."""
    docs = docs.drop(*OUTPUT)
    rows = docs.select(F.struct(*docs.columns).alias("_row"), "doc_id", text_or_empty().alias("_text"))
    tested, gone = repeated_lines(rows, min_chars, min_docs, most_bits)
    n_lines = F.size(lines(F.col("_text"))).cast("long")
    clean = tested.where(F.size("_suspects") == 0).select("_row", n_lines.alias("n_lines"), F.lit(0).cast("long").alias("n_dropped"), F.col("_text").alias("kept_text"))
    there = gone.select(F.col("doc_id").alias("_d"), F.col("_sha").alias("_s"), "_lines")
    # rows of one doc_id and one text drop the same lines; the text has the larger say in where a row goes, so that rows
    # without a doc_id don't meet in one task
    left = tested.where(F.size("_suspects") > 0)
    held = left.join(there, (left["_sha"] == there["_s"]) & left["doc_id"].eqNullSafe(there["_d"]), "left")
    stays = with_lines(lambda parts: F.transform(F.array_except(F.sequence(F.lit(0), F.size(parts) - 1), "_lines"), lambda i: F.element_at(parts, i + 1)))
    cut = F.when(F.col("_lines").isNull(), F.col("_text")).otherwise(F.array_join(stays, "\n"))
    held = held.select("_row", n_lines.alias("n_lines"), F.coalesce(F.size("_lines"), F.lit(0)).cast("long").alias("n_dropped"), cut.alias("kept_text"))
    return clean.unionByName(held).select("_row.*", *OUTPUT)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = drop_lines(table(spark, sf_dir, "documents", "doc_id", "text"))
    return docs.select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


ORACLE = r"""
WITH docs AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts FROM documents),
cut AS (SELECT doc_id, unnest(parts) AS line, unnest(range(len(parts))) AS place FROM docs),
keyed AS (SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM cut),
repeated AS (SELECT key, max(doc_id) AS stays FROM keyed WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (SELECT k.*, r.key IS NOT NULL AND doc_id <> stays AS gone FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped, sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (WHERE NOT gone), '')) AS kept_sha256 FROM judged GROUP BY doc_id
"""

"""Operator 6: removes repeated substrings; suffix arrays and Burrows-Wheeler transforms in bounded buckets.

Every string of ``length`` bytes (a window) is assigned to the 32-byte gram in it with the smallest hash, the leftmost of
equals, which depends on the window's bytes alone. So equal windows have equal grams, and windows whose gram occurs once
in the corpus are done with. Runs of windows around one gram (some 35) travel as one row with a hash of the run. Of
equal runs, all but the earliest are repeats. What is left, different runs around the same gram, may still share windows:
their bytes go to buckets, in which equal windows meet. There a suffix array and its Burrows-Wheeler transform are built;
breadth-first backward extension finds the common prefixes of neighbouring suffixes by increasing length and stops at
``length``, when the neighbours not yet told apart are those that share a window. Grams with very many different runs
(the edges of a common passage) are cut finer, four windows at a time by the bytes that the four share, so that no bucket
grows with the number of copies.

Strings are judged on the input, whole and as bytes; matches never cross documents. Nulls, ties, empty input: a null text
counts as empty; a null doc_id comes before all others; rows that share a doc_id and the text are one document (they get
the same spans); rows that share a doc_id, or have none, with different texts are documents of their own, in the order of
a hash of the text; an empty table gives an empty result. Input columns named like an output column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import drop, keep, mix64, table, text_or_empty, tidy

U64 = np.uint64
GRAM = 32
BASE = 0x9E3779B97F4A7C15 | 1
#: Bytes that are hashed at once.
SLAB = 1 << 20
#: A gram with more different runs than this is cut finer; so many runs are some 600 KB.
MANY = 4096
#: Windows to a piece of such a gram.
FINE = 4
#: Bytes of one suffix array, about.
BUCKET_BYTES = 1 << 18
SEAT = U64((1 << 24) - 1)


def rolled(data: np.ndarray, longest: int) -> dict[int, np.ndarray]:
    """Polynomial hashes of all grams of 1, 2, 4, ... longest bytes, by the gram's start."""
    grams, n, power = {1: data.astype(U64) + U64(1)}, 1, BASE
    while n < longest:
        g = grams[n]
        grams[2 * n] = g[: max(0, len(g) - n)] * U64(power) + g[n:]
        n, power = 2 * n, power * power % 2**64
    return grams


def lowest(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each window of ``width`` values."""
    n = 1
    while 2 * n <= width:
        values = np.minimum(values[:-n], values[n:])
        n *= 2
    rest = width - n
    return np.minimum(values[: len(values) - rest], values[rest:]) if rest else values


def runs_of(texts: list[bytes], length: int) -> tuple[np.ndarray, ...]:
    """Runs of windows around one gram, in texts of a slab: (index of the text, start, windows, gram, hash of the run)."""
    sizes = np.array([len(t) for t in texts], dtype=np.int64)
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    data = np.frombuffer(b"".join(texts), dtype=np.uint8)
    none = tuple(np.empty(0, dtype=np.int64) for _ in range(5))
    if len(data) < length:
        return none
    grams = rolled(data, 64)
    gram = mix64(grams[GRAM])
    low = lowest((gram & ~SEAT) | np.arange(len(gram), dtype=U64), length - GRAM + 1)
    seat = (low & SEAT).astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(seat)]
    inside = np.flatnonzero(np.arange(len(seat)) + length <= (begins + sizes)[text])
    if not len(inside):
        return none
    seat, text = seat[inside], text[inside]
    first = np.flatnonzero(np.concatenate([[True], (seat[1:] != seat[:-1]) | (text[1:] != text[:-1])]))
    windows = np.diff(np.append(first, len(inside)))
    start = inside[first]
    size = windows + length - 1
    whole = grams[64]  # three of them cover a run
    h = whole[start] * U64(0xD6E8FEB86659FD93) + whole[start + (size - 64) // 2] * U64(0xA24BAED4963EE407) + whole[start + size - 64]
    return text[first], start - begins[text[first]], windows, gram[seat[first]].view(np.int64), mix64(h + windows.astype(U64)).view(np.int64)


def slabs(texts: list[bytes], length: int) -> Iterator[tuple[np.ndarray, ...]]:
    """runs_of() for many texts; a text larger than a slab is taken in parts that overlap by a window less a byte."""
    batch: list[bytes] = []
    first = held = 0
    for i, t in enumerate(texts):
        if len(t) > SLAB:
            for at in range(0, len(t) - length + 1, SLAB):
                _, start, windows, gram, h = runs_of([t[at : at + SLAB + length - 1]], length)
                yield np.full(len(start), i), start + at, windows, gram, h
            t = b""
        if held + len(t) > SLAB and batch:
            text, *rest = runs_of(batch, length)
            yield text + first, *rest
            batch, held, first = [], 0, i
        batch.append(t)
        held += len(t)
    if batch:
        text, *rest = runs_of(batch, length)
        yield text + first, *rest


def runs(docs: DataFrame, length: int, located: bool) -> DataFrame:
    """The runs of docs (id, _sub, text): the gram alone, or with run, id, sub, start, windows."""
    names = ["gram", "run", "id", "_sub", "start", "windows"] if located else ["gram"]
    types = {"gram": "bigint", "run": "bigint", "id": docs.schema["id"].dataType.simpleString(), "_sub": "bigint", "start": "bigint", "windows": "int"}

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            ids, subs = b["id"].to_numpy(), b["_sub"].to_numpy()
            for text, start, windows, gram, h in slabs([t.encode() for t in b["text"]], length):
                if not located:
                    yield pd.DataFrame({"gram": gram})
                else:
                    yield pd.DataFrame({"gram": gram, "run": h, "id": ids[text], "_sub": subs[text], "start": start, "windows": windows.astype(np.int32)})

    return docs.mapInPandas(find, ", ".join(f"{n} {types[n]}" for n in names))


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Prefix doubling; symbols hold a unique separator after each string, so it ends once the longest is told apart."""
    n, step = len(symbols), 1
    both = symbols
    if symbols.max() < 2**15 - 1:  # few enough separators to take four symbols at once to begin with
        wide = np.zeros(n + 3, dtype=np.int64)
        wide[:n] = symbols + 1
        both, step = (wide[:n] << 48) | (wide[1 : n + 1] << 32) | (wide[2 : n + 2] << 16) | wide[3:], 4
    rank = np.empty(n, dtype=np.int64)
    while True:
        order = np.argsort(both, kind="stable")
        sorted_ = both[order]
        new = np.concatenate([[0], np.cumsum(sorted_[1:] != sorted_[:-1])])
        rank[order] = new
        if new[-1] == n - 1:
            return order
        after = np.zeros(n, dtype=np.int64)
        after[: max(0, n - step)] = rank[step:] + 1
        both = rank * (n + 1) + after
        step *= 2


def shared_prefixes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The suffix array of the texts and, for each of its rows, whether the suffix shares ``length`` bytes or more with
    the row before. Values come from the Burrows-Wheeler transform alone: the row that the backward extension of row q by
    its symbol leads to has a common prefix one longer than the least between q and the row before it with that symbol."""
    parts = []
    for i, t in enumerate(texts):
        parts += [np.frombuffer(t, dtype=np.uint8).astype(np.int64), np.array([256 + i])]
    symbols = np.concatenate(parts)
    n = len(symbols)
    order = suffix_array(symbols)
    bwt = symbols[order - 1]
    by_symbol = np.argsort(bwt, kind="stable")
    extension = np.empty(n, dtype=np.int64)  # row q extended by its symbol
    extension[by_symbol] = np.arange(n)
    same = bwt[by_symbol][1:] == bwt[by_symbol][:-1]
    before = np.full(n, -1, dtype=np.int64)  # the row before q with its symbol
    before[by_symbol[1:][same]] = by_symbol[:-1][same]
    # value 0: rows that start with another symbol than the row before
    found = np.zeros(n, dtype=bool)
    found[extension[before < 0]] = True
    here = np.flatnonzero(before >= 0).astype(np.int32)  # rows whose extension has no value yet
    there, leads = before[here].astype(np.int32), extension[here].astype(np.int32)
    fresh = found.copy()
    for _ in range(1, length):
        upto = np.cumsum(fresh, dtype=np.int32)
        if not len(here) or not upto[-1]:
            break
        hit = upto[here] > upto[there]
        rows = leads[hit]
        fresh = np.zeros(n, dtype=bool)
        fresh[rows] = True
        found[rows] = True
        here, there, leads = here[~hit], there[~hit], leads[~hit]
    shared = ~found
    shared[0] = False
    return order, shared


def repeats_in(texts: list[bytes], ids: np.ndarray, subs: np.ndarray, starts: np.ndarray, length: int) -> pd.DataFrame:
    """Spans (id, _sub, start, end) of the windows of texts that a text's window with an earlier (id, _sub, start) equals."""
    order, shared = shared_prefixes(texts, length)
    if not shared.any():
        return pd.DataFrame({"id": ids[:0], "_sub": subs[:0], "start": starts[:0], "end": starts[:0]})
    sizes = np.array([len(t) + 1 for t in texts])
    begins = np.concatenate([[0], np.cumsum(sizes)[:-1]])
    group = np.cumsum(~shared)
    rows = np.flatnonzero(shared | np.append(shared[1:], False))
    at, group = order[rows], group[rows]
    text = np.searchsorted(begins, at, side="right") - 1
    place = starts[text] + at - begins[text]
    by = np.lexsort((place, subs[text], ids[text], group))
    later = by[1:][group[by][1:] == group[by][:-1]]
    text, place = text[later], place[later]
    by = np.lexsort((place, text))
    text, place = text[by], place[by]
    first = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (place[1:] != place[:-1] + 1)]))
    last = np.append(first[1:], len(text)) - 1
    return pd.DataFrame({"id": ids[text[first]], "_sub": subs[text[first]], "start": place[first], "end": place[last] + length})


def pieces_of(docs: DataFrame, wanted: DataFrame, length: int) -> DataFrame:
    """(bucket, bytes, id, sub, start): the bytes of the wanted runs (id, _sub, start, windows, gram, many), those of a gram with
    many runs cut into pieces."""
    import xxhash

    lists = wanted.groupBy("id", "_sub").agg(F.collect_list(F.struct("gram", "start", "windows", "many")).alias("runs"))
    kind = docs.schema["id"].dataType.simpleString()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            out = []
            for key, sub, text, found in zip(b["id"], b["_sub"], b["text"], b["runs"], strict=True):
                data = text.encode()
                for r in found:
                    run = data[r["start"] : r["start"] + r["windows"] + length - 1]
                    if not r["many"]:
                        out.append((r["gram"], run, key, sub, r["start"]))
                        continue
                    grams = mix64(rolled(np.frombuffer(run, dtype=np.uint8), GRAM)[GRAM]).view(np.int64)
                    seat = int(np.flatnonzero(grams == r["gram"])[0])
                    first = 0
                    while first < r["windows"]:
                        block = (seat - first) // FINE  # windows that start so far before the gram
                        last = min(r["windows"] - 1, seat - block * FINE)
                        core = run[seat - block * FINE : seat - block * FINE - FINE + 1 + length]
                        bucket = int(np.uint64(xxhash.xxh64_intdigest(core, seed=block)).view(np.int64))
                        out.append((bucket, run[first : last + length], key, sub, r["start"] + first))
                        first = last + 1
            yield pd.DataFrame(out, columns=["bucket", "bytes", "id", "_sub", "start"])

    return docs.join(lists, ["id", "_sub"]).mapInPandas(cut, f"bucket bigint, bytes binary, id {kind}, _sub bigint, start bigint")


def in_buckets(pieces: DataFrame, length: int) -> DataFrame:
    """Spans (id, _sub, start, end) repeated within buckets. Sorted partitions are read as a stream; whole buckets are put
    together until they fill a suffix array."""
    rows = pieces.repartition("bucket").sortWithinPartitions("bucket")

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None
        for b in batches:
            held = b if held is None else pd.concat([held, b], ignore_index=True)
            buckets = held["bucket"].to_numpy()
            size = np.cumsum(held["bytes"].map(len).to_numpy())
            ends = np.flatnonzero(buckets[1:] != buckets[:-1]) + 1  # the last bucket may go on
            at = 0
            for e, following in zip(ends, np.append(ends, -1)[1:], strict=True):
                if following < 0 or size[following - 1] - (size[at - 1] if at else 0) > BUCKET_BYTES:
                    part = held.iloc[at:e]
                    yield repeats_in(list(part["bytes"]), part["id"].to_numpy(), part["_sub"].to_numpy(), part["start"].to_numpy(), length)
                    at = e
            held = held.iloc[at:]
        if held is not None and len(held):
            yield repeats_in(list(held["bytes"]), held["id"].to_numpy(), held["_sub"].to_numpy(), held["start"].to_numpy(), length)

    return rows.mapInPandas(find, f"id {pieces.schema['id'].dataType.simpleString()}, _sub bigint, start bigint, end bigint")


def repeated_spans(docs: DataFrame, length: int = 100, many: int = MANY) -> DataFrame:
    """(id, _sub, spans) of docs (id, _sub, text), id and _sub naming a text: array of struct(start, end) in bytes, by start; they may overlap."""
    spark = docs.sparkSession

    def after(first: str) -> Column:
        return (F.col("id") != F.col(f"{first}.id")) | (F.col("_sub") != F.col(f"{first}._sub")) | (F.col("start") != F.col(f"{first}.start"))

    # each step is written and what it read is deleted, so the steps' files and shuffles don't add up on disk; rows that
    # repeat a doc_id come twice up to the minima, which make them one, and equal spans are merged at the end
    again = keep(runs(docs, length, False).groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram"), "substring-grams")
    tidy(spark)
    found = keep(runs(docs, length, True).join(again, "gram"), "substring-runs")
    drop(again)
    tidy(spark)
    firsts = keep(found.groupBy("gram", "run", "windows").agg(F.min(F.struct("id", "_sub", "start")).alias("first")), "substring-firsts")
    later = found.join(firsts, ["gram", "run", "windows"]).where(after("first"))
    later = keep(later.select("id", "_sub", "start", (F.col("start") + F.col("windows") + (length - 1)).alias("end")), "substring-later")
    drop(found)
    tidy(spark)
    mixed = firsts.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram", (F.col("n") > many).alias("many"))
    wanted = keep(firsts.join(mixed, "gram").select(F.col("first.id").alias("id"), F.col("first._sub").alias("_sub"), F.col("first.start").alias("start"), "windows", "gram", "many"), "substring-wanted")
    drop(firsts)
    pieces = keep(pieces_of(docs, wanted, length), "substring-pieces")
    drop(wanted)
    tidy(spark)
    heads = keep(pieces.groupBy("bucket", "bytes").agg(F.min(F.struct("id", "_sub", "start")).alias("first")), "substring-heads")
    tidy(spark)
    equal = pieces.join(heads, ["bucket", "bytes"]).where(after("first"))
    equal = keep(equal.select("id", "_sub", "start", (F.col("start") + F.length("bytes")).alias("end")), "substring-equal")
    drop(pieces)
    tidy(spark)
    several = heads.groupBy("bucket").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("bucket")
    deep = keep(in_buckets(heads.join(several, "bucket").select("bucket", "bytes", "first.id", "first._sub", "first.start"), length), "substring-deep")
    drop(heads)
    spans = keep(later.unionByName(equal).unionByName(deep).groupBy("id", "_sub").agg(F.array_sort(F.collect_list(F.struct("start", "end"))).alias("spans")), "substring-spans")
    drop(later, equal, deep)
    tidy(spark)
    return spans


def named(docs: DataFrame) -> DataFrame:
    """docs (doc_id, text and any more) with (id, _sub), which name a text: _sub tells apart the texts of a doc_id that
    several rows have, or of none, and is 0 for all others, so it costs nothing to carry."""
    number = F.col("doc_id").cast("long")
    several = docs.select(number.alias("id")).where("id IS NOT NULL").groupBy("id").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("id", F.lit(True).alias("_several"))
    several = keep(several.withColumnRenamed("id", "_key"), "substring-several")
    # rows without a doc_id meet the list by their hash, whatever it says, so that they aren't dealt to one task
    text = F.xxhash64(text_or_empty())
    docs = docs.withColumn("_key", F.coalesce(number, text)).join(several, "_key", "left")
    sub = F.when(number.isNull() | F.col("_several"), text).otherwise(F.lit(0).cast("long"))
    return docs.withColumn("_sub", sub).withColumn("id", F.coalesce(number, F.lit(-(1 << 63)))).drop("_key", "_several")


def without_repeats(docs: DataFrame, length: int = 100, many: int = MANY) -> DataFrame:
    """docs (doc_id, text and any more) with n_bytes, removed (array of struct(start, end), the maximal removed runs of
    bytes) and kept (binary: what is left) in place of text."""
    docs = docs.drop("n_bytes", "removed", "kept")
    # the caller's columns go by their place, so that no name of theirs meets ours
    carried = {f"_in{i}": c for i, c in enumerate(c for c in docs.columns if c != "text")}
    docs = named(docs.select("doc_id", "text", *[F.col(c).alias(n) for n, c in carried.items()]))
    spans = repeated_spans(docs.select("id", "_sub", text_or_empty().alias("text")), length, many)
    rows = docs.join(spans, ["id", "_sub"], "left").drop("id", "_sub", "doc_id")
    fields = [f for f in rows.schema.fields if f.name not in ("text", "spans")]
    span = T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())])
    schema = T.StructType([*fields, T.StructField("n_bytes", T.LongType()), T.StructField("removed", T.ArrayType(span)), T.StructField("kept", T.BinaryType())])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            sizes, removed, kept = [], [], []
            for text, found in zip(b["text"], b["spans"], strict=True):
                data = (text or "").encode()
                whole: list[list[int]] = []
                for s in found if found is not None else ():
                    if whole and s["start"] <= whole[-1][1]:
                        whole[-1][1] = max(whole[-1][1], s["end"])
                    else:
                        whole.append([s["start"], s["end"]])
                at, left = 0, []
                for s, e in whole:
                    left.append(data[at:s])
                    at = e
                sizes.append(len(data))
                removed.append([{"start": s, "end": e} for s, e in whole])
                kept.append(b"".join([*left, data[at:]]))
            yield b.drop(columns=["text", "spans"]).assign(n_bytes=sizes, removed=removed, kept=kept)

    return rows.mapInPandas(cut, schema).select(*[F.col(n).alias(c) for n, c in carried.items()], "n_bytes", "removed", "kept")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = without_repeats(table(spark, sf_dir, "documents", "doc_id", "text"))
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, r: a + r["end"] - r["start"])
    return rows.select("doc_id", "n_bytes", gone.alias("n_removed"), F.size("removed").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


#: Every window of 100 bytes, as hexadecimal digits, but the first of equal ones.
ORACLE = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
starts AS (SELECT doc_id, h, unnest(range(0, len(h) // 2 - 99, 500)) AS base FROM docs),
parts AS (SELECT doc_id, base, substr(h, 2 * base + 1, 1198) AS part FROM starts),
windows AS (SELECT doc_id, base, part, unnest(range(0, len(part) // 2 - 99)) AS j FROM parts),
places AS (SELECT doc_id, base + j AS k, row_number() OVER (PARTITION BY md5(substr(part, 2 * j + 1, 200)) ORDER BY doc_id, base + j) AS place FROM windows),
repeats AS (SELECT doc_id, k, k > lag(k, 1, -200) OVER (PARTITION BY doc_id ORDER BY k) + 100 AS fresh FROM places WHERE place > 1),
numbered AS (SELECT doc_id, k, sum(fresh::INT) OVER (PARTITION BY doc_id ORDER BY k) AS span FROM repeats),
spans AS (SELECT doc_id, min(k) AS s, max(k) + 100 AS e FROM numbered GROUP BY doc_id, span),
pieces AS (SELECT doc_id, s, e, lag(e, 1, 0) OVER (PARTITION BY doc_id ORDER BY s) AS before FROM spans),
kept AS (SELECT p.doc_id, sum(e - s)::BIGINT AS n_removed, count(*) AS n_spans, string_agg(substr(h, 2 * before + 1, 2 * (s - before)), '' ORDER BY s) || substr(any_value(h), 2 * max(e) + 1) AS left_
  FROM pieces p JOIN docs d ON d.doc_id = p.doc_id GROUP BY p.doc_id)
SELECT d.doc_id, (len(h) // 2)::BIGINT AS n_bytes, coalesce(n_removed, 0) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(coalesce(left_, h))) AS kept_sha256
FROM docs d LEFT JOIN kept k ON k.doc_id = d.doc_id
"""

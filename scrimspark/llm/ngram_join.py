"""Operator 7: exact set-similarity join on word shingles by a partitioned universe.

Documents are compared by their sets of ``width``-word shingles; two link when their Jaccard similarity is at least
``percent`` / 100. Sets of n shingles that link with sets at least as large differ in at most H(n) shingles. For each
band of sizes the universe of shingles is hashed into segments. If a set has H + 1 segments, one of them must be the same
in both (pigeonhole); where segments may differ in one shingle, which the segment's one-deletion neighbourhood finds, half
as many are enough. Each band takes the cheaper of the two, counting index entries and the load of empty segments. Some
segments are added as slack, so that empty ones, which many sets share, need no entry unless a set has more of them than
slack; and a pair that links then shares several entries, which sorts out pairs that share some common phrase.

Equal sets are one node of the join. Every entry's members are first compared with one hub, the member that shares most with
others, each member with its best hub only, then with the rest of its hubs. Where the members of an entry still fall into
several components, members of different components are compared. What an entry costs is measured: the smaller set of a
pair leaves out as many of its most frequent entries as the pair shares beyond one, and a pair is taken up in one entry
only, the first that both share and the smaller one uses. Each set has a bitmap with the parity of its shingles in each of
some buckets; two bitmaps differ in no more bits than the sets in shingles, so most pairs are out after a look at them. The
first pass over an entry names the members that have a pair left; their texts then go to the entry once each, in blocks of
bounded bytes, and the pairs are compared exactly. A block gives back a spanning forest of its links, so neither pass
returns more rows than it reads, however large a group of copies is, and no link between components is lost.

"Exactly" means on sets of 64-bit shingle hashes. The result is components, not the single links.

Nulls, ties, empty input: null and wordless texts have an empty set and link with nothing; each row is a document, also
where rows share a doc_id or have none; a component's id is its smallest doc_id that isn't null; an empty table gives an
empty result. A text of any length is one row; its set (8 bytes a word) is the most that a task holds of it. Only doc_id
and text are read.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import WORD, drop, keep, mix64, small_batches, table, text_or_empty, tidy
from .components import components

U64 = np.uint64


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        if len(self) > 100_000:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def shingle_set(text: str, known: WordHashes, width: int) -> np.ndarray:
    """The sorted distinct shingle hashes of a text."""
    words = text.encode().lower().split()  # bytes: only A-Z change, only ASCII space separates
    if not words:
        return np.empty(0, dtype=U64)
    h = np.fromiter(map(known.__getitem__, words), dtype=U64, count=len(words))
    n = min(width, len(h))
    total = np.full(len(h) - n + 1, n, dtype=U64)
    for i in range(n):
        total = total * U64(0x9E3779B97F4A7C15) + h[i : len(h) - n + 1 + i]
    return np.unique(mix64(total))


class Plan:
    """The segments of each band for a threshold."""

    def __init__(self, percent: int):
        self.percent = percent
        self.least = next(n for n in range(1, 10_000) if self.differ(n) > 0)  # smaller sets link only with equal ones

    def differ(self, n: int) -> int:
        """H(n): how many shingles a set of n and one at least as large may have apart."""
        return (100 - self.percent) * (n + n * 100 // self.percent) // (100 + self.percent)

    def slack(self, n: int) -> int:
        return 1 + math.ceil(0.08 * (self.differ(n) + 1))

    def used(self, n: int) -> int:
        return self.differ(n) + 1 + self.slack(n)

    def band(self, n: int) -> int:
        return (n // self.least).bit_length() - 1

    def top(self, band: int) -> int:
        return self.least * 2 ** (band + 1) - 1

    @lru_cache(maxsize=64)  # noqa: B019
    def scheme(self, band: int) -> tuple[int, bool]:
        """The number of segments, and whether they are matched up to one deletion."""
        top = self.top(band)
        exact, deletion = self.used(top), (self.differ(top) + 2) // 2 + 1

        def load(segments: int, entries: float) -> float:
            return entries + 50 * segments * math.exp(-top / segments)

        if load(deletion, deletion + top) < load(exact, exact):
            return deletion, True
        return exact, False

    def bits(self, n: int) -> int:
        """Buckets of the bitmap: some sixteen for each shingle that may differ; twice as many with each band."""
        return 64 * 2 ** max(0, self.band(n) + (16 * self.differ(self.least * 2 - 1)).bit_length() - 6)

    def bands(self, n: int) -> list[int]:
        """The band of n, and the one below if partners can lie there."""
        own = self.band(n)
        return [own] + [own - 1] * (own > 0 and -(-n * self.percent // 100) <= self.top(own - 1))

    def entries(self, shingles: np.ndarray) -> tuple[np.ndarray, int]:
        """The index entries of a set, and how many of them a linked set of at least its size shares."""
        n, found, need = len(shingles), [], 1
        if n < self.least:
            return np.empty(0, dtype=U64), 1
        smaller = -(-n * self.percent // 100)
        for band in self.bands(n):
            segments, deletion = self.scheme(band)
            take = segments if deletion else min(self.used(n), segments)
            seed = U64((band + 1) * 0xD6E8FEB86659FD93 % 2**64)
            spread = mix64(shingles ^ seed)
            at = ((spread >> U64(32)) * U64(segments)) >> U64(32)
            order = np.argsort(at, kind="stable")
            at, values = at[order], mix64(spread)[order]
            first = np.flatnonzero(np.concatenate([[True], at[1:] != at[:-1]]))
            where, totals = at[first], np.add.reduceat(values, first)
            inside = where < take
            parts = [(where[inside], totals[inside])]
            empty = take - int(inside.sum())
            if deletion:
                parts.append((at, np.repeat(totals, np.diff(np.append(first, len(at)))) - values))
            if deletion or empty > self.slack(max(smaller, 1)):
                none = np.setdiff1d(np.arange(take, dtype=U64), where[inside])
                parts.append((none, np.zeros(len(none), dtype=U64)))
            elif band == self.band(n):
                need = max(1, self.slack(n) + 1 - empty)
            for where, totals in parts:
                found.append(mix64(totals + where * U64(0xA24BAED4963EE407) + seed))
        return np.unique(np.concatenate(found)), need


def parity(shingles: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap of ``bits`` (a power of two, 64 or more): for each bucket of the hash, the parity of its shingles."""
    flips = np.bincount((shingles & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(flips.astype(np.uint8), bitorder="little").view(np.int64)


def signatures(docs: DataFrame, percent: int, width: int) -> DataFrame:
    """(doc_id, _key, n_shingles, d1, d2, need, bits, entries) of docs (doc_id, text, _key); _key is row_key()."""
    plan = Plan(percent)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = WordHashes()
        for b in batches:
            rows = []
            for text in b["text"]:
                s = shingle_set(text or "", known, width)
                d1 = int(np.add.reduce(mix64(s), dtype=U64).astype(np.int64))
                d2 = int(np.add.reduce(mix64(s ^ U64(0x5851F42D4C957F2D)), dtype=U64).astype(np.int64))
                entries, need = plan.entries(s)
                bits = parity(s, plan.bits(len(s))) if len(s) >= plan.least else np.empty(0, dtype=np.int64)
                rows.append((len(s), d1, d2, need, bits, entries.view(np.int64)))
            yield pd.concat([b[["doc_id", "_key"]].reset_index(drop=True), pd.DataFrame(rows, columns=["n_shingles", "d1", "d2", "need", "bits", "entries"])], axis=1)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text", "_key").mapInPandas(run, f"doc_id {kind}, _key string, n_shingles bigint, d1 bigint, d2 bigint, need int, bits array<bigint>, entries array<bigint>")


def halved(bits: Column) -> Column:
    """A bitmap's halves xored: the bitmap of half as many buckets. Small ones stay as they are."""
    half = (F.size(bits) / 2).cast("int")
    return F.when(F.size(bits) > 16, F.zip_with(F.slice(bits, F.lit(1), half), F.slice(bits, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(bits)


#: Members of a block of the first pass, at most.
BLOCK = 2048
#: Shingles of a block of the second pass, about; a larger text has a block of its own.
BLOCK_SHINGLES = 1 << 20


def in_groups(rows: DataFrame, keys: list[str], each: Callable[[dict[str, np.ndarray]], list[tuple]], schema: str) -> DataFrame:
    """``each`` on the columns of each group of two rows or more; it gives a list of tuples. The sorted partitions are read
    as a stream and a task holds a group and a batch at most, so groups have to be bounded."""
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        parts: list[pd.DataFrame] = []  # all of one group
        for b in itertools.chain(batches, [None]):
            if b is not None:
                if not len(b):
                    continue
                parts.append(b)
                if (b[keys].iloc[-1].to_numpy() == parts[0][keys].iloc[0].to_numpy()).all():
                    continue  # the group may go on
            if not parts:
                continue
            held = pd.concat(parts, ignore_index=True)
            values = held[keys].to_numpy()
            ends = (np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist()
            if b is None:
                ends.append(len(held))
            columns = {c: held[c].to_numpy() for c in held.columns}
            at, out = 0, []
            for e in ends:
                if e - at > 1:
                    out.extend(each({c: v[at:e] for c, v in columns.items()}))
                at = e
            if out:
                yield pd.DataFrame(out, columns=names)
            parts = [held.iloc[at:]] if at < len(held) else []

    return rows.repartition(*keys).sortWithinPartitions(*keys).mapInPandas(run, schema)


def in_block_pairs(rows: DataFrame, blocks: Column) -> DataFrame:
    """rows (entry, node and any more) for each pair (low, high) of the blocks of their entry, which rows are dealt to by a
    hash of the node; own is the row's block."""
    rows = rows.withColumn("blocks", blocks.cast("int")).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return rows.withColumn("low", F.least("own", "other")).withColumn("high", F.greatest("own", "other")).drop("blocks", "other")


def fitting_pairs(g: dict[str, np.ndarray], n: np.ndarray, maps: list[np.ndarray], percent: int) -> Iterator[tuple[int, list[int], list[int]]]:
    """(i, js, bits apart) of the pairs of a block (node, label, own, low, high) that may link: with different labels and
    fitting sizes and bitmaps. i is the smaller set, of equal ones that with the smaller node. The maps' lengths are powers
    of two."""
    label, own, one_block = g["label"], g["own"], g["low"][0] == g["high"][0]
    order = np.lexsort((g["node"], n))
    if len(n) <= 24:  # without frames: most groups are small
        places, sizes, labels, blocks = order.tolist(), n.tolist(), label.tolist(), own.tolist()
        numbers = [int.from_bytes(m.tobytes(), "little") for m in maps]
        for k, i in enumerate(places):
            bits, js, apart = len(maps[i]) * 64, [], []
            for j in places[k + 1 :]:
                if sizes[i] * 100 < sizes[j] * percent:
                    break
                if labels[i] == labels[j] or not one_block and blocks[i] == blocks[j]:
                    continue
                y = numbers[j]
                if len(maps[j]) * 64 > bits:
                    y = (y >> bits) ^ (y & ((1 << bits) - 1))
                differ = (numbers[i] ^ y).bit_count()
                if differ <= (100 - percent) * (sizes[i] + sizes[j]) // (100 + percent):
                    js.append(j)
                    apart.append(differ)
            if js:
                yield i, js, apart
        return
    label, own, n, maps = label[order], own[order], n[order], [maps[i] for i in order]
    words = np.array([len(m) for m in maps])
    for size in np.unique(words):
        near = np.flatnonzero((words == size) | (words == 2 * size))
        table = np.stack([np.bitwise_xor.reduce(maps[i].reshape(-1, size)) for i in near])
        for k, i in enumerate(near):
            if words[i] != size:
                continue
            js = np.arange(k + 1, np.searchsorted(n[near], n[i] * 100 // percent, side="right"))
            js = js[label[near[js]] != label[i]]
            if not one_block:
                js = js[own[near[js]] != own[i]]
            if len(js):
                apart = np.bitwise_count(table[js] ^ table[k]).sum(axis=1)
                good = apart <= (100 - percent) * (n[i] + n[near[js]]) // (100 + percent)
                if good.any():
                    yield int(order[i]), order[near[js[good]]].tolist(), apart[good].tolist()


def candidates(rows: DataFrame, percent: int, block: int) -> DataFrame:
    """(entry, node, use): the members of rows (entry, members, node, label, n, bits, use[, uses, all_]) that have a pair to
    compare in this entry. use says whether the set uses the entry as the smaller one of a pair; uses and all_ are the
    entries that it uses and all that it has: with them, a pair is taken up in one entry only."""
    once = "uses" in rows.columns

    def each(g: dict[str, np.ndarray]) -> list[tuple]:
        entry, node, use = int(g["entry"][0]), g["node"].tolist(), g["use"].tolist()
        maps = [np.asarray(x, dtype=np.int64).view(U64) for x in g["bits"]]
        sets: dict[int, set] = {}
        found: set[int] = set()
        for i, js, _ in fitting_pairs(g, g["n"], maps, percent):
            if not use[i]:
                continue
            if once:
                uses, kept = set(g["uses"][i].tolist()), []
                for j in js:
                    if j not in sets:
                        sets[j] = set(g["all_"][j].tolist())
                    if min(uses & sets[j]) == entry:
                        kept.append(j)
                js = kept
            if js:
                found.add(i)
                found.update(js)
        return [(entry, node[i], use[i]) for i in sorted(found)]

    spread = in_block_pairs(rows, F.ceil(F.col("members") / block)).drop("members")
    return in_groups(spread, ["entry", "low", "high"], each, "entry bigint, node bigint, use boolean").distinct()


def forest(rows: DataFrame, texts: DataFrame, percent: int, width: int, block_shingles: int) -> DataFrame:
    """(a, b): links that connect the members of rows (entry, node, label, n) as all their links within the entries do."""
    plan, known = Plan(percent), WordHashes()

    def each(g: dict[str, np.ndarray]) -> list[tuple]:
        node, label = g["node"].tolist(), g["label"].tolist()
        sets = [shingle_set(t, known, width) for t in g["text"]]
        maps = [parity(s, plan.bits(len(s))).view(U64) for s in sets]
        root = {x: x for x in label}

        def find(x: int) -> int:
            while root[x] != x:
                root[x] = x = root[root[x]]
            return x

        out = []
        for i, js, apart in fitting_pairs(g, np.array([len(s) for s in sets]), maps, percent):
            for _, j in sorted(zip(apart, js, strict=True)):
                x, y = find(label[i]), find(label[j])
                if x != y and linked(sets[i], sets[j], percent):
                    root[y] = x
                    out.append((node[i], node[j]))
        return out

    total = rows.groupBy("entry").agg(F.sum("n").alias("_total"))
    spread = in_block_pairs(rows.join(total, "entry"), F.ceil(F.col("_total") / block_shingles)).drop("_total", "n")
    return in_groups(spread.join(texts, "node"), ["entry", "low", "high"], each, "a bigint, b bigint")


def linked(s: np.ndarray, t: np.ndarray, percent: int) -> bool:
    """Whether two sorted sets link."""
    if len(s) > len(t):
        s, t = t, s
    both = int((t[np.minimum(np.searchsorted(t, s), len(t) - 1)] == s).sum()) if len(t) else 0
    return both > 0 and 100 * both >= percent * (len(s) + len(t) - both)


def star_links(stars: DataFrame, texts: DataFrame, percent: int, width: int) -> DataFrame:
    """The links of stars (a, hub): texts meet their hub's in blocks, each text once for each of its hubs."""
    known = WordHashes()
    blocks = stars.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    leaves = stars.join(blocks, "hub").select("hub", F.pmod(F.xxhash64("a"), F.col("blocks")).cast("int").alias("part"), F.col("a").alias("node"))
    hubs = blocks.select("hub", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("part"), F.col("hub").alias("node"))
    rows = leaves.unionByName(hubs).join(texts, "node").withColumn("leaf", (F.col("node") != F.col("hub")).cast("int"))
    rows = rows.repartition("hub", "part").sortWithinPartitions("hub", "part", "leaf")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        center = np.empty(0, dtype=U64)
        for b in batches:
            out = []
            for hub, node, text in zip(b["hub"].tolist(), b["node"].tolist(), b["text"], strict=True):
                s = shingle_set(text, known, width)
                if node == hub:
                    center = s
                elif linked(s, center, percent):
                    out.append((node, hub))
            yield pd.DataFrame(out, columns=["a", "b"])

    return rows.mapInPandas(run, "a bigint, b bigint")


def row_key() -> Column:
    """What tells a row (doc_id, text) from others: rows equal in both are one document."""
    return F.md5(F.concat(F.col("doc_id").isNull().cast("string"), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), text_or_empty()))


def labelled(docs: DataFrame, percent: int, width: int, block: int, block_shingles: int) -> DataFrame:
    """(doc_id, _key, n_shingles, label) for each row of docs (doc_id, text): _key is row_key(), label the number of the
    row's component, null for an empty set."""
    small_batches(docs.sparkSession)
    docs = docs.select("doc_id", text_or_empty().alias("text"), row_key().alias("_key"))
    spark = docs.sparkSession
    sizes = keep(signatures(docs, percent, width), "join-sizes")
    # equal sets are one node; its text is that of its smallest doc_id and hash
    same = sizes.where("n_shingles > 0").groupBy("d1", "d2", "n_shingles").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("first"), F.first("need").alias("need"), F.first("bits").alias("bits"), F.first("entries").alias("entries")
    )
    same = keep(same.withColumn("node", F.monotonically_increasing_id()), "join-nodes")
    whole, sizes = sizes, keep(sizes.select("doc_id", "_key", "n_shingles", "d1", "d2"), "join-sizes")
    drop(whole)
    nodes = keep(same.select("node", F.col("n_shingles").alias("n"), "need", "bits"), "join-bitmaps")

    entries = same.select("node", F.explode("entries").alias("entry"))
    shared = entries.groupBy("entry").agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select("entry")
    shared = keep(entries.join(shared, "entry"), "join-shared")
    keys = keep(same.select("node", "d1", "d2", "n_shingles", "first._key"), "join-keys")
    drop(same)
    tidy(spark)
    # entries with the same members give the same pairs: of those one stands for all, and ``times`` counts them
    mark = [F.bit_xor(F.xxhash64("node")).alias("x1"), F.bit_xor(F.xxhash64("node", F.lit(7))).alias("x2")]
    live = shared.groupBy("entry").agg(F.count(F.lit(1)).alias("members"), *mark)
    live = live.groupBy("members", "x1", "x2").agg(F.min("entry").alias("entry"), F.count(F.lit(1)).alias("times")).select("entry", "members", "times")
    index = keep(shared.join(live, "entry"), "join-index")
    drop(shared)
    tidy(spark)

    weight = index.groupBy("node").agg(F.sum(F.col("members") * F.col("times")).alias("weight"))
    hubs = index.join(weight, "node").groupBy("entry").agg(F.max(F.struct("weight", "node"))["node"].alias("hub"))
    stars = index.join(hubs, "entry").where(F.col("node") != F.col("hub")).groupBy(F.col("node").alias("a"), "hub").agg(F.sum("times").alias("support"))
    stars = keep(fitting(stars, nodes, percent), "join-stars")
    wanted = keys.join(index.select("node").distinct(), "node", "left_semi").select("node", "_key")
    texts = keep(docs.select("_key", "text").join(wanted, "_key").groupBy("node").agg(F.first("text").alias("text")), "join-texts")
    tidy(spark)

    def apart(labels: DataFrame) -> DataFrame:
        """The stars whose ends are not connected yet."""
        rows = stars.join(labels.toDF("a", "la"), "a", "left").join(labels.toDF("hub", "lb"), "hub", "left")
        return rows.where(F.coalesce("la", "a") != F.coalesce("lb", "hub")).select("a", "hub")

    best = stars.groupBy("a").agg(F.max(F.struct("support", "hub"))["hub"].alias("hub"))
    links = keep(star_links(best, texts, percent, width), "join-links")
    more = keep(star_links(apart(components(links)), texts, percent, width), "join-links")
    links = links.unionByName(more)
    labels = components(links)
    tidy(spark)

    named = index.join(labels.toDF("node", "label"), "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = named.groupBy("entry").agg(F.min("label").alias("_low"), F.max("label").alias("_high")).where("_low < _high").select("entry")
    named = keep(named.join(split, "entry"), "join-split")
    # of a set's entries, the most frequent ones that together are fewer than those a pair shares are left out
    costly = Window.partitionBy("node").orderBy(F.col("members").desc(), "entry").rowsBetween(Window.unboundedPreceding, 0)
    used = named.withColumn("_upto", F.sum("times").over(costly)).join(nodes.select("node", "need"), "node").where(F.col("_upto") >= F.col("need"))
    used = used.select("node", "entry", F.lit(True).alias("use"))
    marked = named.join(used, ["node", "entry"], "left").select("entry", "members", "node", "label", F.coalesce("use", F.lit(False)).alias("use"))
    wide = nodes.select("node", "n", halved(F.col("bits")).alias("bits"))
    some = keep(candidates(marked.join(wide, "node"), percent, block), "join-candidates")
    tidy(spark)
    # most rows are gone; what is left can carry the lists of entries
    lists = some.groupBy("node").agg(F.collect_list("entry").alias("all_"), F.collect_list(F.when(F.col("use"), F.col("entry"))).alias("uses"))
    members = some.groupBy("entry").agg(F.count(F.lit(1)).alias("members"))
    described = some.join(members, "entry").join(named.select("entry", "node", "label"), ["entry", "node"]).join(wide, "node")
    before, some = some, keep(candidates(described.join(lists, "node"), percent, block), "join-candidates")
    drop(before)
    drop(index)
    tidy(spark)
    rows = some.join(named.select("entry", "node", "label"), ["entry", "node"]).join(nodes.select("node", "n"), "node")
    last = keep(forest(rows, texts, percent, width, block_shingles), "join-links")
    if not last.isEmpty():
        labels = components(links.unionByName(last))
    drop(named, stars, texts, some, nodes)
    tidy(spark)
    named = keys.join(labels.toDF("node", "label"), "node", "left").select("d1", "d2", "n_shingles", F.coalesce("label", "node").alias("label"))
    result = keep(sizes.join(named, ["d1", "d2", "n_shingles"], "left").select("doc_id", "_key", "n_shingles", "label"), "join-labels")
    drop(keys, sizes)
    return result


def differing_bits(a: Column, b: Column) -> Column:
    """Bits in which two bitmaps differ, the larger folded to the size of the smaller. Bands are next to each other, so one
    fold is enough."""

    def folded(x: Column, other: Column) -> Column:
        half = (F.size(x) / 2).cast("int")
        return F.when(F.size(x) > F.size(other), F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))).otherwise(x)

    return F.aggregate(F.zip_with(folded(a, b), folded(b, a), lambda u, v: F.bit_count(u.bitwiseXOR(v))), F.lit(0), lambda t, n: t + n)


def fitting(stars: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Stars (a, hub and any more) whose sizes and bitmaps allow a link."""
    one = nodes.select(F.col("node").alias("a"), F.col("n").alias("_na"), F.col("bits").alias("_ba"))
    two = nodes.select(F.col("node").alias("hub"), F.col("n").alias("_nb"), F.col("bits").alias("_bb"))
    sizes = stars.join(one.drop("_ba"), "a").join(two.drop("_bb"), "hub").where(F.least("_na", "_nb") * 100 >= F.greatest("_na", "_nb") * percent)
    most = F.floor((100 - percent) * (F.col("_na") + F.col("_nb")) / (100 + percent))
    rows = sizes.join(one.select("a", "_ba"), "a").join(two.select("hub", "_bb"), "hub").where(differing_bits(F.col("_ba"), F.col("_bb")) <= most)
    return rows.drop("_na", "_nb", "_ba", "_bb")


def similar_groups(docs: DataFrame, percent: int = 85, width: int = 4, block: int = BLOCK, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row of docs (doc_id, text). A null doc_id has a null component_id."""
    rows = labelled(docs, percent, width, block, block_shingles)
    least = rows.where("label IS NOT NULL").groupBy("label").agg(F.min("doc_id").alias("_least"))
    component = F.when(F.col("label").isNull() | F.col("doc_id").isNull(), F.col("doc_id")).otherwise(F.col("_least"))
    return rows.join(least, "label", "left").select("doc_id", "n_shingles", component.alias("component_id"))


def first_of_each(docs: DataFrame, percent: int = 80, width: int = 5) -> DataFrame:
    """Of each component's rows of docs the one with the smallest doc_id (none comes last, equal ones go by a hash of the
    text); rows equal in doc_id and text count as one. Wordless texts stay."""
    rows = labelled(docs, percent, width, BLOCK, BLOCK_SHINGLES)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_key")).alias("first")
    stay = rows.where("label IS NOT NULL").groupBy("label").agg(first).select("first._key")
    stay = stay.unionByName(rows.where("label IS NULL").select("_key")).withColumnRenamed("_key", "_ngram_key")
    # the caller's columns are one, so no name of theirs meets ours
    kept = docs.select(F.struct(*docs.columns).alias("_row"), row_key().alias("_ngram_key")).join(stay, "_ngram_key", "left_semi")
    return kept.dropDuplicates(["_ngram_key"]).select("_row.*")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return similar_groups(table(spark, sf_dir, "documents", "doc_id", "text"))


#: All shared shingles of all pairs, and the closure of the links.
ORACLE = f"""
WITH RECURSIVE docs AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{WORD}') AS w FROM documents),
places AS (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM docs WHERE len(w) > 0),
shingles AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 3], ' ') AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
shared AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM shingles a JOIN shingles b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM shared JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 85 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id AS a, doc_id AS b FROM docs UNION SELECT r.a, e.y FROM reach r JOIN edges e ON r.b = e.x)
SELECT d.doc_id, coalesce(any_value(n), 0)::BIGINT AS n_shingles, min(b) AS component_id FROM docs d JOIN reach r ON r.a = d.doc_id LEFT JOIN sizes s ON s.doc_id = d.doc_id GROUP BY d.doc_id
"""

"""Operator 11: conversation prefix trie, as balanced parentheses for each shard with shared spines merged.

A turn is 128 bits of the SHA-256 of its role and text, so texts don't move and turns are compared by digest. Conversations
are dealt by range of (sequence of digests, conv_id) into shards of about ``shard_turns``; equal sequences are split by
conv_id, so neither a common first turn nor a common conversation is one task's work. A shard writes its trie as
parentheses in preorder. A range min-max tree over blocks of their excess answers findclose, which delimits subtrees; the
rank of "()" counts the leaves in one; running sums of the savings give its total.

Nodes on the paths of a shard's first and last sequence, the spine, may go on in its neighbours. A shard returns their
parts: members, children and leaves and savings off the spine. Parts of one prefix are added up; what the spine's own nodes
add to their ancestors is a running sum along a path of the shard that has the node first. Spines have as many rows as
there are shards times turns in a conversation. Children of a spine node learn their parent's number by (shard, depth).

Ids that end at a node are in one shard's order, or, on the spine, come as ordered pieces that one task streams through
SHA-256, as the digest of a sequence can't be taken in parallel.

Nulls, ties, empty input: null roles and texts become empty; a null turn comes first, and turns that share a number go by
digest; rows without conv_id belong to no conversation; rows that repeat are turns of their own; a conversation, as digests,
is one task's row, whatever the length of its texts; no conversation at all gives no node, not even the root. The remainder
of a negative conv_id is SQL's. Other columns of the input are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import drop, keep, table

OUTPUT = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
BLOCK = 256
NO_IDS = hashlib.sha256(b"").hexdigest()
#: Ids in a piece of the list that ends at a spine node.
PIECE = 4096


def rebuilt(turns: DataFrame, every: int = 5, heads: int = 9) -> DataFrame:
    """(conv_id, digests, sizes): each conversation's first h turns come from conversation conv_id - conv_id % every, h being
    crc32 of conv_id in decimal, modulo heads; then its own turns after its first h."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.substring(F.sha2(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text), 256), 1, 32)
    turn = F.struct("turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("size"))
    whole = turns.where("conv_id IS NOT NULL").groupBy("conv_id").agg(F.array_sort(F.collect_list(turn)).alias("own"))
    whole = keep(whole.select("conv_id", F.transform("own", lambda t: F.struct(F.unhex(t["digest"]).alias("digest"), t["size"].alias("size"))).alias("own")), "trie-conversations")
    first = whole.where(F.col("conv_id") % every == 0).select(F.col("conv_id").alias("_base"), F.col("own").alias("_lent"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).cast("int")
    rows = whole.join(first, F.col("conv_id") - F.col("conv_id") % every == F.col("_base"), "left").withColumn("_h", h)
    none = F.slice("own", F.lit(1), F.lit(0))
    tail = F.when(F.size("own") > F.col("_h"), F.slice("own", F.col("_h") + 1, F.greatest(F.size("own") - F.col("_h"), F.lit(0)))).otherwise(none)
    seq = F.concat(F.coalesce(F.slice("_lent", F.lit(1), F.col("_h")), none), tail)
    return rows.select("conv_id", seq["digest"].alias("digests"), seq["size"].alias("sizes"))


class Parentheses:
    """A sequence of balanced parentheses (True opens) with a range min-max tree over the excess of its blocks."""

    def __init__(self, opens: np.ndarray):
        self.opens = opens
        self.excess = np.cumsum(np.where(opens, 1, -1))
        blocks = -(-len(opens) // BLOCK)
        least = np.full(1 << max(blocks - 1, 0).bit_length(), np.iinfo(np.int64).max)
        least[:blocks] = np.minimum.reduceat(self.excess, np.arange(0, len(opens), BLOCK)) if blocks else []
        self.levels = [least]  # from the blocks up to the root
        while len(self.levels[-1]) > 1:
            self.levels.append(self.levels[-1].reshape(-1, 2).min(axis=1))
        leaf = opens & ~np.append(opens[1:], True)
        self.pairs = np.append(0, np.cumsum(leaf))  # pairs[i]: "()" that begin before i

    def findclose(self, i: int) -> int:
        """The place of the parenthesis that closes the one at i: the first after it where the excess falls below its own."""
        below = self.excess[i] - 1
        at = self._within(i + 1, below)
        if at >= 0:
            return at
        level, k = 0, i // BLOCK
        while k % 2 or self.levels[level][k + 1] > below:  # up, until a block to the right goes that low
            level, k = level + 1, k // 2
        k += 1
        while level:  # and down to the first such block
            level, k = level - 1, 2 * k
            k += self.levels[level][k] > below
        return self._within(k * BLOCK, below)

    def _within(self, start: int, below: int) -> int:
        """The first place from start on, in its block, where the excess is no more than below; -1 if there is none."""
        hit = self.excess[start : (start // BLOCK + 1) * BLOCK] <= below
        at = int(hit.argmax()) if len(hit) else 0
        return start + at if len(hit) and hit[at] else -1

    def leaves(self, start: int, end: int) -> int:
        """The rank of "()" between start and end, which is a closing place."""
        return int(self.pairs[end] - self.pairs[start])


class Shard:
    """The trie of sorted (digests, conv_id) pairs: arrays by node in preorder, the root first."""

    def __init__(self, ids: np.ndarray, sequences: list[list[bytes]], sizes: list[list[int]]):
        opens, depth, parent, size, first, last, ends = [True], [0], [-1], [0], [0], [len(ids)], [[]]
        path, before = [0], []
        for c, seq in enumerate(sequences):
            shared = 0
            while shared < min(len(before), len(seq)) and before[shared] == seq[shared]:
                shared += 1
            for _ in range(len(before) - shared):
                last[path.pop()] = c
                opens.append(False)
            for d in range(shared, len(seq)):
                parent.append(path[-1])
                path.append(len(depth))
                opens.append(True)
                depth.append(d + 1)
                size.append(sizes[c][d])
                first.append(c)
                last.append(len(ids))
                ends.append([])
            ends[path[-1]].append(c)
            before = seq
            if not c:
                self.left = list(path)
        opens += [False] * len(path)
        self.right = list(path)
        self.ids, self.ends = ids, ends
        self.depth, self.parent, self.size = np.array(depth), np.array(parent), np.array(size, dtype=np.int64)
        self.first, self.n_convs = np.array(first), np.array(last) - np.array(first)
        self.brackets = Parentheses(np.array(opens))
        self.opening = np.flatnonzero(self.brackets.opens)
        # members of a node are consecutive but not sorted by id
        self.least = np.minimum.reduceat(np.append(ids, np.iinfo(np.int64).max), np.stack([self.first, np.array(last)], axis=1).ravel())[::2]

    def totals(self, spine: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(children, leaves, savings) of each node in its subtree, without the nodes of the spine."""
        off = ~spine
        children = np.bincount(self.parent[1:][off[1:]], minlength=len(off))
        saved = np.append(0, np.cumsum(np.where(off, (self.n_convs - 1) * self.size, 0)))
        close = np.array([self.brackets.findclose(i) for i in self.opening])
        after = np.searchsorted(self.opening, close)  # nodes from i to after are its subtree
        leaf = self.brackets.pairs[1:][self.opening] > self.brackets.pairs[self.opening]
        own = np.append(0, np.cumsum(leaf & spine))
        at = np.arange(len(off))
        leaves = np.array([self.brackets.leaves(i, j) for i, j in zip(self.opening, close, strict=True)]) - (own[after] - own[at])
        return children, leaves, saved[after] - saved[at]


def ids_digest(ids: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, ids.tolist())).encode()).hexdigest() if len(ids) else NO_IDS


ROWS = pa.schema([
    *[(n, pa.int64()) for n in ("shard", "side", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "size")],
    *[(n, pa.string()) for n in ("kind", "ends_sha256", "piece")],
    *[(n, pa.binary()) for n in ("prefix", "parent_prefix")],
])

KINDS = {pa.int64(): "bigint", pa.string(): "string", pa.binary(): "binary"}


def batch(n: int, **columns) -> pa.RecordBatch:
    """n rows of ROWS; a number or a text stands for a whole column, and columns that aren't given are null."""
    arrays = []
    for f in ROWS:
        x = columns.get(f.name)
        arrays.append(pa.array([x] * n if x is None or isinstance(x, int | str) else x, f.type))
    return pa.RecordBatch.from_arrays(arrays, schema=ROWS)


def shard_rows(shard: int, ids: np.ndarray, sequences: list[list[bytes]], sizes: list[list[int]]) -> Iterator[pa.RecordBatch]:
    """Rows of three kinds: "node" (complete but for parents on the spine), "spine" (parts, for each side of the shard), and
    "ends" (pieces of the ids that end at a spine node)."""
    trie = Shard(ids, sequences, sizes)
    spine = np.zeros(len(trie.depth), dtype=bool)
    spine[[*trie.left, *trie.right]] = True
    children, leaves, saved = trie.totals(spine)
    inner = np.flatnonzero(~spine)
    up = trie.parent[inner]
    ends = [ids_digest(ids[trie.ends[i]]) for i in inner]
    side = np.where(np.isin(up, trie.left), 0, 1)
    number = pa.array(trie.least[up], mask=spine[up])
    yield batch(len(inner), shard=shard, kind="node", side=side, depth=trie.depth[inner], conv_id=trie.least[inner], parent_conv_id=number, n_convs=trie.n_convs[inner], n_children=children[inner], n_leaves=leaves[inner], saved_tokens=saved[inner], ends_sha256=ends)
    there = set()
    for side, path, seq in ((0, trie.left, sequences[0]), (1, trie.right, sequences[-1])):
        new = np.array([i not in there for i in path])
        there.update(path)
        prefixes = [hashlib.sha256(b"").digest()]
        for turn in seq:
            prefixes.append(hashlib.sha256(prefixes[-1] + turn).digest())
        parts = {n: np.where(new, x[path], 0) for n, x in (("n_convs", trie.n_convs), ("n_children", children), ("n_leaves", leaves), ("saved_tokens", saved))}
        yield batch(len(path), shard=shard, kind="spine", side=side, depth=np.arange(len(path)), conv_id=trie.least[path], size=trie.size[path], prefix=prefixes, parent_prefix=[None, *prefixes[:-1]], **parts)
        for i, prefix, fresh in zip(path, prefixes, new, strict=True):
            mine = ids[trie.ends[i]] if fresh else ids[:0]
            for s in range(0, len(mine), PIECE):
                yield batch(1, shard=shard, kind="ends", conv_id=[mine[s]], prefix=[prefix], piece=[",".join(map(str, mine[s : s + PIECE].tolist()))])


def streamed_digests(pieces: DataFrame) -> DataFrame:
    """(prefix, ends_sha256) of the ordered pieces of each prefix; a task holds one piece at a time."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def digest() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict({"prefix": pa.array([prefix], pa.binary()), "ends_sha256": [state.hexdigest()]})

        prefix, state = None, None
        for b in batches:
            for p, piece in zip(b.column("prefix").to_pylist(), b.column("piece").to_pylist(), strict=True):
                if p == prefix:
                    state.update(b"," + piece.encode())
                else:
                    if state:
                        yield digest()
                    prefix, state = p, hashlib.sha256(piece.encode())
        if state:
            yield digest()

    return pieces.repartition("prefix").sortWithinPartitions("prefix", "conv_id").select("prefix", "piece").mapInArrow(run, "prefix binary, ends_sha256 string")


def merged_spine(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes on spines, complete) and (shard, side, depth, parent number) for what hangs on them. One row for each shard,
    side and depth enters."""
    spine = rows.where("kind = 'spine'")
    at = F.struct("shard", "side")
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    whole = spine.groupBy("prefix").agg(F.min("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums, F.max("size").alias("size"), F.max("parent_prefix").alias("parent_prefix"), F.min(at).alias("owner"))
    below = whole.where("parent_prefix IS NOT NULL").groupBy(F.col("parent_prefix").alias("_p")).agg(F.count(F.lit(1)).alias("_on_spine"))
    whole = whole.join(below, F.col("prefix") == F.col("_p"), "left").drop("_p").withColumn("n_children", F.col("n_children") + F.coalesce("_on_spine", F.lit(0))).drop("_on_spine")
    whole = keep(whole, "trie-spine")
    own = whole.select("prefix", "owner", F.when(F.col("n_children") == 0, 1).otherwise(0).alias("_leaf"), ((F.col("n_convs") - 1) * F.col("size")).alias("_saved"))
    # a node counts on one path only, that of its first shard, where all of its ancestors are
    path = Window.partitionBy("shard", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    mine = spine.select("prefix", "shard", "side", "depth").join(own, "prefix")
    one = F.col("owner") == at
    up = mine.select("prefix", *[F.sum(F.when(one, F.col(c)).otherwise(0)).over(path).alias(c) for c in ("_leaf", "_saved")])
    up = up.groupBy("prefix").agg(F.sum("_leaf").alias("_leaf"), F.sum("_saved").alias("_saved"))
    done = whole.join(up, "prefix").withColumn("n_leaves", F.col("n_leaves") + F.col("_leaf")).withColumn("saved_tokens", F.col("saved_tokens") + F.col("_saved"))
    done = done.join(streamed_digests(rows.where("kind = 'ends'")), "prefix", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_IDS)))
    numbers = whole.select(F.col("prefix").alias("_p"), F.col("conv_id").alias("parent_conv_id"))
    done = done.join(numbers, F.col("parent_prefix") == F.col("_p"), "left")
    hooks = spine.select(F.col("shard").alias("_shard"), F.col("side").alias("_side"), (F.col("depth") + 1).alias("_depth"), F.col("prefix").alias("_q")).join(numbers, F.col("_q") == F.col("_p"))
    return done.select(*OUTPUT), hooks.select("_shard", "_side", "_depth", F.col("parent_conv_id").alias("_number"))


def shard_count(sequences: DataFrame, shard_turns: int) -> int:
    n = sequences.agg(F.sum(F.size("digests") + 1)).first()[0] or 0
    return max(1, -(-n // shard_turns))


def prefix_trie(sequences: DataFrame, shard_turns: int = 50_000) -> DataFrame:
    """The nodes (OUTPUT) of the trie of sequences (conv_id, digests array<binary>, sizes array<bigint>), conv_id unique."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, seqs, sizes = [], [], []
        for b in batches:
            ids += b.column("conv_id").to_pylist()
            seqs += b.column("digests").to_pylist()
            sizes += b.column("sizes").to_pylist()
        if ids:
            yield from shard_rows(TaskContext.get().partitionId(), np.array(ids, dtype=np.int64), seqs, sizes)

    order: list[Column] = [F.col("digests"), F.col("conv_id")]
    sorted_ = sequences.repartitionByRange(shard_count(sequences, shard_turns), *order).sortWithinPartitions(*order)
    rows = keep(sorted_.mapInArrow(run, ", ".join(f"{f.name} {KINDS[f.type]}" for f in ROWS)), "trie-shards")
    spine, hooks = merged_spine(rows)
    nodes = rows.where("kind = 'node'")
    hung = nodes.where("parent_conv_id IS NULL").join(keep(hooks, "trie-hooks"), (F.col("shard") == F.col("_shard")) & (F.col("side") == F.col("_side")) & (F.col("depth") == F.col("_depth")))
    hung = hung.withColumn("parent_conv_id", F.col("_number"))
    return nodes.where("parent_conv_id IS NOT NULL").select(*OUTPUT).unionByName(hung.select(*OUTPUT)).unionByName(spine)


def conversation_trie(turns: DataFrame, shard_turns: int = 50_000) -> DataFrame:
    """The trie of the rebuilt conversations of turns (conv_id, turn, role, text)."""
    sequences = keep(rebuilt(turns), "trie-sequences")
    out = prefix_trie(sequences, shard_turns)
    drop(sequences)
    return out


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations", "conv_id", "turn", "role", "text"))


def _crc32(text: str) -> str:
    """CRC-32 of an ASCII text in DuckDB, bit by bit."""
    step = "lambda a, c: " + "list_reduce(list_concat([xor(a, c)], range(8)), lambda x, y: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split({text}, ''), lambda c: ascii(c)::BIGINT)), {step}), 4294967295)"


ORACLE = f"""
WITH turns AS (SELECT conv_id, turn, substr(sha256(strlen(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')), 1, 32) AS digest, strlen(coalesce(text, '')) AS size FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT conv_id, list(digest ORDER BY turn NULLS FIRST, digest) AS digests, list(size ORDER BY turn NULLS FIRST, digest) AS sizes FROM turns GROUP BY conv_id),
heads AS (SELECT *, ({_crc32('conv_id::VARCHAR')} % 9)::BIGINT AS h FROM own),
built AS (SELECT a.conv_id, list_concat(coalesce(b.digests, [])[1:a.h], a.digests[a.h + 1:]) AS digests, list_concat(coalesce(b.sizes, [])[1:a.h], a.sizes[a.h + 1:]) AS sizes FROM heads a LEFT JOIN own b ON b.conv_id = a.conv_id - a.conv_id % 5),
steps AS (SELECT conv_id, unnest(range(len(digests) + 1)) AS depth, digests, sizes FROM built),
prefixes AS (SELECT conv_id, depth, sha256(array_to_string(digests[1:depth], ',')) AS prefix, CASE WHEN depth > 0 THEN sha256(array_to_string(digests[1:depth - 1], ',')) END AS above, coalesce(sizes[depth], 0) AS size, len(digests) = depth AS ends FROM steps),
nodes AS (SELECT prefix, depth, min(conv_id) AS conv_id, any_value(above) AS above, count(*) AS n_convs, any_value(size) AS size, coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE ends), '') AS ends FROM prefixes GROUP BY prefix, depth),
kids AS (SELECT above AS prefix, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT x.*, coalesce(n, 0) AS n_children FROM nodes x LEFT JOIN kids USING (prefix, depth)),
under AS (SELECT p.prefix, p.depth, sum((n_children = 0)::INT)::BIGINT AS n_leaves, sum((n_convs - 1) * c.size)::BIGINT AS saved_tokens FROM counted c JOIN prefixes p ON p.conv_id = c.conv_id AND p.depth <= c.depth GROUP BY ALL)
SELECT x.conv_id, x.depth, up.conv_id AS parent_conv_id, x.n_convs, x.n_children, n_leaves, saved_tokens, sha256(x.ends) AS ends_sha256 FROM counted x JOIN under USING (prefix, depth) LEFT JOIN counted up ON up.prefix = x.above AND up.depth = x.depth - 1
"""

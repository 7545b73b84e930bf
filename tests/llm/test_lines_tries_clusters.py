"""Line dedup, prefix trie and centroids against brute force, with nulls, ties, repeats, long rows and clashing names."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from scrimspark.llm import centroids, line_dedup, prefix_trie

rng = np.random.default_rng(11)
SPACE = " \t\n\x0b\x0c\r"


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


# lines -------------------------------------------------------------------------------------------------------------


def plain_lines(rows, min_chars=20, min_docs=3):
    holders = defaultdict(set)
    key = lambda line: lower(line.strip(SPACE))
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(d)
    stays = {k: max(v, key=lambda d: (d is not None, d or 0)) for k, v in holders.items() if len(k) >= min_chars and len(v) >= min_docs}
    out = []
    for d, t in rows:
        parts = (t or "").split("\n")
        kept = [x for x in parts if stays.get(key(x), d) == d]
        out.append((d, len(parts), len(parts) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


LINES = ["The licence is this line, ÄÖÜ", "  THE LICENCE is this line, ÄÖÜ\t", "the licence is this line, äöü", "exactly twenty chars", "only nineteen chars", "", " ", " this line has hard spaces ", "this line is in two documents", "x" * 5000]


def line_rows():
    rows = [(None, LINES[0]), (None, LINES[0] + "\n" + LINES[3]), (1, None), (2, ""), (3, "\n\n"), (4, LINES[8]), (5, LINES[8]), (6, "\n".join(LINES)), (6, LINES[0] + "\r\n" + LINES[0]), (7, "\n".join(LINES * 300))]
    rows += [(7, LINES[3])] * 2 + [(int(10 + i), "\n".join(rng.choice(LINES, 8)) + f"\nand a line of its own, number {i}") for i in range(60)]
    return rows


@pytest.mark.parametrize("bits", [1 << 28, 1 << 16])
def test_lines(spark, bits):
    rows = line_rows()
    docs = spark.createDataFrame([(d, t, "clash", 1, "s") for d, t in rows], "doc_id long, text string, n_lines string, _text int, _sha string").repartition(7)
    out = line_dedup.drop_lines(docs, most_bits=bits)
    got = [(r.doc_id, r.n_lines, r.n_dropped, r.kept_text) for r in out.collect()]
    assert sorted(got, key=repr) == plain_lines(rows)
    assert out.columns == ["doc_id", "text", "_text", "_sha", "n_lines", "n_dropped", "kept_text"]


def test_lines_of_empty_table(spark):
    assert line_dedup.drop_lines(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@settings(max_examples=50, deadline=None)
@given(st.lists(st.lists(st.integers(0, 1 << 62), max_size=60, unique=True), min_size=1, max_size=6), st.randoms())
def test_merged_filters_miss_nothing(lists, random):
    """A hash that two documents have is in the merged second filter, however the documents are dealt and merged."""
    import pandas as pd

    bits = line_dedup.SEGMENT
    parts = []
    for tasks in (lists[:2], lists[2:4], lists[4:]):
        f = line_dedup.Filters(bits)
        for h in tasks:
            f.add(np.array(h, dtype=np.int64))
        parts += [{"once": a, "twice": b} for _, a, b in f.segments()]
    random.shuffle(parts)
    counts = defaultdict(int)
    for h in lists:
        for x in h:
            counts[x] += 1
    if parts:
        _, twice = line_dedup.merged_segment(pd.DataFrame(parts))
        again = np.array([h for h, n in counts.items() if n > 1], dtype=np.int64)
        assert line_dedup.has(twice, line_dedup.probes(again, bits)).all()


def test_filter_is_selective():
    """Of lines that occur once, few are taken for repeats: 16 bits and three probes for each."""
    f = line_dedup.Filters(1 << 20)
    h = rng.integers(0, 1 << 62, 1 << 16)
    for part in np.split(h, 16):
        f.add(part)
    assert line_dedup.has(f.twice, line_dedup.probes(h, f.bits)).mean() < 0.02 and line_dedup.has(f.once, line_dedup.probes(h, f.bits)).all()


# tries -------------------------------------------------------------------------------------------------------------


def plain_trie(conversations):
    """Nodes of {conv_id: [(role, text), ...]} (turns in order), rebuilt, by the contract's words."""
    members, ends, size = defaultdict(list), defaultdict(list), {}
    for c, own in conversations.items():
        h = zlib.crc32(str(c).encode()) % 9
        seq = tuple(conversations.get(c - c % 5, [])[:h] + own[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
            size[seq[:d]] = len(seq[d - 1][1].encode()) if d else 0
        ends[seq].append(c)
    out = []
    for p, convs in members.items():
        below = [q for q in members if q[: len(p)] == p]
        kids = [q for q in below if len(q) == len(p) + 1]
        leaves = [q for q in below if not any(len(r) == len(q) + 1 and r[: len(q)] == q for r in below)]
        saved = sum((len(members[q]) - 1) * size[q] for q in below)
        out.append((min(convs), len(p), min(members[p[:-1]]) if p else None, len(convs), len(kids), len(leaves), saved, hashlib.sha256(",".join(map(str, sorted(ends[p]))).encode()).hexdigest()))
    return sorted(out)


def talks():
    lines = [("user", "hi"), ("assistant", "hello"), ("user", "ü" * 9), ("system", ""), ("user", "hi ")]
    out = {}
    for c in range(90):
        kind = c % 3
        out[c] = [lines[0], lines[1]] * 3 if kind == 0 else [lines[0], *[lines[i] for i in rng.integers(0, 5, rng.integers(0, 6))]] if kind == 1 else [lines[i] for i in rng.integers(0, 5, rng.integers(1, 9))]
    out[203] = [lines[i % 5] for i in range(700)]  # its first conversation is absent
    out[206] = [lines[0]]
    for c in (20, 35, 71):
        del out[c]
    return out


@pytest.mark.parametrize("shard_turns", [30, 200, 1_000_000])
def test_trie(spark, shard_turns):
    conversations = talks()
    rows = [(c, i if i else None, r or None, t or None, "clash") for c, turns in conversations.items() for i, (r, t) in enumerate(turns)]
    rows += [(None, 0, "user", "nobody's", "x")]
    df = spark.createDataFrame([rows[i] for i in rng.permutation(len(rows))], "conv_id long, turn long, role string, text string, depth string").repartition(3)
    # a null turn comes first, so the order is the same
    got = sorted(tuple(r) for r in prefix_trie.conversation_trie(df, shard_turns).collect())
    assert got == plain_trie({c: t for c, t in conversations.items() if t})


def test_trie_of_no_conversation(spark):
    assert prefix_trie.conversation_trie(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).collect() == []


def test_repeated_turns_and_turnless(spark):
    """Turns that share a number are both there; a conversation that loses all of its turns ends at the root."""
    h = next(c for c in range(1, 99) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)
    rows = [(h, 0, "user", "a"), (h, 0, "user", "a"), (500, 1, "user", "b"), (500, 1, "user", "b")]
    got = {(r.depth, r.n_convs, r.n_leaves) for r in prefix_trie.conversation_trie(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()}
    assert got == {(0, 2, 1), (1, 1, 1), (2, 1, 1)}


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.just([]), lambda t: st.lists(t, max_size=6), max_leaves=60))
def test_findclose_equals_a_stack(tree):
    opens, close, waiting = [], {}, []

    def write(t):
        waiting.append(len(opens))
        opens.append(True)
        for c in t:
            write(c)
        close[waiting.pop()] = len(opens)
        opens.append(False)

    write(tree)
    old, prefix_trie.BLOCK = prefix_trie.BLOCK, 4
    try:
        brackets = prefix_trie.Parentheses(np.array(opens))
        for i, j in close.items():
            assert brackets.findclose(i) == j
            assert brackets.leaves(i, j) == sum(opens[k] and not opens[k + 1] for k in range(i, j))
    finally:
        prefix_trie.BLOCK = old


# centroids ---------------------------------------------------------------------------------------------------------


def plain_clusters(rows, k, rounds, dimensions):
    kept = [(i, [int(np.floor(1024 * float(x))) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and np.isfinite(x) for x in v)]
    start = sorted(kept, key=lambda r: (hashlib.sha256(f"3:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in start]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))  # noqa: B023, E731
    for _ in range(rounds):
        groups = defaultdict(list)
        for _, v in kept:
            groups[assign(v)[1]].append(v)
        c = [[sum(x) // len(groups[j]) for x in zip(*groups[j])] if groups[j] else m for j, m in enumerate(c)]
    done = [(i, *assign(v)[::-1]) for i, v in kept]
    return sorted(((i, j, d, sum(e for _, b, e in done if b == j), sum(e for _, _, e in done), hashlib.sha256(",".join(map(str, c[j])).encode()).hexdigest()) for i, j, d in done), key=repr)


def vectors():
    rows = [(i, [float(x) for x in rng.normal(i % 5, 0.4 + i % 2, 6)]) for i in range(300)]
    rows += [(400, None), (401, []), (402, [1.0] * 5), (403, [1.0] * 7), (404, [None, *[1.0] * 5]), (405, [float("nan"), *[1.0] * 5]), (406, [float("inf")] * 6)]
    rows += [(500 + i, [0.25, -0.25, 0.5, 0.0, -0.0, 1.0]) for i in range(200)] + [(7, [0.5] * 6), (7, [0.25] * 6), (None, [-3.0] * 6), (None, [-3.0] * 6), (800, [100000.0] * 6)]
    return rows


@pytest.mark.parametrize("leading", [1, 3, 6])
def test_clusters(spark, leading):
    rows = vectors()
    df = spark.createDataFrame([(i, v, "clash", 5) for i, v in rows], "vec_id long, embedding array<double>, cluster string, _q int").repartition(5)
    out = centroids.cluster_vectors(df, 4, 6, 6, leading=leading)
    assert out.columns == ["vec_id", "_q", *centroids.OUTPUT]
    assert sorted((tuple(r) for r in out.drop("_q").collect()), key=repr) == plain_clusters(rows, 4, 6, 6)


@pytest.mark.parametrize("n", [0, 1, 3])
def test_few_vectors(spark, n):
    rows = [(i, [float(i)] * 6) for i in range(n)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert sorted((tuple(r) for r in centroids.cluster_vectors(df, 8, 2, 6).collect()), key=repr) == plain_clusters(rows, 8, 2, 6)


def test_too_large(spark):
    df = spark.createDataFrame([(1, [200000.0] * 6)], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="a component of"):
        centroids.cluster_vectors(df, 8, 2, 6).collect()


@settings(max_examples=100, deadline=None)
@given(st.integers(0, 1 << 30), st.integers(1, 63))
def test_filtering_measures_less_and_changes_nothing(seed, leading):
    r = np.random.default_rng(seed)
    middle = r.integers(-900, 900, (8, 64))
    q = (middle[r.integers(0, 8, 200)] + r.integers(-60, 60, (200, 64))).astype(np.int64)
    q[:20] = (middle[0] + middle[1]) // 2  # near ties
    c = np.concatenate([middle[:7], middle[:1]]).astype(np.int64)  # a centroid twice
    mean, directions = q.mean(axis=0), np.linalg.qr(r.normal(size=(64, 64)))[0]
    best, least, looked = centroids.nearest(q, centroids.rotated(q, mean, directions, leading), c, centroids.rotated(c, mean, directions, leading))
    d = ((q[:, None, :] - c[None]) ** 2).sum(axis=2)
    assert (best == d.argmin(axis=1)).all() and (least == d.min(axis=1)).all() and looked <= d.size

"""Operators over whole tables: against brute force on small ones."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from scrimspark.llm import components, exact_dedup, mixing, ngram_join, quality, substring_dedup

rng = np.random.default_rng(3)
WORDS = ["".join(rng.choice(list("abcdefghijklmnop"), rng.integers(2, 8))) for _ in range(800)]


def prose(n):
    return " ".join(rng.choice(WORDS, n))


def edited(text, n):
    words = text.split(" ")
    for i in rng.choice(len(words), n, replace=False):
        words[i] = "edit" + str(rng.integers(1 << 30))
    return " ".join(words)


def corpus():
    base, long, hot = [prose(int(n)) for n in rng.integers(5, 400, 40)], prose(4000), prose(120)
    passage = prose(60)
    texts = [None, "", " \n", "one", "One", "one two three", "one two three", "é" * 120, "é" * 120, *base, *base[:10], *base[:3], long, long + " end"]
    texts += [edited(b, max(1, int(len(b.split(" ")) * share))) for b in base[:12] if len(b.split(" ")) > 30 for share in (0.01, 0.03, 0.05)]
    texts += [edited(hot, 2) for _ in range(40)] + [prose(20) + " " + passage + " " + prose(20) for _ in range(15)] + ["ab" * 400, "x" * 300]
    return texts


TEXTS = corpus()


@pytest.fixture(scope="module")
def docs(spark):
    order = rng.permutation(len(TEXTS))
    rows = [(int(i), TEXTS[i], "clash", "s") for i in order]
    return spark.createDataFrame(rows, "doc_id long, text string, kept string, source string").repartition(5)


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(docs, bits):
    rows = exact_dedup.exact_groups(docs, bits).collect()
    groups = defaultdict(list)
    for i, t in enumerate(TEXTS):
        groups[t or ""].append(i)
    assert len(rows) == len(TEXTS)
    for r in rows:
        g = groups[TEXTS[r.doc_id] or ""]
        assert (r.keep_id, r.group_size, r.kept) == (max(g), len(g), r.doc_id == max(g))
        assert r.text_sha256 == hashlib.sha256((TEXTS[r.doc_id] or "").encode()).hexdigest()
    stay = exact_dedup.drop_copies(docs, bits)
    assert stay.columns == docs.columns and {r.doc_id for r in stay.collect()} == {max(g) for g in groups.values()}


def test_exact_groups_of_odd_rows(spark):
    rows = spark.createDataFrame([(1, "a"), (1, "a"), (None, "a"), (None, "b"), (2, None), (3, "")], "doc_id long, text string")
    got = exact_dedup.exact_groups(rows).collect()
    assert sum(r.kept for r in got) == 3 and sorted((r.keep_id or 0, r.group_size) for r in got) == [(0, 1), (1, 3), (1, 3), (1, 3), (3, 2), (3, 2)]
    assert exact_dedup.drop_copies(rows).count() == 3
    assert exact_dedup.exact_groups(rows.limit(0)).count() == 0


def test_chunks_cover_the_text(spark):
    texts = [t for t in TEXTS if t] + ["z" * 10_000, "😀" * 5000, "a.\nB" * 3000]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    out = df.select("text", F.regexp_extract_all("text", F.lit(exact_dedup.CHUNK), F.lit(0)).alias("c")).collect()
    assert all("".join(r.c) == r.text and max(map(len, r.c)) <= 4096 for r in out)


def brute_links(width, percent):
    sets = {}
    for i, t in enumerate(TEXTS):
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets[i] = {tuple(w[k : k + width]) for k in range(len(w) - width + 1)} or ({tuple(w)} if w else set())
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in sets:
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (len(s), find(i)) for i, s in sets.items()}


@pytest.mark.parametrize(("width", "percent", "block"), [(4, 85, 2048), (5, 80, 4)])
def test_similar_groups(docs, width, percent, block):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs, percent, width, block).collect()}
    assert got == brute_links(width, percent)


@pytest.mark.parametrize("most", [1, 500, 1 << 20])
def test_similar_groups_in_small_blocks(docs, most):
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.similar_groups(docs, 85, 4, 3, most).collect()}
    assert got == brute_links(4, 85)


def test_rows_that_share_a_doc_id_are_documents_of_their_own(spark):
    one, other = prose(60), prose(60)
    rows = spark.createDataFrame([(1, one), (5, one), (5, other), (9, other), (None, other), (None, one + " end"), (5, other), (3, ""), (3, "")], "doc_id long, text string")
    got = sorted((r.doc_id or 0, r.n_shingles, r.component_id or 0) for r in ngram_join.similar_groups(rows).collect())
    assert got == [(0, 57, 0), (0, 58, 0), (1, 57, 1), (3, 0, 3), (3, 0, 3), (5, 57, 1), (5, 57, 5), (5, 57, 5), (9, 57, 5)]
    assert sorted((r.doc_id, r.text) for r in ngram_join.first_of_each(rows).collect()) == sorted([(1, one), (5, other), (3, "")])


def test_a_large_group_of_near_copies(spark):
    """Copies that link with some of each other only: every component is found."""
    hot = prose(100).split(" ")
    texts = []
    for _ in range(400):
        words = list(hot)
        for i in rng.choice(100, int(rng.integers(1, 6)), replace=False):
            words[i] = "edit" + str(rng.integers(1 << 30))
        texts.append(" ".join(words))
    sets = [{tuple(w[k : k + 4]) for k in range(len(w) - 3)} for w in (t.split(" ") for t in texts)]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if 100 * both >= 85 * (len(sets[a]) + len(sets[b]) - both) and find(a) != find(b):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in ngram_join.similar_groups(df).collect()}
    assert got == {i: find(i) for i in range(len(texts))}


def test_first_of_each(spark, docs):
    want = {c for _, c in brute_links(5, 80).values()}
    rows = ngram_join.first_of_each(docs)
    assert rows.columns == docs.columns and {r.doc_id for r in rows.collect()} == want
    odd = spark.createDataFrame([(None, "a b c d e f"), (7, "a b c d e f"), (7, "a b c d e f")], "doc_id long, text string")
    assert {r.component_id for r in ngram_join.similar_groups(odd).collect()} == {None, 7}
    assert ngram_join.similar_groups(odd.limit(0)).count() == 0


@pytest.mark.parametrize("percent", [80, 85, 95])
def test_plan_bounds(percent):
    """Sets that link share as many entries as promised, and their bitmaps differ no more than they."""
    plan = ngram_join.Plan(percent)
    for n in [*range(plan.least, 60), 100, 333, 1000]:
        most = plan.differ(n)
        pool = rng.integers(0, 1 << 63, n + 2 * most + 2, dtype=np.uint64)
        for drop in {0, most // 2, most}:
            a, b = np.unique(pool[:n]), np.unique(np.concatenate([pool[drop : n], pool[n : n + most - drop]]))
            both = len(np.intersect1d(a, b))
            if len(b) < plan.least or 100 * both < percent * (len(a) + len(b) - both):
                continue
            (ea, na), (eb, nb) = plan.entries(a), plan.entries(b)
            assert len(np.intersect1d(ea, eb)) >= (na if len(a) <= len(b) else nb)
            size = min(plan.bits(len(a)), plan.bits(len(b)))
            x, y = (ngram_join.parity(s, size).view(np.uint64) for s in (a, b))
            assert np.bitwise_count(x ^ y).sum() <= len(a) + len(b) - 2 * both


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (101, 102), (102, 100), (200, 200)] + [(300, i) for i in range(301, 340)]
    got = {r.node: r.label for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100, 200: 200} | {i: 300 for i in range(300, 340)}
    assert components.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_small_tables_are_few_files(spark):
    """The number of shuffle partitions doesn't matter, also where adaptive execution doesn't coalesce them."""
    names = {"spark.sql.shuffle.partitions": "40", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in names}
    try:
        for k, v in names.items():
            spark.conf.set(k, v)
        labels = components.components(spark.range(400).selectExpr("id AS a", "id + 1 - id % 2 AS b"))
        assert {r.node: r.label for r in labels.collect()} == {i: i - i % 2 for i in range(400)}
        assert len(labels.inputFiles()) == 1
        rows = spark.range(900).selectExpr("concat('g', id % 6) AS _q_group", *[f"(id * {7 + 2 * i}) % 31 AS _q_y{i}" for i in range(5)], "1L AS _q_n")
        best = quality.least_determinant(rows.cache())
        assert best.count() == 6 and len(best.inputFiles()) == 1
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def brute_repeats(texts, length):
    seen, out = set(), {}
    for i, t in enumerate(texts):
        data = (t or "").encode()
        gone = bytearray(len(data))
        for k in range(len(data) - length + 1):
            window = data[k : k + length]
            if window in seen:
                gone[k : k + length] = b"\1" * length
            seen.add(window)
        out[i] = [(m.start(), m.end()) for m in re.finditer(b"\1+", bytes(gone))]
    return out


@pytest.mark.parametrize("many", [512, 1])
def test_repeated_substrings(docs, many):
    want = brute_repeats(TEXTS, 100)
    rows = substring_dedup.without_repeats(docs, 100, many).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        data = (TEXTS[r.doc_id] or "").encode()
        assert [(x.start, x.end) for x in r.removed] == want[r.doc_id]
        at, left = 0, b""
        for s, e in want[r.doc_id]:
            left, at = left + data[at:s], e
        assert bytes(r.kept) == left + data[at:] and r.n_bytes == len(data) and r.source == "s"


def test_repeats_of_odd_rows(spark):
    text = prose(60)
    rows = spark.createDataFrame([(1, text), (1, text), (None, None), (2, "short")], "doc_id long, text string")
    assert all(len(r.removed) == 0 for r in substring_dedup.without_repeats(rows).collect())  # rows of one document
    assert substring_dedup.without_repeats(rows.limit(0)).count() == 0
    null = spark.createDataFrame([(None, text), (1, text)], "doc_id long, text string")
    assert {r.doc_id: len(r.removed) for r in substring_dedup.without_repeats(null).collect()} == {None: 0, 1: 1}


@pytest.mark.parametrize("many", [512, 1])
@pytest.mark.parametrize("key", [None, 7])
def test_repeats_in_texts_that_share_a_doc_id(spark, key, many):
    """Texts of one doc_id, or of none, are documents of their own: spans never reach into another text."""
    shared, words = prose(40), [f"w{i}x{i * i}" for i in range(400)]
    tails = [" ".join(words[i * 100 : i * 100 + 60]) for i in range(4)]
    texts = [shared + tails[0], shared + tails[1], tails[2] + "; " + shared, tails[3], None, "short"]
    rows = spark.createDataFrame([(key, t) for t in texts] + [(9, texts[0])], "doc_id long, text string")
    got = substring_dedup.without_repeats(rows, 100, many).collect()
    assert len(got) == len(texts) + 1
    left = [bytes(r.kept).decode() for r in got if r.doc_id == key]
    assert sum(shared in t for t in left) == 1
    assert all(sum(tail[5:] in t for t in left) == 1 for tail in tails)
    assert [bytes(r.kept) for r in got if r.doc_id == 9] == [b""]


def test_slabs_of_long_texts(monkeypatch):
    monkeypatch.setattr(substring_dedup, "SLAB", 500)
    text = prose(700).encode()
    texts = [text[:90], text, b"", text[:700]]
    windows = Counter()
    for i, start, n, _, _ in (row for part in substring_dedup.slabs(texts, 100) for row in zip(*part, strict=True)):
        windows.update((int(i), int(start) + k) for k in range(int(n)))
    assert windows == Counter({(i, k): 1 for i, t in enumerate(texts) for k in range(len(t) - 99)})


def test_shared_prefixes_equal_brute_force():
    for _ in range(30):
        texts = [bytes(rng.choice([97, 98], rng.integers(1, 60)).astype(np.uint8)) for _ in range(4)]
        order, shared = substring_dedup.shared_prefixes(texts, 5)
        joined, starts = [], []
        for k, t in enumerate(texts):
            joined += [*t, 256 + k]
        starts = sorted(range(len(joined)), key=lambda i: joined[i:])
        assert list(order) == starts
        assert list(shared) == [i > 0 and len(joined) - max(starts[i], starts[i - 1]) >= 5 and joined[starts[i] : starts[i] + 5] == joined[starts[i - 1] : starts[i - 1] + 5] and max(joined[starts[i] : starts[i] + 5]) < 256 for i in range(len(starts))]


def mixed_rows(spark):
    sources = ["a", "b", None, "é", "tiny", "none"]
    rows = [(i, sources[i % 4], prose(int(n))) for i, n in enumerate(rng.integers(1, 900, 300))] + [(1000, "tiny", prose(3)), (1001, "none", ""), (1002, "none", None)]
    return spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("size", F.lit("clash"))


def test_mix(spark):
    docs = mixed_rows(spark).cache()
    rows = mixing.mix_sources(docs, shard_words=5000).collect()
    assert len(rows) == docs.count()
    by = defaultdict(lambda: [0, 0, 0.0])
    for r in rows:
        assert 0 <= r.taken <= 2 * r.size and r.size == len((next(iter([r.text])) or "").split())
        by[r.source][0] += r.size
        by[r.source][1] += r.taken
        by[r.source][2] = r.target
    total = sum(x[0] for x in by.values())
    names = sorted((s for s in by if s is not None), key=lambda s: s.encode()) + [None]
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)}
    target, left, open_ = {}, 1.5 * total, set(names)
    while True:  # share by weight; what is above its cap stops there and the rest is shared again
        unit = left / sum(weight[s] for s in open_)
        over = {s for s in open_ if weight[s] * unit > 2 * by[s][0]}
        if not over:
            break
        for s in over:
            target[s] = 2.0 * by[s][0]
        left = 1.5 * total - sum(target.values())
        open_ -= over
    target |= {s: weight[s] * unit for s in open_}
    for s, (size, taken, t) in by.items():
        assert abs(t - target[s]) <= 1e-6 * max(1, target[s])
        assert abs(taken - t) <= max(0.03 * t, 130)
    again = {(r.doc_id, r.taken) for r in mixing.mix_sources(docs.repartition(9), shard_words=5000).collect()}
    assert again == {(r.doc_id, r.taken) for r in rows}
    assert mixing.mix_sources(docs.limit(0)).count() == 0


def test_mixed_texts_have_the_words_taken(spark):
    mixed = mixing.mix_sources(mixed_rows(spark)).cache()
    texts = mixing.mixed_documents(mixed, ["doc_id", "text"]).groupBy("doc_id").agg(F.sum(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+"))).alias("n"))
    got = {r.doc_id: r.n for r in texts.collect()}
    assert got == {r.doc_id: r.taken for r in mixed.where("taken > 0").collect()}


def test_parts_keep_line_breaks_and_clashing_names_pass(spark):
    text = "\n".join(prose(7) for _ in range(80))
    rows = spark.createDataFrame([(i, "s" if i < 9 else "t", text.replace(" ", f" {i}"), i) for i in range(10)], "doc_id long, source string, text string, rank long").withColumns({c: F.lit("x") for c in ("_shard", "_quota", "_start", "weight", "_mix")})
    mixed = mixing.mix_sources(rows)
    assert mixed.columns == [*rows.columns, *mixing.OUTPUT] and {r["rank"] for r in mixed.collect()} == set(range(10))
    want = []
    for r in mixed.collect():
        spaced = re.findall(r"[^\x20\x09-\x0D]+[\x20\x09-\x0D]*", r.text)
        part = "".join("".join(spaced[x.first : x.end]) for x in r.ranges)
        want += [(r.doc_id, r.text)] * r.copies + [(r.doc_id, part)] * (part != "")
    assert sorted(want) == sorted(tuple(r) for r in mixing.mixed_documents(mixed, ["doc_id", "text"]).collect())
    assert any(t.count("\n") > 3 and t != text for _, t in want)
    other = {r.doc_id: r.taken for r in mixing.mix_sources(rows, seed="other").collect()}
    assert other != {r.doc_id: r.taken for r in mixed.collect()}


def test_sainte_lague_equals_the_highest_quotients(spark):
    for seats in (0, 1, 7, 100, 1001):
        votes = [0.0, 1.0, 3.0, 3.0, 10.5, 250.0, 999.0]
        df = spark.createDataFrame([(1, i, v, seats) for i, v in enumerate(votes)], "g int, k int, v double, seats long")
        got = [r.n for r in mixing.sainte_lague(df, ["g"], "v", "seats", ["k"], "n").orderBy("k").collect()]
        quotients = sorted(((-v / (2 * j + 1), i) for i, v in enumerate(votes) if v for j in range(seats)))[:seats]
        assert got == [sum(q[1] == i for q in quotients) for i in range(len(votes))]


def test_mix_agrees_between_reruns(spark):
    """Null and repeated doc_ids, equal sizes: in any partitioning the same texts are taken, and no shard gets them all."""
    rows = [(None if i % 3 else 7, f"w{i} " * 90, "a" if i % 2 else None, i % 5) for i in range(60)] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, extra long")
    got = []
    for n in (1, 3, 8):
        shuffled = docs.orderBy(F.xxhash64("text", F.lit(n))).repartition(n)
        out = mixing.mix_sources(shuffled, block_words=8, shard_words=500)
        got.append(sorted(repr(tuple(r)) for r in out.select("doc_id", "text", "extra", "taken", "copies", "ranges").collect()))
    assert got[0] == got[1] == got[2] and len(got[0]) == 120
    shards = docs.select(F.conv(F.substring(mixing._digest("mix"), 1, 8), 16, 10).cast("long") % 8).distinct().count()
    assert shards == 8


def test_columns_named_like_internal_ones_are_kept(spark):
    """In every operator that returns the caller's rows; a null doc_id and a very long text among them."""
    names = ("id", "spans", "_sub", "_key", "_sha", "_doc", "_row", "_ngram_key", "kinds", "_in0", "bytes", "label", "entry")
    long = " ".join(f"w{i}" for i in range(60_000))
    rows = [(1, long), (2, long), (None, "a short text of its own"), (None, None)]
    docs = spark.createDataFrame([(*r, *[f"{n} of {i}" for n in names]) for i, r in enumerate(rows)], ", ".join(["doc_id long", "text string", *[f"`{n}` string" for n in names]]))
    for out, stay in ((exact_dedup.drop_copies(docs), {1, 2, 3}), (ngram_join.first_of_each(docs), {0, 2, 3}), (substring_dedup.without_repeats(docs), {0, 1, 2, 3})):
        assert set(docs.columns) - {"text"} <= set(out.columns)
        got = out.collect()
        assert {r.id for r in got} == {f"id of {i}" for i in stay}
        assert all(r[n] == f"{n} of {r.id[-1]}" for r in got for n in names)

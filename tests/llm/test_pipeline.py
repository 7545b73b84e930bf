"""The pipeline against a brute-force version, and the registered queries against their SQL and contracts."""

from __future__ import annotations

import hashlib
import re

import duckdb
import numpy as np
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from scrimspark.llm import byte_bpe, mixing, quality, queries

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    got = queries.QUERIES[name](spark, SMALL)
    columns = sorted(got.columns)
    rel = duck.sql(queries.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    assert sorted(tuple(r[c] for c in columns) for r in got.collect()) == sorted(tuple(dict(zip(rel.columns, r, strict=True))[c] for c in columns) for r in rel.fetchall())


def test_all_operators_are_registered():
    names = entry.queries()
    assert "pipeline" in names and {n.split("_")[0] for n in names if re.match(r"op\d", n)} == {f"op{i}" for i in range(1, 14)}


def test_stages_keep_the_columns(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name


def test_pipeline_equals_brute_force(spark, texts):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    kept = {r.doc_id for r in quality.quality_report(docs).where("kept").collect()}
    last = {}
    for i in sorted(kept):
        last[texts[i]] = i
    ids = sorted(last.values())
    sets = {}
    for i in ids:
        w = re.findall(rb"[^\x20\x09-\x0D]+", texts[i].encode().lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} or {tuple(w)}
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(ids):
        for b in ids[:n]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= 80 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    firsts = {i for i in ids if find(i) == i}
    stay = docs.where(docs.doc_id.isin(*firsts))
    bpe = byte_bpe.encoder(byte_bpe.vocabulary_path())
    want = []
    for r in mixing.mixed_documents(mixing.mix_sources(stay), ["doc_id", "text"]).collect():
        want.append((r.doc_id, hashlib.sha256(np.asarray(bpe.encode_ordinary(r.text), dtype="<u4").tobytes()).hexdigest(), hashlib.sha256(r.text.encode()).hexdigest()))
    got = [(r.doc_id, r.ids_sha256, r.decoded_sha256) for r in corpus_pipeline.run(spark, SMALL).collect()]
    assert sorted(got) == sorted(want)

"""Every registered query of the match library agrees with its SQL on the smallest tables."""

from __future__ import annotations

import math
from datetime import datetime

import duckdb
import pytest

import __spark_entry__ as entry
from scrimspark import catalog
from scrimspark.plans.adapters import TABLES

SMALL = "/root/testdata/sf0.001"


def plain(x):
    if isinstance(x, float):
        return ("float", "nan") if math.isnan(x) else ("float", round(x, 9))
    return x.replace(tzinfo=None) if isinstance(x, datetime) else x


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SMALL}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SMALL)
    columns = sorted(df.columns)
    got = sorted((repr(tuple(plain(r[c]) for c in columns)) for r in df.collect()))
    rel = duck.sql(catalog.ORACLE_SQL[name])
    assert sorted(rel.columns) == columns
    exp = sorted(repr(tuple(plain(dict(zip(rel.columns, r, strict=True))[c]) for c in columns)) for r in rel.fetchall())
    assert got == exp


def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

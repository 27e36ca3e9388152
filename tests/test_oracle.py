"""Each query against its SQL in DuckDB."""

from __future__ import annotations

import math

import duckdb
import pytest
from pairloom.plans import catalog

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def plain(value):
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    return str(float(value)) if isinstance(value, (int, float)) and not isinstance(value, bool) else str(value)


def rows(columns, found):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return [columns[k] for k in order], sorted(tuple(plain(r[k]) for k in order) for r in found)


@pytest.mark.parametrize("name", sorted(catalog.ORACLE))
def test_equals_sql(spark, duck, name):
    df = catalog.QUERIES[name](spark, SF)
    want = duck.execute(catalog.ORACLE[name])
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows([c[0] for c in want.description], want.fetchall())


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.ORACLE)))
def test_runs_and_repeats(spark, name):
    """Random operators give the same rows however the input is partitioned."""
    a, b = (sorted(map(str, catalog.QUERIES[name](spark, SF).collect())) for _ in range(2))
    assert a and a == b

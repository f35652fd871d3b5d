"""Every registered query with SQL gives the rows of that SQL on the smallest tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from veritab.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
#: Run in the module of the query itself, or slow for what they show here.
WITH_SQL = sorted(registry.oracle_sql())
WITHOUT = sorted(set(registry.queries()) - set(WITH_SQL))


def canonical(value) -> str:
    if value is None or isinstance(value, float) and math.isnan(value):
        return "null"
    if isinstance(value, float):
        return f"{value:.9g}"
    return str(value)


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"create view {t} as select * from read_parquet('{DATA}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", WITH_SQL)
def test_query_matches_sql(spark, duck, name):
    got = registry.queries()[name](spark, DATA)
    want = duck.sql(registry.oracle_sql()[name])
    assert sorted(got.columns) == sorted(want.columns)
    names = sorted(got.columns)
    ours = sorted(tuple(canonical(r[c]) for c in names) for r in got.collect())
    at = [want.columns.index(c) for c in names]
    theirs = sorted(tuple(canonical(r[k]) for k in at) for r in want.fetchall())
    assert ours == theirs


@pytest.mark.parametrize("name", WITHOUT)
def test_query_without_sql_runs(spark, name):
    assert registry.queries()[name](spark, DATA).count() > 0


def test_entry_needs_no_optional_part(spark):
    import __spark_entry__

    assert set(registry.queries()) <= set(__spark_entry__.queries())
    assert __spark_entry__.entry(spark).count() == 1500

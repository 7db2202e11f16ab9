"""Every registered query that has SQL, against that SQL in DuckDB, on the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    held = duckdb.connect()
    for t in TABLES:
        held.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return held


def plain(value):
    return None if isinstance(value, float) and math.isnan(value) else value


@pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")
@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_its_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted((tuple(plain(r[c]) for c in columns) for r in df.collect()), key=str)
    want = duck.sql(entry.oracle_sql()[name])
    assert sorted(want.columns) == columns
    places = [want.columns.index(c) for c in columns]
    assert got == sorted((tuple(plain(r[p]) for p in places) for r in want.fetchall()), key=str)


def test_entry(spark):
    assert len(entry.entry(spark).columns) == 113
    assert set(entry.oracle_sql()) <= set(entry.queries())

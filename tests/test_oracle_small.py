"""Every registered query against its DuckDB oracle on the smallest scale."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
KEYS = [k for k in entry.queries() if k in entry.oracle_sql()]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in sorted(f.removesuffix(".parquet") for f in os.listdir(SF) if f.endswith(".parquet")):
        c.execute(f"create view {t} as select * from read_parquet('{os.path.join(SF, t)}.parquet')")
    return c


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


@pytest.mark.parametrize("key", KEYS)
def test_query_matches_oracle(spark, con, key):
    df = entry.queries()[key](spark, SF)
    rel = con.sql(entry.oracle_sql()[key])
    assert sorted(df.columns) == sorted(rel.columns)
    order = [rel.columns.index(c) for c in df.columns]
    got = sorted((tuple(norm(x) for x in r) for r in df.collect()), key=repr)
    want = sorted((tuple(norm(r[i]) for i in order) for r in rel.fetchall()), key=repr)
    assert got == want

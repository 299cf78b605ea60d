"""Every registered query against its SQL, over the smallest tables."""

import math
import os

import duckdb
import pytest

import __spark_entry__  # noqa: F401  registers all queries
from factline.plans import registry

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def plain(x):
    if hasattr(x, "tolist") and not isinstance(x, (str, bytes)):
        x = x.tolist()
    if isinstance(x, float):
        return None if math.isnan(x) else round(x, 6)
    if isinstance(x, (list, tuple)):
        return tuple(map(plain, x))
    return x


def rows(columns, data):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return sorted(repr([plain(r[i]) for i in order]) for r in data)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")
@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_query_gives_what_its_sql_gives(spark, duck, name):
    got = registry.QUERIES[name](spark, DATA)
    want = duck.sql(registry.ORACLE_SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got.columns, [tuple(r) for r in got.collect()]) == rows(want.columns, want.fetchall())

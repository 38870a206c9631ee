"""Every query with SQL beside it against DuckDB on the smallest tables."""

import os

import duckdb
import pandas as pd
import pytest

from reelmill.plans.queries import QUERIES, SQL

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS FROM '{SF}/{t}.parquet'")
    return c


def text(df: pd.DataFrame) -> list[tuple]:
    def one(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and v != v) or v is pd.NA:
            return "NULL"
        return repr(float(v)) if isinstance(v, float) else str(v)

    return sorted(tuple(one(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_same_as_sql(spark, duck, name):
    got, want = QUERIES[name](spark, SF).toPandas(), duck.sql(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert text(got) == text(want)


def test_every_query_runs(spark):
    for name in sorted(set(QUERIES) - set(SQL)):
        assert QUERIES[name](spark, SF).count() > 0

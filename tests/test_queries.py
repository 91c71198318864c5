"""Every kernel query against its SQL, on the smallest tables."""

import duckdb
import numpy as np
import pandas as pd
import pytest

import __spark_entry__
from shardloom.queries import QUERIES, SQL

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return c


def canonical(df: pd.DataFrame) -> list:
    def plain(v):
        if v is None or v is pd.NaT or (isinstance(v, float) and np.isnan(v)):
            return ""
        if isinstance(v, (bool, np.bool_)):
            return str(bool(v))
        return repr(round(float(v), 6)) if isinstance(v, (int, float, np.integer, np.floating)) else str(v)

    return sorted(tuple(plain(v) for v in row) for row in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, duck, name):
    ours, theirs = QUERIES[name](spark, DATA).toPandas(), duck.execute(SQL[name]).df()
    assert sorted(ours.columns) == sorted(theirs.columns)
    assert canonical(ours) == canonical(theirs)


def test_every_kernel_has_sql():
    assert set(QUERIES) == set(SQL)


def test_entry_gives_a_row(spark):
    assert __spark_entry__.entry(spark).count() == 1

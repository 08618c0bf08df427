"""Every query with an oracle, held against it on the smallest tables."""

from __future__ import annotations

import os

import duckdb
import pandas as pd
import pytest

from tidewell.queries import ORACLE, QUERIES

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    con = duckdb.connect()
    for f in os.listdir(DATA):
        con.sql(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{DATA}/{f}'")
    return con


def frame(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    return sorted(tuple("null" if pd.isna(v) else str(v) for v in r) for r in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, oracle, name):
    got = QUERIES[name](spark, DATA)
    if name not in ORACLE:
        assert got.count() > 0
        return
    want = oracle.sql(ORACLE[name]).df()
    got = got.toPandas()
    assert sorted(got.columns) == sorted(want.columns)
    assert frame(got) == frame(want)

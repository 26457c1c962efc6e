"""Every registered query that has SQL gives the same rows as DuckDB on the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def duck(smallest):
    con = duckdb.connect()
    for f in glob.glob(f"{smallest}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return con


def rows(df: pd.DataFrame) -> list:
    df = df[sorted(df.columns)].astype(object)
    return sorted(map(repr, df.where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, smallest, duck, name):
    got, want = QUERIES[name](spark, smallest).toPandas(), duck.execute(ORACLES[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_keys_match():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["p_brand", "p_partkey", "evidence", "quality", "quadrant", "rank"] and df.count() > 0


def test_filters_and_columns_reach_the_scan(spark, smallest):
    plan = lambda name: QUERIES[name](spark, smallest)._jdf.queryExecution().toString()
    p = plan("region_filter")
    assert "EqualTo(event_type,click)" in p and "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,event_type:string>" in p
    assert "WindowGroupLimit" in plan("topn_per_group")
    assert "LeftSemi" in plan("facet_same_row")
    assert "TakeOrderedAndProject" in plan("cosine_topk")
    assert "CartesianProduct" not in plan("pair_overlap") and "BroadcastNestedLoopJoin" not in plan("pair_overlap")

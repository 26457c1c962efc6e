"""Merged sketches within their stated errors, and shards that come and change."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import sketches


@pytest.fixture(scope="module")
def data(spark):
    return spark.range(60_000).select((F.col("id") % 7).alias("shard"), (F.col("id") % 2).alias("half"), (F.col("id") * 7919 % 20_011).alias("key"), F.when(F.col("id") % 10 != 0, F.pow(F.col("id") / 1000, 2)).alias("x"))


def test_within_the_stated_errors(data):
    stored = sketches.by_shard(data, ["shard", "half"], ["key"], ["x"])
    r = sketches.merged(stored, quantiles=(0.1, 0.5, 0.9)).first()
    exact = data.agg(F.count("*"), F.countDistinct("key"), F.avg("x"), F.min("x"), F.max("x"), F.percentile("x", F.array(F.lit(0.1), F.lit(0.5), F.lit(0.9)))).first()
    assert (r["n"], r["n_key"]) == (60_000, 60_000) and abs(r["distinct_key"] - exact[1]) < 0.025 * exact[1]
    assert r["mean_x"] == pytest.approx(exact[2]) and (r["min_x"], r["max_x"]) == (exact[3], exact[4])
    at = sketches.ranks(stored, "x", [float(q) for q in exact[5]]).first()["rank"]
    assert at == pytest.approx([0.1, 0.5, 0.9], abs=0.02) and len(r["quantiles_x"]) == 3
    by = {s["half"]: s["n"] for s in sketches.merged(stored, ["half"]).collect()}
    assert by == {0: 30_000, 1: 30_000}


def test_shards_are_replaced(spark, data, tmp_path):
    stored = sketches.by_shard(data, ["shard"], ["key"], ["x"])
    stored.write.parquet(f"{tmp_path}/s")
    changed = sketches.by_shard(data.where("shard = 3").limit(10), ["shard"], ["key"], ["x"])
    more = sketches.by_shard(spark.range(5).select(F.lit(99).cast("long").alias("shard"), F.lit(1).alias("key"), F.lit(None).cast("double").alias("x")), ["shard"], ["key"], ["x"])
    now = sketches.replaced(spark.read.parquet(f"{tmp_path}/s"), changed.unionByName(more), ["shard"])
    r = {s["shard"]: s for s in sketches.merged(now, ["shard"]).collect()}
    assert len(r) == 8 and r[3]["n"] == 10 and r[99]["n"] == 5 and r[99]["distinct_key"] == 1 and r[99]["quantiles_x"] is None and r[99]["mean_x"] is None
    assert sketches.merged(now).first()["n"] == 60_000 - data.where("shard = 3").count() + 15


def test_no_rows(spark):
    none = spark.createDataFrame([], "shard long, key long, x double")
    r = sketches.merged(sketches.by_shard(none, ["shard"], ["key"], ["x"])).first()
    assert r["n"] is None and r["distinct_key"] == 0 and r["quantiles_x"] is None

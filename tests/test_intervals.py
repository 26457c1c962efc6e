"""Joins of intervals whose lengths differ by many orders."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import intervals


@pytest.fixture(scope="module")
def sides(spark):
    rng = random.Random(4)

    def make(n: int, tag: str) -> list[tuple]:
        out = []
        for k in range(n):
            start = rng.choice([rng.randrange(-500, 500), rng.randrange(10**6), rng.randrange(-(10**12), 10**12)])
            out.append((f"{tag}{k}", rng.choice("xyz"), start, start + rng.choice([0, 0, 1, 2, 3, 7, 8, 9, 1000, 10**6, 10**12])))
        return [*out, (f"{tag}all", "x", -(2**60), 2**60), (f"{tag}back", "x", 10, 9), (f"{tag}null", None, 1, 2), (f"{tag}open", "x", None, 2)]

    return make(400, "a"), make(300, "b")


def test_same_pairs_as_a_nested_loop(spark, sides):
    a, b = sides
    want = sorted((i, j) for i, g, s, e in a for j, h, t, f in b if g and g == h and None not in (s, t) and s <= e and t <= f and e >= t and s <= f)
    da, db = spark.createDataFrame(a, "i string, g string, s long, e long"), spark.createDataFrame(b, "j string, h string, t long, f long")
    got = intervals.overlap_join(da, db, ("g", "s", "e"), ("h", "t", "f"), width="levels")
    assert got.columns == ["i", "g", "s", "e", "j", "h", "t", "f"]
    assert sorted((r["i"], r["j"]) for r in got.collect()) == want and len(want) > 5000


def test_a_long_interval_is_not_cut_into_many(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("x").alias("chr"), (F.col("id") * 10 + 1).alias("start"), (F.col("id") * 10 + 5).alias("end"))
    df = df.unionByName(spark.createDataFrame([(5000, "x", 1, 2**61)], "id long, chr string, start long, end long"))
    pairs = intervals.pair_overlaps(df, "id", "id", width="levels")
    assert pairs.count() == 1000
    plan = pairs._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    rows, _ = df.withColumn("w", intervals._level("start", "end")), None
    assert {r["w"] for r in rows.collect()} == {3, 61}


def test_levels_of_lengths(spark):
    got = spark.createDataFrame([(0, n) for n in (0, 1, 2, 3, 4, 7, 8, 2**40)], "s long, e long").select("e", intervals._level("s", "e").alias("k")).collect()
    assert all(2 ** r["k"] >= r["e"] + 1 and (r["k"] == 0 or 2 ** (r["k"] - 1) < r["e"] + 1) for r in got)


def test_empty_sides(spark):
    none = spark.createDataFrame([], "i long, chr string, start long, end long")
    some = spark.createDataFrame([(1, "x", 1, 2)], "j long, g string, s long, e long")
    assert intervals.overlap_join(none, some, on_b=("g", "s", "e"), width="levels").collect() == []

"""The vector store is exact, and skips what its bounds exclude."""

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.operators import vector_store


def brute(rows: list[tuple], query: list[float], k: int) -> list[tuple[int, float]]:
    q, out = np.asarray(query, float), []
    for i, v in rows:
        v = np.array([math.nan if x is None else x for x in v] if v is not None else [math.nan], float)
        good = np.isfinite(v).all() and np.linalg.norm(v) > 0 and np.linalg.norm(q) > 0
        out.append((-round(float(v @ q / np.linalg.norm(v) / np.linalg.norm(q)), 6) + 0.0 if good else 0.0, i))
    return [(i, -s) for s, i in sorted(out)[:k]]


@pytest.fixture(scope="module")
def rows():
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((25, 16))
    found = [(k, (centres[k % 25] + 0.15 * rng.standard_normal(16)).tolist()) for k in range(5000)]
    return [*found, (6000, [0.0] * 16), (6001, None), (6002, [math.nan] * 16), (6003, [None] * 16), (6004, found[0][1]), (6005, [1e30] * 16)]


@pytest.fixture(scope="module")
def store(spark, rows, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("vectors"))
    vector_store.build(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), path, cells=25)
    return vector_store.VectorStore.load(spark, path)


@pytest.mark.parametrize("k", [1, 10, 300])
def test_exact(rows, store, k):
    for query in (rows[7][1], [-x for x in rows[8][1]], [1.0] + [0.0] * 15):
        got = [(r["vec_id"], r["score"]) for r in store.topk(query, k).collect()]
        want = brute(rows, query, k)
        assert [s for _, s in got] == pytest.approx([s for _, s in want], abs=2e-6) and len(got) == k
        assert sum(a == b for (a, _), (b, _) in zip(got, want, strict=True)) >= 0.99 * k


def test_all_rows_failed_ones_and_a_query_of_zero(rows, store):
    got = [r["vec_id"] for r in store.topk(rows[3][1], 10_000).collect()]
    assert sorted(got) == sorted(i for i, _ in rows)
    assert [r["vec_id"] for r in store.topk([0.0] * 16, 3).collect()] == [0, 1, 2]


def test_most_cells_and_files_are_skipped(spark, rows, store):
    unit, chosen, reach = store.plan(rows[7][1], 10)
    assert sum(c[2] for c in chosen) < 0.15 * len(rows) and reach < 1
    search = store._search(unit, chosen, reach, 10, None, "vec_id")
    assert "PartitionFilters: [cell" in search._jdf.queryExecution().toString().replace("isnotnull(cell#", "[cell#") or "cell IN" in search._jdf.queryExecution().toString()
    files = store.rows.where(F.col("cell").isin([c[1] for c in chosen])).select(F.input_file_name()).distinct().count()
    assert "gap" in search._jdf.queryExecution().toString() and "GreaterThanOrEqual(gap" in search._jdf.queryExecution().toString()
    assert files < len(store.rows.inputFiles()) / 3


def test_filters_come_before_the_limit(spark, rows, store):
    ids = spark.range(0, 5000, 7).withColumnRenamed("id", "vec_id")
    got = [r["vec_id"] for r in store.topk(rows[7][1], 20, ids).collect()]
    assert got == [i for i, _ in brute([r for r in rows if r[0] % 7 == 0 and r[0] < 5000], rows[7][1], 20)]


def test_empty_and_lengths(spark, tmp_path):
    vector_store.build(spark.createDataFrame([], "vec_id long, embedding array<double>"), f"{tmp_path}/e")
    assert vector_store.VectorStore.load(spark, f"{tmp_path}/e").topk([1.0], 5).collect() == []
    with pytest.raises(ValueError):
        vector_store.build(spark.createDataFrame([(1, [1.0]), (2, [1.0, 2.0])], "vec_id long, embedding array<double>"), f"{tmp_path}/l")
    vector_store.build(spark.createDataFrame([(1, [3.0]), (2, [0.0])], "vec_id long, embedding array<double>"), f"{tmp_path}/f")
    small = vector_store.VectorStore.load(spark, f"{tmp_path}/f")
    assert [tuple(r) for r in small.topk([-1.0], 5).collect()] == [(2, 0.0), (1, -1.0)] and small.vector(1) == [1.0] and small.vector(2) is None

from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import ann
from tessera.llm.queries import op7_nearest_neighbours

SCHEMA = "vec_id long, embedding array<float>, label int, id string, code string, v int, length int"


def brute(rows, queries, k=10):
    """(query, rank, vec_id) by distance in double precision, ties to the smaller id."""
    out = {}
    ids, m = np.array([r[0] for r in rows]), np.array([r[1] for r in rows], dtype=np.float64)
    for q, v in queries:
        d = np.sqrt(((m - np.asarray(v, dtype=np.float64)) ** 2).sum(axis=1))
        out[q] = [(int(ids[i]), float(d[i])) for i in np.lexsort((ids, d)) if ids[i] != q][:k]
    return out


def test_query_recall(spark, smallest):
    rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{smallest}/embeddings.parquet").collect()]
    want = brute(rows, [r for r in rows if r[0] % 100 == 0])
    got: dict = {}
    for r in op7_nearest_neighbours(spark, smallest).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
        assert r["rank"] == len(got[r["query_id"]])
    assert got.keys() == want.keys() and all(len(got[q]) == 10 for q in want)
    hits = sum(len({i for i, _ in got[q]} & {i for i, _ in want[q]}) for q in want)
    assert hits >= 0.98 * 10 * len(want)
    vectors = {i: np.asarray(v, dtype=np.float64) for i, v in rows}
    assert all(math.isclose(s, np.linalg.norm(vectors[q] - vectors[i]), rel_tol=1e-12) for q, own in got.items() for i, s in own)


@pytest.mark.parametrize("block", [3, 4096])
def test_blocks_of_queries_and_recall_on_clusters(spark, block):
    rng = np.random.default_rng(3)
    centres = rng.standard_normal((12, 30)) * 3
    rows = [(i, (centres[i % 12] + rng.standard_normal(30)).astype(np.float32).tolist()) for i in range(1500)]
    df = spark.createDataFrame([(i, v, 1, "a", "b", 2, 3) for i, v in rows], SCHEMA).repartition(5)
    got: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 150 == 0, k=7, block=block).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, [r for r in rows if r[0] % 150 == 0], 7)
    assert got.keys() == want.keys()
    assert sum(len(got[q] & {i for i, _ in want[q]}) for q in want) >= 0.95 * 7 * len(want)


def test_bounds_choose_few_for_reranking():
    rng = np.random.default_rng(5)
    d, n = 64, 4000
    centres = rng.standard_normal((40, d))
    v = centres[rng.integers(0, 40, n)] + 0.3 * rng.standard_normal((n, d))
    turn, centre = ann.rotation(d, 1), v.mean(axis=0)
    o = (v - centre) @ turn.T
    length = np.sqrt((o * o).sum(axis=1))
    ip = np.abs(o).sum(axis=1) / np.sqrt(d) / length
    search = ann.Searcher(np.array([-1, -2]), np.array([-1, -2]), v[:2] + 0.01, centre, turn, 10, ann.EPSILON)
    search.show(np.arange(n), np.arange(n), v, np.packbits(o > 0, axis=1), length, ip)
    assert search.reranked < 0.5 * 2 * n


def test_bad_vectors_ties_repeats_few_and_empty(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (100, [0.0, 1.0]), (1, [1.0, 1.0]), (2, [1.0, 1.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [1.0, None]), (6, [nan, 1.0]), (7, [inf, 1.0]), (8, [1.0, 2.0, 3.0]), (200, [0.0, 0.0]), (None, [1.0, 0.5]), (9, [])]
    df = spark.createDataFrame([(i, v, 1, "a", "b", 2, 3) for i, v in rows], SCHEMA)
    got = [tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).orderBy("query_id", "rank").collect()]
    root = math.sqrt(2)
    assert got == [(0, 1, 1, 1.0), (0, 2, 2, 1.0), (0, 3, 2, 1.0), (0, 4, 100, root), (100, 1, 1, 1.0), (100, 2, 2, 1.0), (100, 3, 2, 1.0), (100, 4, 0, root)]
    assert ann.nearest(df.limit(0), F.lit(True)).collect() == []
    assert ann.nearest(df, F.lit(False)).collect() == []


def test_every_length_is_searched_and_only_the_own_row_is_left_out(spark):
    rows = [(0, [1.0, 0.0]), (0, [1.0, 0.0]), (1, [3.0, 0.0]), (100, [1.0, 2.0, 3.0]), (2, [1.0, 2.0, 4.0]), (3, [5.0])]
    df = spark.createDataFrame([(i, v, 1, "a", "b", 2, 3) for i, v in rows], SCHEMA)
    got = sorted(tuple(r) for r in ann.nearest(df, F.col("vec_id") % 100 == 0).collect())
    assert got == [(0, 1, 0, 0.0), (0, 1, 0, 0.0), (0, 2, 1, 2.0), (0, 2, 1, 2.0), (100, 1, 2, 1.0)]


def test_wide_vectors_make_small_blocks(spark, monkeypatch):
    rng = np.random.default_rng(8)
    rows = [(i, v.tolist()) for i, v in enumerate(rng.standard_normal((60, 700)))]
    df = spark.createDataFrame([(i, v, 1, "a", "b", 2, 3) for i, v in rows], SCHEMA)
    monkeypatch.setattr(ann, "TABLE_BYTES", 4 * 88 * 256 * 4)
    got: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 6 == 0, k=3).collect():
        got.setdefault(r["query_id"], set()).add(r["vec_id"])
    want = brute(rows, [r for r in rows if r[0] % 6 == 0], 3)
    assert got == {q: {i for i, _ in v} for q, v in want.items()}


@pytest.mark.parametrize("huge", [[1e200, 1e200], [1e308, -1e308], [1e-200, 0.0]])
def test_vectors_whose_squares_overflow(spark, huge):
    rng = np.random.default_rng(8)
    rows = [(i, rng.standard_normal(2).tolist()) for i in range(400)]
    df = spark.createDataFrame([*rows, (1000, huge)], "vec_id long, embedding array<double>")
    got: dict = {}
    for r in ann.nearest(df, F.col("vec_id") % 100 == 0, k=10).orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["score"]))
    want = brute([*rows, (1000, huge)], [r for r in rows if r[0] % 100 == 0])
    assert all(sum(a == b for a, b in zip(got[q], want[q], strict=True)) >= 9 or len({i for i, _ in got[q]} & {i for i, _ in want[q]}) >= 9 for q in want)
    if huge[0] > 1:
        assert [i for i, _ in got[1000]] == list(range(10)) and all(math.isclose(s, math.hypot(*huge)) or math.isinf(s) for _, s in got[1000])

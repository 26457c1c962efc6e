"""Nearest neighbours by randomly rotated one-bit codes (after Gao and Long, RaBitQ, 2024).

Index: each vector, less a centroid, is rotated by a seeded random orthogonal matrix; the signs are its code, and two
correction scalars belong to it: the residual's length and the inner product of the unit residual with its code.
Search: inner products are estimated from the packed bits by byte lookup tables; the estimate's error bound gives a
lower bound of the distance, and only vectors whose bound beats a query's current k-th exact distance are reranked
on the original vectors. Queries go to the partitions in blocks whose lookup tables have a bounded size; one block is
broadcast at a time, every partition writes its own k best for it, and the next block follows, so neither the driver nor
a task ever holds more than a block.

The centroid is the median of at most ``SAMPLE`` rows in each component, so that no outlier moves it. Norms and distances whose squares overflow
are computed in scaled components; a bound that is not a number chooses its vector for reranking. Vectors that are null, zero, or hold a null or non-finite component
take no part. Distances are defined between vectors of one length, so each length has an index of its own, and a query's
candidates are the rows of its length. Ties go to the smaller id; an empty table gives no rows; rows without an id take no
part; rows that repeat an id are candidates and queries of their own: a query leaves out only its own row. Vectors of any
length are taken, and other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import fresh_path, saved

SAMPLE = 4096
#: Queries of a block at most, and bytes of a block's lookup tables at most: what is broadcast and held at once.
QUERY_BLOCK, TABLE_BYTES = 4096, 64 << 20
#: Standard deviations of the estimate's error that the lower bound allows for.
EPSILON = 3.0


def usable(vectors: DataFrame, id_: str, vector: str, asked: Column) -> DataFrame:
    """id, v (array of double), asked and row (a number of its own) of the rows that take part."""
    rows = vectors.select(F.col(id_).cast("long").alias("id"), F.col(vector).cast("array<double>").alias("v"), F.coalesce(asked, F.lit(False)).alias("asked"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    rows = rows.where(F.col("id").isNotNull() & F.col("v").isNotNull() & ~bad & F.exists("v", lambda x: x != 0))
    return rows.withColumn("row", F.monotonically_increasing_id())


def rotation(d: int, seed: int) -> np.ndarray:
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((d, d)))
    return q * np.sign(np.diag(r))


def norms(rows: np.ndarray) -> np.ndarray:
    """Euclidean norms of the rows, whose squares may overflow."""
    with np.errstate(over="ignore", under="ignore"):
        total = np.sqrt((rows * rows).sum(axis=1))
        top = np.abs(rows).max(axis=1)
        odd = ~np.isfinite(total) | ((total < 1e-150) & (top > 0))
        if odd.any():
            total[odd] = top[odd] * np.sqrt(((rows[odd] / top[odd][:, None]) ** 2).sum(axis=1))
    return total


def build_index(rows: DataFrame, seed: int = 7) -> tuple[DataFrame, np.ndarray, np.ndarray]:
    """(id, row, v, code, length, ip for every row; centroid; rotation). Vectors have one length."""
    some = np.array([r[0] for r in rows.orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE).select("v").collect()])
    centre, turn = np.median(some / 2, axis=0) * 2, rotation(some.shape[1], seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                o = (v - centre) @ turn.T
                length, top = norms(o), np.abs(o).max(axis=1)
                ip = np.abs(o / np.where(top > 0, top, 1)[:, None]).sum(axis=1) / np.sqrt(v.shape[1]) / np.where(length > 0, length / np.where(top > 0, top, 1), 1)
                code = np.packbits(o > 0, axis=1)
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("row"), b.column("v"), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(length), pa.array(np.where(length > 0, ip, 1.0))], names=["id", "row", "v", "code", "length", "ip"])

    return rows.select("id", "row", "v").mapInArrow(run, "id long, row long, v array<double>, code binary, length double, ip double"), centre, turn


def exact_distance(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Euclidean distances of rows of ``v`` to ``q``, summed in order of the components."""
    total = np.zeros(len(v))
    with np.errstate(over="ignore"):
        for k in range(v.shape[1]):
            total += (v[:, k] - q[..., k]) ** 2
        far = np.flatnonzero(~np.isfinite(total))
        total = np.sqrt(total)
        if len(far):
            total[far] = norms(v[far] - q)
    return total


class Searcher:
    """The k best of what it has been shown, for a block of queries, each known by its row number."""

    def __init__(self, rows: np.ndarray, ids: np.ndarray, queries: np.ndarray, centre: np.ndarray, turn: np.ndarray, k: int, epsilon: float) -> None:
        self.rows, self.ids, self.queries, self.k, self.epsilon, self.d = rows, ids, queries, k, epsilon, queries.shape[1]
        q = (queries - centre) @ turn.T
        self.length = norms(q)
        unit = q / np.where(self.length > 0, self.length, 1)[:, None]
        unit = np.pad(unit, ((0, 0), (0, -self.d % 8)))
        signs = np.where(np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1), 1.0, -1.0)
        # tables[q, byte, value]: what a code's byte adds to the inner product of the code with the query
        self.tables = (np.einsum("qbi,vi->qbv", unit.reshape(len(unit), -1, 8), signs) / np.sqrt(self.d)).astype(np.float32)
        self.best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        self.reranked = 0

    def show(self, rows: np.ndarray, ids: np.ndarray, v: np.ndarray, code: np.ndarray, length: np.ndarray, ip: np.ndarray) -> None:
        with np.errstate(over="ignore", invalid="ignore"):
            self._show(rows, ids, v, code, length, ip)

    def _show(self, rows: np.ndarray, ids: np.ndarray, v: np.ndarray, code: np.ndarray, length: np.ndarray, ip: np.ndarray) -> None:
        slack = self.epsilon * np.sqrt(np.maximum(0, 1 - ip * ip)) / ip / np.sqrt(max(1, self.d - 1))
        for n in range(len(self.ids)):
            estimate = sum(self.tables[n, j][code[:, j]] for j in range(code.shape[1])) / ip
            both = 2 * self.length[n] * length
            low = length**2 + self.length[n] ** 2 - both * np.minimum(1, estimate + slack)  # infinite or not a number where squares overflow
            far, near = self.best[n]
            if len(far) < self.k:  # a first threshold: the exact k-th of the best estimates
                seed = np.argpartition(low, min(2 * self.k, len(low) - 1))[: 2 * self.k + 1]
                seed = seed[rows[seed] != self.rows[n]]
                first = np.sort(exact_distance(self.queries[n], v[seed]))
                limit = first[self.k - 1] if len(first) >= self.k else np.inf
            else:
                limit = far[-1]
            chosen = np.flatnonzero(~(low > limit * limit * (1 + 1e-5) + 1e-9) & (rows != self.rows[n]))
            self.reranked += len(chosen)
            far = np.r_[far, exact_distance(self.queries[n], v[chosen])]
            near = np.r_[near, ids[chosen]]
            order = np.lexsort((near, far))[: self.k]
            self.best[n] = far[order], near[order]

    def result(self) -> pa.RecordBatch:
        n = [len(x) for x, _ in self.best]
        return pa.RecordBatch.from_arrays([pa.array(np.repeat(self.rows, n)), pa.array(np.repeat(self.ids, n)), pa.array(np.concatenate([x for _, x in self.best])), pa.array(np.concatenate([x for x, _ in self.best]))], names=["query", "query_id", "vec_id", "score"])


FOUND = "query long, query_id long, vec_id long, score double"


def nearest(vectors: DataFrame, asked: Column, k: int = 10, id_: str = "vec_id", vector: str = "embedding", seed: int = 7, epsilon: float = EPSILON, block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank, vec_id, score: for each row of ``vectors`` that ``asked`` names, its ``k`` nearest other rows, nearest first."""
    spark = vectors.sparkSession
    rows = saved(usable(vectors, id_, vector, asked), "vectors")
    path = fresh_path(spark, "nearest")
    spark.createDataFrame([], FOUND).write.parquet(path)
    lengths = [r[0] for r in rows.where("asked").select(F.size("v")).distinct().orderBy(F.size("v")).collect()]  # a number for each length of vectors
    for d in lengths:
        own = rows.where(F.size("v") == d)
        index, centre, turn = build_index(own, seed)
        _search(saved(index, "index"), saved(own.where("asked").select("row", "id", "v").repartitionByRange("row").sortWithinPartitions("row"), "queries"),
                centre, turn, k, epsilon, max(1, min(block, TABLE_BYTES // (-(-d // 8) * 256 * 4))), path)
    order = Window.partitionBy("query").orderBy("score", "vec_id")
    found = spark.read.schema(FOUND).parquet(path)
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _search(index: DataFrame, queries: DataFrame, centre: np.ndarray, turn: np.ndarray, k: int, epsilon: float, block: int, path: str) -> None:
    """Append every partition's ``k`` best for each query to ``path``, a block of queries at a time; the driver holds one block."""
    spark, last = index.sparkSession, -1
    while got := queries.where(F.col("row") > last).orderBy("row").limit(block).collect():
        last = got[-1][0]
        shared = spark.sparkContext.broadcast((np.array([r[0] for r in got]), np.array([r[1] for r in got]), np.array([r[2] for r in got]), centre, turn))

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            search = Searcher(*shared.value, k, epsilon)
            for b in batches:
                if b.num_rows:
                    v = b.column("v").flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
                    code = np.frombuffer(b"".join(b.column("code").to_pylist()), np.uint8).reshape(b.num_rows, -1)
                    search.show(b.column("row").to_numpy(), b.column("id").to_numpy(), v, code, b.column("length").to_numpy(), b.column("ip").to_numpy())
            yield search.result()

        index.mapInArrow(run, FOUND).write.mode("append").parquet(path)
        shared.unpersist()
        if len(got) < block:
            return

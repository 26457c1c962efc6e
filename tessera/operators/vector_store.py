"""A stored table of unit vectors in cells around centroids, and exact top-k search that skips most of it.

    build(vectors, path)
    VectorStore.load(spark, path).topk(query, 20)

A cell is a folder (a partition column), rows in it lie by their distance to the centroid. Vectors are made unit vectors
once, so a score is one dot product. For unit vectors |q - v|² = 2 - 2 cos, and |q - v| >= | |q - c| - |v - c| | for the centroid c: with the least and
greatest distance of a cell's rows, kept beside its centroid, this bounds every score in the cell from above. The most promising cells are
searched first; their k-th score leaves only the cells whose bound reaches it, and in these the rows whose distance to the centroid is near enough
(a range of a sorted column, which Parquet statistics use). The answer is exact whatever the cells are; they only decide how much is read.

Defined results: vectors that failed (zero, null, with components that are null or not finite) score 0 and are still ranked; they lie in a cell of
their own. Ties go to the smaller id. An empty store gives no rows. A query of length zero scores every row 0.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.vectors import literal

#: Rows that the centroids are fitted on at most, rounds of the fit, and cells by default: one for so many rows, within bounds.
SAMPLE, ROUNDS = 20_000, 8
ROWS_A_CELL, MOST_CELLS = 20_000, 1024
#: The cell of failed vectors.
FAILED = -1
#: Digits of a score, and what rounding may hide when bounds are compared.
DIGITS, SLACK = 6, 2e-6
#: Cells searched first: as few as hold so many times k rows.
FIRST = 4


def centroids(sample: np.ndarray, cells: int, seed: int = 5) -> np.ndarray:
    """Unit centroids of unit vectors: k-means++ seeds on the sphere, then a few rounds of means."""
    rng = np.random.default_rng(seed)
    found = [sample[rng.integers(len(sample))]]
    far = np.full(len(sample), np.inf)
    for _ in range(min(cells, len(sample)) - 1):
        far = np.minimum(far, np.maximum(0, 2 - 2 * sample @ found[-1]))
        if far.sum() <= 1e-12:
            break
        found.append(sample[rng.choice(len(sample), p=far / far.sum())])
    centres = np.array(found)
    for _ in range(ROUNDS):
        own = np.argmax(sample @ centres.T, axis=1)
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        length = np.linalg.norm(sums, axis=1)
        centres = np.where(length[:, None] > 1e-9, sums / np.maximum(length, 1e-9)[:, None], centres)
    return centres


def _dot(v: Column, values: list[float]) -> Column:
    """The inner product with a known vector: one pass, summed in order of the components."""
    return F.aggregate(F.zip_with(v, literal(values), lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


def unit_rows(vectors: DataFrame, id_: str, vector: str) -> DataFrame:
    """id and unit (array of double, null where the vector failed) of every row."""
    v = F.col(vector).cast("array<double>")
    rows = vectors.select(F.col(id_).alias("id"), v.alias("v"))
    good = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    rows = rows.withColumn("length", F.when(good, length))
    return rows.select("id", F.when(F.col("length") > 0, F.transform("v", lambda x: x / F.col("length"))).alias("unit"))


def build(vectors: DataFrame, path: str, id_: str = "vec_id", vector: str = "embedding", cells: int | None = None, seed: int = 5) -> None:
    """Write the store below ``path``. Centroids are fitted on at most ``SAMPLE`` rows, drawn by a hash of their ids; every row is stored.

    All vectors must have one length. A row's cell is found in Arrow batches by one matrix product with the centroids.
    """
    spark = vectors.sparkSession
    rows = unit_rows(vectors, id_, vector)
    amount = rows.agg(F.count("*"), F.count("unit"), F.min(F.size("unit")), F.max(F.size("unit"))).first()
    if amount[1] and amount[2] != amount[3]:
        raise ValueError("vectors of different lengths: give each length a store of its own")
    centres = np.zeros((0, amount[2] or 0))
    if amount[1]:
        some = rows.where("unit is not null").orderBy(F.xxhash64("id", F.lit(seed)), "id").limit(SAMPLE).select("unit").toArrow().column(0)
        sample = np.concatenate([c.flatten().to_numpy() for c in some.chunks]).reshape(-1, amount[2])
        centres = centroids(sample, cells or max(1, min(MOST_CELLS, math.ceil(amount[1] / ROWS_A_CELL), len(sample))), seed)

    def run(batches):  # noqa: ANN001, ANN202
        import pyarrow as pa

        for b in batches:
            for at in range(0, b.num_rows, 4096):
                some = b.slice(at, 4096)
                cell, gap = np.full(some.num_rows, FAILED, np.int32), np.zeros(some.num_rows)
                good = np.flatnonzero(np.asarray(some.column("unit").is_valid()))
                if len(good):
                    v = some.column("unit").take(pa.array(good)).flatten().to_numpy().reshape(len(good), -1)
                    cell[good] = np.argmax(v @ centres.T, axis=1)
                    gap[good] = np.sqrt(((v - centres[cell[good]]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays([some.column("id"), some.column("unit"), pa.array(gap), pa.array(cell)], names=["id", "unit", "gap", "cell"])

    kind = rows.schema["id"].dataType.simpleString()
    placed = rows.mapInArrow(run, f"id {kind}, unit array<double>, gap double, cell int")
    # large cells are dealt into ranges of the distance, so no task writes a whole cell
    placed.repartitionByRange("cell", "gap", "id").sortWithinPartitions("cell", "gap", "id").write.mode("overwrite").partitionBy("cell").parquet(f"{path}/rows")
    stored = spark.read.parquet(f"{path}/rows") if amount[0] else spark.createDataFrame([], f"id {kind}, unit array<double>, gap double, cell int")
    if not amount[0]:
        stored.write.mode("overwrite").parquet(f"{path}/rows")
    known = spark.createDataFrame([(k, c.tolist()) for k, c in enumerate(centres)], "cell int, centre array<double>")
    sizes = stored.groupBy("cell").agg(F.count("*").alias("n"), F.min("gap").alias("near"), F.max("gap").alias("far"))
    sizes.join(known, "cell", "left").coalesce(1).write.mode("overwrite").parquet(f"{path}/cells")


class VectorStore:
    def __init__(self, rows: DataFrame, cells: DataFrame) -> None:
        self.rows, self.spark = rows, rows.sparkSession
        self.cells = cells.collect()  # at most MOST_CELLS + 1 rows

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> VectorStore:
        return cls(spark.read.parquet(f"{path}/rows"), spark.read.parquet(f"{path}/cells"))

    def _bounds(self, query: np.ndarray) -> list[tuple[float, int, int, float]]:
        """(greatest possible score, cell, rows, distance of the query to the centroid), the most promising first."""
        out = []
        for r in self.cells:
            if r["cell"] == FAILED:
                out.append((0.0, FAILED, r["n"], 0.0))
                continue
            d = float(np.linalg.norm(query - np.array(r["centre"])))
            least = max(0.0, d - r["far"], r["near"] - d)
            out.append((1 - least * least / 2, r["cell"], r["n"], d))
        return sorted(out, key=lambda x: (-x[0], x[1]))

    def _search(self, query: list[float], chosen: list[tuple[float, int, int, float]], reach: float, k: int, ids: DataFrame | None, id_: str) -> DataFrame:
        """The ``k`` best of the cells; ``reach``: rows farther from the query do not count, nor do those whose distance to the centroid says so."""
        inside = F.lit(False)
        for _, cell, _, d in chosen:
            inside = inside | ((F.col("cell") == cell) if cell == FAILED or reach >= 2 else (F.col("cell") == cell) & F.col("gap").between(d - reach, d + reach))
        rows = self.rows.where(F.col("cell").isin([c[1] for c in chosen])).where(inside)
        if ids is not None:
            rows = rows.join(ids.select(F.col(id_).alias("id")), "id", "left_semi")
        score = F.coalesce(_dot(F.col("unit"), query), F.lit(0.0))
        return rows.select(F.col("id").alias(id_), (F.round(score, DIGITS) + F.lit(0.0)).alias("score")).orderBy(F.desc("score"), id_).limit(k)

    def plan(self, query: list[float], k: int, ids: DataFrame | None = None, id_: str = "vec_id") -> tuple[list[float], list[tuple[float, int, int, float]], float]:
        """The unit query, the cells that can hold one of the ``k`` best, and how far from the query such a row can be."""
        q = np.asarray(query, float)
        length = np.linalg.norm(q)
        q = q / length if length > 0 else q
        if not length:
            return q.tolist(), [(0.0, r["cell"], r["n"], 1.0) for r in self.cells], 2.0
        order, first, seen = self._bounds(q), [], 0
        for c in order:
            if seen >= FIRST * k:
                break
            first.append(c)
            seen += c[2]
        if len(first) == len(order):
            return q.tolist(), order, 2.0
        least, found = self._search(q.tolist(), first, 2.0, k, ids, id_).agg(F.min("score"), F.count("*")).first()
        if found < k:
            return q.tolist(), order, 2.0
        return q.tolist(), [c for c in order if c[0] >= least - SLACK], math.sqrt(max(0.0, 2 - 2 * (least - SLACK))) + 1e-9

    def topk(self, query: list[float], k: int, ids: DataFrame | None = None, id_: str = "vec_id") -> DataFrame:
        """id_, score of the ``k`` rows most similar by cosine, the best first. ``ids``: only rows that it names take part."""
        if not self.cells:
            return self.rows.select(F.col("id").alias(id_), F.lit(0.0).alias("score")).limit(0)
        unit, chosen, reach = self.plan(query, k, ids, id_)
        return self._search(unit, chosen, reach, k, ids, id_)

    def vector(self, id_: object) -> list[float] | None:
        """The stored unit vector of an id."""
        row = self.rows.where(F.col("id") == id_).select("unit").first()
        return list(row["unit"]) if row and row["unit"] is not None else None

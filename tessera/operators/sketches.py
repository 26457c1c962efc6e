"""Statistics that merge: a row of sketches for each shard, read instead of the data.

``by_shard`` makes, for each shard, the number of rows, a HyperLogLog sketch for each column whose distinct values are counted and a KLL sketch for each
column whose quantiles are asked for, by Spark's sketch aggregates. Such rows are stored; a new shard adds its row, a changed one replaces it, and ``merged`` answers from them
without a scan of the data. Sums, extremes and counts merge exactly. The standard error of a distinct count is 1.04 / sqrt(2 ** LG_K), 0.8 % with the
default, of the rank of a quantile about 0.9 % (k = 300); where exact figures are wanted, ``lookup.statistics`` aggregates the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Logarithm of the buckets of a HyperLogLog sketch, and the k of a KLL sketch.
LG_K, KLL_K = 14, 300


def by_shard(df: DataFrame, shard: list[str], distinct: list[str] = [], numbers: list[str] = []) -> DataFrame:  # noqa: B006
    """The shard columns, n, for each of ``distinct`` n_c (values that are not null) and hll_c, for each of ``numbers`` n_c, sum_c, min_c, max_c and kll_c."""
    measures = [F.count("*").alias("n")]
    for c in distinct:
        measures += [F.count(c).alias(f"n_{c}"), F.hll_sketch_agg(F.col(c).cast("string"), F.lit(LG_K)).alias(f"hll_{c}")]
    for c in numbers:
        x = F.col(c).cast("double")
        x = F.when(~F.isnan(x), x)
        measures += [F.count(x).alias(f"count_{c}"), F.sum(x).alias(f"sum_{c}"), F.min(x).alias(f"min_{c}"), F.max(x).alias(f"max_{c}"), F.kll_sketch_agg_double(x, F.lit(KLL_K)).alias(f"kll_{c}")]
    return df.groupBy(*shard).agg(*measures)


def replaced(stored: DataFrame, fresh: DataFrame, shard: list[str]) -> DataFrame:
    """The stored rows with those of the ``fresh`` shards in place of their own."""
    return stored.join(fresh.select(*shard), shard, "left_anti").unionByName(fresh)


def _columns(stored: DataFrame, prefix: str) -> list[str]:
    return [c[len(prefix) :] for c in stored.columns if c.startswith(prefix)]


def merged(stored: DataFrame, keys: list[str] = [], quantiles: tuple[float, ...] = (0.25, 0.5, 0.75)) -> DataFrame:  # noqa: B006
    """By the ``keys`` (some of the shard columns; none: one row): n, n_c, distinct_c, mean_c, min_c, max_c and quantiles_c (an array)."""
    first: list[Column] = [F.sum("n").alias("n")]
    second: list[Column] = [F.col("n")]
    for c in _columns(stored, "hll_"):
        first += [F.sum(f"n_{c}").alias(f"n_{c}"), F.hll_union_agg(f"hll_{c}").alias(f"hll_{c}")]
        second += [F.col(f"n_{c}"), F.coalesce(F.hll_sketch_estimate(f"hll_{c}"), F.lit(0)).alias(f"distinct_{c}")]
    for c in _columns(stored, "kll_"):
        first += [F.sum(f"count_{c}").alias(f"count_{c}"), F.sum(f"sum_{c}").alias(f"sum_{c}"), F.min(f"min_{c}").alias(f"min_{c}"), F.max(f"max_{c}").alias(f"max_{c}"), F.kll_merge_agg_double(F.when(F.col(f"count_{c}") > 0, F.col(f"kll_{c}"))).alias(f"kll_{c}")]
        asked = F.array(*[F.lit(float(q)) for q in quantiles])
        second += [(F.col(f"sum_{c}") / F.nullif(F.col(f"count_{c}"), F.lit(0))).alias(f"mean_{c}"), F.col(f"min_{c}"), F.col(f"max_{c}"), F.when(F.col(f"count_{c}") > 0, F.kll_sketch_get_quantile_double(f"kll_{c}", asked)).alias(f"quantiles_{c}")]
    return stored.groupBy(*keys).agg(*first).select(*keys, *second)


def ranks(stored: DataFrame, column: str, values: list[float], keys: list[str] = []) -> DataFrame:  # noqa: B006
    """By the ``keys``: the share of a number column's values at or below each of ``values`` (an array, rank)."""
    one = stored.where(F.col(f"count_{column}") > 0).groupBy(*keys).agg(F.kll_merge_agg_double(f"kll_{column}").alias("k"))
    return one.select(*keys, F.kll_sketch_get_rank_double("k", F.array(*[F.lit(float(v)) for v in values])).alias("rank"))

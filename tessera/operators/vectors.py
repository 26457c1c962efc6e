"""Dense vectors: normalisation, cosine top-k with pre- or post-filters, two-query scores, hybrid region search."""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Inner product, summed in double in order of the components."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def cosine_to(v: Column, query: list[float]) -> Column:
    """Cosine similarity to a known query: its norm is taken once, and both sums run over the vector together."""
    length = math.sqrt(sum(x * x for x in query))
    if not length:
        return F.lit(0.0)
    pairs = F.arrays_zip(v.cast("array<double>").alias("x"), literal(query).alias("q"))
    start = F.struct(F.lit(0.0).alias("d"), F.lit(0.0).alias("n"))
    return F.aggregate(
        pairs, start, lambda s, p: F.struct((s["d"] + p["x"] * p["q"]).alias("d"), (s["n"] + p["x"] * p["x"]).alias("n")),
        lambda s: F.when(s["n"] > 0, s["d"] / (F.sqrt(s["n"]) * length)).otherwise(0.0),
    )


def norm(v: Column) -> Column:
    return F.sqrt(dot(v, v))


def normalise(v: Column) -> Column:
    """Unit vector; a zero vector stays zero."""
    n = F.coalesce(F.nullif(norm(v), F.lit(0.0)), F.lit(1.0))
    return F.transform(v, lambda x: x.cast("double") / n)


def literal(values: list[float]) -> Column:
    return F.array(*[F.lit(float(x)) for x in values])


def cosine(v: Column, query: Column) -> Column:
    """Cosine similarity; 0 where either is zero."""
    n = norm(v) * norm(query)
    return F.when(n > 0, dot(v, query) / n).otherwise(0.0)


def hashed_embedding(text: Column, dims: int = 64) -> Column:
    """A deterministic offline embedding: signed counts of hashed words, normalised. Stands in for a remote model."""
    words = F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), lambda w: w != "")
    slot = lambda w: F.pmod(F.xxhash64(w), F.lit(dims))
    sign = lambda w: F.when(F.pmod(F.shiftright(F.xxhash64(w), 32), F.lit(2)) == 0, 1.0).otherwise(-1.0)
    # words are hashed once, not once a dimension
    coded = F.transform(words, lambda w: F.struct(slot(w).cast("int").alias("k"), sign(w).alias("s")))
    counts = F.get(F.transform(F.array(coded), lambda xs: F.transform(F.sequence(F.lit(0), F.lit(dims - 1)), lambda d: F.aggregate(F.filter(xs, lambda x: x["k"] == d), F.lit(0.0), lambda s, x: s + x["s"]))), F.lit(0))
    return normalise(counts)


def semantic_topk(vectors: DataFrame, query: Column, k: int, id_: str = "vec_id", vector: str = "embedding", ids: DataFrame | None = None, digits: int = 6) -> DataFrame:
    """id_, score of the ``k`` most similar vectors, ties by id. ``ids``: only these ids take part (unknown ones are ignored).

    The plan is a projection and TakeOrderedAndProject: each task keeps k rows.
    """
    rows = vectors if ids is None else vectors.join(ids.select(id_), id_, "left_semi")
    return rows.select(id_, F.round(cosine(F.col(vector), query), digits).alias("score")).orderBy(F.desc("score"), id_).limit(k)


def two_query_scores(vectors: DataFrame, a: Column | list[float], b: Column | list[float], id_: str, vector: str, digits: int = 6) -> DataFrame:
    """id_, ev_a, ev_b, min_ev, max_ev in one scan."""
    near = lambda q: cosine_to(F.col(vector), q) if isinstance(q, list) else cosine(F.col(vector), q)
    rows = vectors.select(id_, F.round(near(a), digits).alias("ev_a"), F.round(near(b), digits).alias("ev_b"))
    return rows.select("*", F.least("ev_a", "ev_b").alias("min_ev"), F.greatest("ev_a", "ev_b").alias("max_ev"))


def with_metadata(hits: DataFrame, meta: DataFrame, id_: str, how: str = "inner") -> DataFrame:
    """``hits`` (a bounded top-k) with the metadata of their ids; ``left`` keeps unknown ids."""
    return hits.join(meta, id_, how)


def post_filtered(hits: DataFrame, facets: DataFrame, id_: str) -> DataFrame:
    """Hits that a facet table names: applied after the limit, so fewer than k may stay."""
    return hits.join(facets.select(id_).distinct(), id_, "left_semi")


def hybrid(members: DataFrame, vectors: DataFrame, query: Column, k: int, id_: str, vector_id: str, vector: str) -> DataFrame:
    """Rank the ``members`` of a region (filtered by the caller) by similarity; one plan, metadata joined to the k hits."""
    v = vectors.select(F.col(vector_id).alias(id_), vector)
    hits = semantic_topk(v, query, k, id_, vector, ids=members)
    return with_metadata(hits, members, id_)


def zero_filled(wanted: DataFrame, made: DataFrame, id_: str, dims: int) -> DataFrame:
    """A row for each wanted id: its vector (null components: zero), or a zero vector of ``dims`` where there is none or it has another length."""
    zero = F.array_repeat(F.lit(0.0).cast("float"), dims)
    good = F.when(F.size("embedding") == dims, F.transform("embedding", lambda x: F.coalesce(x.cast("float"), F.lit(0.0).cast("float"))))
    return wanted.select(id_).join(made.select(id_, "embedding"), id_, "left").select(id_, F.coalesce(good, zero).alias("embedding"))


def embed_missing(todo: DataFrame, done: DataFrame, id_: str, embed: Callable[[Column], Column], text: str = "text") -> DataFrame:
    """Vectors of the rows that have none or a zero one: the resumable batch of an embedding job."""
    good = done.where(norm(F.col("embedding")) > 0)
    return todo.join(good.select(id_), id_, "left_anti").select(id_, embed(F.col(text)).alias("embedding"))

"""Identifier resolution, reverse lookups, facets and statistics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def same(a: Column, b: Column | str) -> Column:
    """Equality regardless of ASCII case."""
    return F.lower(a) == F.lower(b if isinstance(b, Column) else F.lit(b))


def containing(a: Column, text: str) -> Column:
    """Case-insensitive substring; % and _ in ``text`` stand for themselves."""
    escaped = text.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_")
    return a.ilike(f"%{escaped}%")


def resolve(queries: DataFrame, tiers: list[tuple[DataFrame, str, str, list[Column]]], query: str = "query") -> DataFrame:
    """query, id, tier: the first tier that knows a query wins; inside a tier the given order decides.

    A tier is (rows, its name column, its id column, order). Names match regardless of case. Unknown queries are left out.
    """
    found = None
    for n, (rows, name, id_, order) in enumerate(tiers):
        keyed = rows.select(F.lower(name).alias("__k"), F.col(id_).alias("id"), F.struct(*[c.alias(f"o{i}") for i, c in enumerate([*order, F.col(id_)])]).alias("o"))
        best = keyed.groupBy("__k").agg(F.min_by("id", "o").alias("id"))
        hits = queries.select(query, F.lower(query).alias("__k")).join(best, "__k").select(query, "id", F.lit(n).alias("tier"))
        found = hits if found is None else found.unionByName(hits)
    return found.groupBy(query).agg(F.min_by("id", "tier").alias("id"), F.min("tier").alias("tier"))


def facet(predicates: list[Column]) -> Column:
    """All of the given predicates; true for none."""
    return reduce(lambda a, b: a & b, predicates, F.lit(True))


def having_each(rows: DataFrame, key: str, facets: list[tuple[DataFrame, Column]]) -> DataFrame:
    """Rows whose key has, for each facet, some row in its table that fits: different rows may fit different facets."""
    for table, predicate in facets:
        rows = rows.join(table.where(predicate).select(key), key, "left_semi")
    return rows


def having_same_row(rows: DataFrame, key: str, table: DataFrame, predicates: list[Column]) -> DataFrame:
    """Rows whose key has one row in ``table`` that fits all predicates."""
    return rows.join(table.where(facet(predicates)).select(key), key, "left_semi")


def reverse(tags: DataFrame, predicate: Column, entities: DataFrame, key: str, columns: list[str], order: list[Column], limit: int | None = None, distinct: bool = True) -> DataFrame:
    """Entities by a property: filter the tag relation first, join its few keys to the entities, order, limit."""
    found = tags.where(predicate).join(entities, key).select(*columns)
    found = found.distinct() if distinct else found
    found = found.orderBy(*order)
    return found.limit(limit) if limit else found


def in_category(bullets: DataFrame, entities: DataFrame, category: str, key: str, confidence: str | None = None, category_col: str = "category", confidence_col: str = "confidence") -> DataFrame:
    """Entities with a bullet in the category (and confidence); n_in_cat counts the category's bullets of every confidence."""
    own = bullets.where(F.col(category_col) == category)
    counts = own.groupBy(key).agg(F.count("*").alias("n_in_cat"))
    named = own if confidence is None else own.where(F.col(confidence_col) == confidence)
    return entities.join(named.select(key), key, "left_semi").join(counts, key)


def statistics(tables: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """metric, value: every table is aggregated once, however many measures it has."""
    rows = None
    for table, (df, measures) in tables.items():
        one = df.agg(*[c.cast("long").alias(f"{table}.{k}") for k, c in measures.items()])
        long = one.unpivot([], [F.col(f"`{c}`") for c in one.columns], "metric", "value")
        rows = long if rows is None else rows.unionByName(long)
    return rows


def group_counts(df: DataFrame, keys: list[str], name: str = "n", distinct: str | None = None, drop_null: bool = False) -> DataFrame:
    rows = df.dropna(subset=keys) if drop_null else df
    n = F.countDistinct(distinct) if distinct else F.count("*")
    return rows.groupBy(*keys).agg(n.alias(name)).orderBy(F.desc(name), *keys)


def top_per_group(df: DataFrame, group: list[str], order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group; ``order`` must break ties. Spark limits each group before the shuffle."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*group).orderBy(*order))).where(F.col(rank) <= n)


def select_references(refs: DataFrame, key: str, position: str, year: str, representative: str, limit: int = 20) -> DataFrame:
    """Representative references first (latest year first, then curated order), then others with a year, latest first."""
    usable = refs.where(F.col(representative) | F.col(year).isNotNull())
    return top_per_group(usable, [key], [F.desc(representative), F.col(year).desc_nulls_last(), F.col(position)], limit)


def any_reference(citations: DataFrame, key: str, label: str, order: list[str]) -> DataFrame:
    """key and its columns: one labelled citation of each entity, the first in ``order``."""
    rest = [c for c in citations.columns if c != key]
    named = citations.where(F.col(label).isNotNull())
    return named.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("__r")).select(key, "__r.*")


def stratified(df: DataFrame, stratum: str, id_: str, per_stratum: int, seed: int = 42, also: Column | None = None) -> DataFrame:
    """``per_stratum`` rows of each stratum in order of a seeded MD5 of the id, and all rows that ``also`` names."""
    order = F.md5(F.concat_ws("|", F.col(id_).cast("string"), F.lit(str(seed))))
    ranked = df.withColumn("__n", F.row_number().over(Window.partitionBy(stratum).orderBy(order, id_)))
    keep = F.col("__n") <= per_stratum
    return ranked.where(keep | also if also is not None else keep).drop("__n")


def letters(df: DataFrame, group: str, label: str, order: list[str]) -> DataFrame:
    """``df`` with ``id``: group_label, where rows without a label get A, B, ... in order within their group: the characters from A on in code-point order, past the surrogates."""
    blank = F.coalesce(F.trim(label), F.lit("")).isin("", "—", "-")
    n = F.row_number().over(Window.partitionBy(group, blank).orderBy(*order))
    point = 64 + n + F.when(64 + n >= 0xD800, 0x800).otherwise(0)  # chr is of bytes only
    letter = F.when(point <= 0x10FFFF, F.decode(F.unhex(F.lpad(F.hex(point), 8, "0")), "UTF-32")).otherwise(F.concat(F.lit("#"), n.cast("string")))
    name = F.when(blank, letter).otherwise(F.trim(label))
    return df.withColumn("id", F.concat_ws("_", F.lower(F.regexp_replace(group, " ", "_")), name))

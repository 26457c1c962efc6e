"""Record deduplication, merging and set comparison of relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def folded(name: Column) -> Column:
    """Lower case, white space collapsed and trimmed."""
    return F.lower(F.trim(F.regexp_replace(name, r"\s+", " ")))


def first_wins(df: DataFrame, key: list[Column], position: list[str]) -> DataFrame:
    """The row of each key that comes first; keys compare with nulls equal."""
    order = Window.partitionBy(*key).orderBy(*position)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def best_record(df: DataFrame, key: list[Column], completeness: list[Column], position: list[str]) -> DataFrame:
    """The most complete row of each key (larger is better, in turn), then the first."""
    order = Window.partitionBy(*key).orderBy(*[c.desc_nulls_last() for c in completeness], *position)
    return df.withColumn("__n", F.row_number().over(order)).where("__n = 1").drop("__n")


def last_wins(df: DataFrame, key: list[str], position: str) -> DataFrame:
    """The last row of each key, with ``first_position``: where the key first stood."""
    row = F.struct(*[c for c in df.columns if c not in key])
    return df.groupBy(*key).agg(F.max_by(row, position).alias("r"), F.min(position).alias("first_position")).select(*key, "r.*", "first_position")


def near_duplicates(rows: DataFrame, group: list[str], id_: str, position: str, tokens: str, threshold: float = 0.75, fewer: int = 3) -> DataFrame:
    """id_, earlier, similarity: rows that repeat an earlier row of their group: Jaccard similarity of at least the
    threshold and fewer than ``fewer`` tokens in only one of them. The first such earlier row is reported.

    Rows of equal token sets are one class, and its first row stands for it. Two sets with fewer than ``fewer`` differing
    tokens agree on one of ``fewer`` parts into which tokens are dealt by hash, so classes meet by the digest of a part and
    nothing is compared with all others. (Sets of a few tokens, of which a part may be empty, meet by size as well.)
    """
    keys = [F.coalesce(F.col(g).cast("string"), F.lit("\u0000")).alias(f"__g{k}") for k, g in enumerate(group)]
    names = [f"__g{k}" for k in range(len(group))]
    own = rows.where(F.size(tokens) > 0).select(F.col(id_), F.col(position).alias("__p"), *keys, F.array_sort(tokens).alias("__t"))
    own = own.withColumn("__d", F.md5(F.to_json("__t")))
    classes = own.groupBy(*names, "__d").agg(F.min_by(F.struct(F.col(id_).alias("id"), F.col("__p").alias("p")), "__p").alias("__f"), F.first("__t").alias("__t"))
    part = lambda k: F.to_json(F.filter("__t", lambda w: F.pmod(F.xxhash64(w), F.lit(fewer)) == k))
    dealt = classes.withColumn("__m", F.explode(F.array(*[F.xxhash64(F.lit(k), part(k), F.when(part(k) == "[]", F.size("__t")).otherwise(-1)) for k in range(fewer)])))
    # an empty part says nothing: such classes meet under every size within reach
    reach = F.array_distinct(F.flatten(F.array(*[F.when(part(k) == "[]", F.array(*[F.xxhash64(F.lit(k), F.lit("[]"), F.size("__t") + d) for d in range(1 - fewer, fewer)])).otherwise(F.array(F.xxhash64(F.lit(k), part(k), F.lit(-1)))) for k in range(fewer)])))
    other = classes.select(*names, F.col("__d").alias("__e"), F.col("__f").alias("__first"), F.col("__t").alias("__u"), F.explode(reach).alias("__m"))
    both, any_ = F.size(F.array_intersect("__t", "__u")), F.size(F.array_union("__t", "__u"))
    similar = dealt.join(other, [*names, "__m"]).where((both / any_ >= threshold) & (any_ - both < fewer))
    similar = similar.select(*names, "__d", "__first", (both / any_).alias("__s")).distinct()
    hits = own.drop("__t").join(similar, [*names, "__d"]).where(F.col("__first.p") < F.col("__p"))
    return hits.groupBy(id_).agg(F.min_by("__first.id", "__first.p").alias("earlier"), F.round(F.min_by("__s", "__first.p"), 6).alias("similarity"))


def full_merge(a: DataFrame, b: DataFrame, key: str, columns: list[str], names: tuple[str, str]) -> DataFrame:
    """Full outer merge of two sources by key: ``a``'s value if it has one, else ``b``'s; source names where a key is from."""
    left = a.select(key, *[F.col(c).alias(f"__a_{c}") for c in columns], F.lit(True).alias("__in_a"))
    right = b.select(key, *[F.col(c).alias(f"__b_{c}") for c in columns], F.lit(True).alias("__in_b"))
    both = left.join(right, key, "full")
    tag = F.when(F.col("__in_a") & F.col("__in_b"), "+".join(names)).when(F.col("__in_a"), names[0]).otherwise(names[1])
    return both.select(key, *[F.coalesce(f"__a_{c}", f"__b_{c}").alias(c) for c in columns], tag.alias("source"))


def layered(df: DataFrame, key: str, layers: list[DataFrame], columns: list[str]) -> DataFrame:
    """``df`` with ``columns`` from the first layer that has a non-empty value for the key. Layers have one row a key."""
    out = df
    for k, layer in enumerate(layers):
        have = [c for c in columns if c in layer.columns]
        out = out.join(layer.select(key, *[F.col(c).alias(f"__{k}_{c}") for c in have]), key, "left")
    picked = [F.coalesce(*[F.nullif(F.col(f"__{k}_{c}"), F.lit("")) for k, layer in enumerate(layers) if c in layer.columns]).alias(c) for c in columns]
    return out.select(*df.columns, *picked)


def todo(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """What is wanted and not done."""
    return wanted.join(done.select(key), key, "left_anti")


def membership(sets: dict[str, DataFrame], key: str) -> DataFrame:
    """key and a flag in_<name> for each set, over the union of all sets: one shuffle, whatever their number."""
    rows = None
    for name, df in sets.items():
        one = df.select(key, *[F.lit(n == name).alias(f"in_{n}") for n in sets])
        rows = one if rows is None else rows.unionByName(one)
    return rows.where(F.col(key).isNotNull()).groupBy(key).agg(*[F.max(f"in_{n}").alias(f"in_{n}") for n in sets])


def compare_lists(before: Column, after: Column) -> Column:
    """struct<added, dropped, stable, stability>: what changed between two arrays."""
    stable = F.array_intersect(before, after)
    whole = F.size(F.array_union(before, after))
    return F.struct(F.array_sort(F.array_except(after, before)).alias("added"), F.array_sort(F.array_except(before, after)).alias("dropped"), F.array_sort(stable).alias("stable"),
                    F.when(whole > 0, F.size(stable) / whole).otherwise(1.0).alias("stability"))


def unmatched_by_token(curated: DataFrame, proposed: DataFrame, key: str, name: str) -> DataFrame:
    """Curated rows, and proposed rows of which no short token (three to ten capitals with digits, or six digits) occurs among the key's curated names."""
    tokens = lambda c: F.array_distinct(F.regexp_extract_all(F.upper(c), F.lit(r"\b([A-Z]{3,10}\d+[A-Z]*|\d{6})\b"), F.lit(1)))
    known = curated.select(F.col(key).alias("__k"), F.explode(tokens(F.col(name))).alias("__t")).distinct()
    own = proposed.select("*", F.explode_outer(tokens(F.col(name))).alias("__own"))
    hit = own.join(known, (F.col(key) == F.col("__k")) & (F.col("__own") == F.col("__t")), "left_semi").select(key, name).distinct()
    return curated.unionByName(proposed.join(hit, [key, name], "left_anti"), allowMissingColumns=True)


def decode(df: DataFrame, key: str, ids: str, dictionary: DataFrame, id_: str, cap: int) -> DataFrame:
    """Ontology terms of an id list: the first ``cap`` ids, then those the dictionary knows; (key, pos, id, its columns)."""
    each = df.select(key, F.posexplode(F.slice(ids, 1, cap)).alias("pos", id_))
    return each.join(dictionary, id_)

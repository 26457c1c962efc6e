"""Exact duplicates with a heavy-hitter split.

Misra-Gries summaries of every partition name the digests that may be frequent; an exact count over all rows verifies
them, and their winners (at most ``counters`` rows) are broadcast, so copies of frequent texts are settled where they
lie. Only the remaining digests are shuffled: they are aggregated before that, and the join with the winners may be
split by adaptive execution, so no group has to fit in a task.

Texts are equal if they are identical after deleting spaces and the ASCII controls from tab to carriage return; a null
text is empty. Of equal texts the row with the most code points stays, then the smallest doc_id (nulls last), then
one of the repeated rows. Texts of any length become a digest where they lie. An empty table gives no rows; other
columns are not looked at, and ``drop_duplicates`` returns them as they are, whatever their names.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ASCII_SPACE, prepare, saved

COUNTERS = 1000


def digest(text: str = "text") -> Column:
    """SHA-256 (binary) of the text without white space, in UTF-8."""
    return F.unhex(F.sha2(F.translate(F.coalesce(text, F.lit("")), ASCII_SPACE, ""), 256))


def misra_gries(batches: Iterator[list], counters: int) -> Counter:
    """A Misra-Gries summary: every value in more than 1/(counters + 1) of the rows is in it, with a lower bound of its count."""
    kept: Counter = Counter()
    for values in batches:
        kept.update(Counter(values))
        if len(kept) > counters:  # subtract the (counters + 1)-th largest count from all, as merging summaries does
            least = sorted(kept.values(), reverse=True)[counters]
            kept = Counter({k: n - least for k, n in kept.items() if n > least})
    return kept


def frequent(digests: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """At most ``counters`` digests that may be the most frequent ones, by the summaries of all partitions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = misra_gries((b.column("digest").to_pylist() for b in batches), counters)
        yield pa.RecordBatch.from_arrays([pa.array(kept.keys(), pa.binary()), pa.array(kept.values(), pa.int64())], names=["digest", "seen"])

    sums = digests.select("digest").mapInArrow(run, "digest binary, seen long").groupBy("digest").agg(F.sum("seen").alias("seen"))
    return sums.where("seen > 1").orderBy(F.desc("seen"), "digest").limit(counters).select("digest")


def duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """doc_id, keep_id, group_size, kept, digest for every row of ``docs`` (doc_id, text)."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"), F.char_length(F.coalesce("text", F.lit(""))).alias("size"))
    rows = saved(rows.withColumn("row", F.monotonically_increasing_id()), "digests")
    best = F.struct(F.col("size"), F.col("doc_id").isNotNull().alias("has"), (-F.col("doc_id")).alias("back"), (-F.col("row")).alias("first"))
    names = saved(frequent(rows, counters), "frequent")  # at most ``counters`` rows
    found = rows.join(F.broadcast(names), "digest").groupBy("digest").agg(F.count("*").alias("group_size"), F.max(best).alias("best"))
    winners = F.broadcast(saved(found, "winners"))
    result = ["doc_id", (-F.col("best.back")).alias("keep_id"), "group_size", (F.col("row") == -F.col("best.first")).alias("kept"), "digest"]
    heavy = rows.join(winners, "digest").select(result)
    rest = rows.join(F.broadcast(names), "digest", "left_anti")
    # written: so joined, both sides are dealt anew and adaptive execution may split a digest of many rows
    groups = saved(rest.groupBy("digest").agg(F.count("*").alias("group_size"), F.max(best).alias("best")), "groups")
    light = rest.join(groups, "digest").select(result)
    return heavy.unionByName(light)


def drop_duplicates(docs: DataFrame, counters: int = COUNTERS) -> DataFrame:
    """``docs`` without the rows that ``duplicates`` drops.

    Rows are told apart by doc_id and digest; where a whole row's doc_id and text repeat, one of them stays.
    """
    marked = saved(duplicates(docs, counters), "marked")
    key = ["doc_id", "digest"]
    each = marked.groupBy(key).agg(F.count("*").alias("n"), F.max("kept").alias("stays"))
    gone, twice = each.where("not stays").select(key), each.where("stays and n > 1").select(key)

    # a row travels as one struct, so no name of its columns can clash with the keys beside it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), digest().alias("digest"))

    def same(table: DataFrame) -> Column:
        return rows["doc_id"].eqNullSafe(table["doc_id"]) & (rows["digest"] == table["digest"])

    stay = rows.join(gone, same(gone), "left_anti")
    if not twice.isEmpty():  # whole rows that repeat: only they are compared as rows
        rows = stay
        single = rows.join(twice, same(twice), "left_semi").groupBy("doc_id", "digest").agg(F.first("row").alias("row")).select("row", "doc_id", "digest")
        stay = rows.join(twice, same(twice), "left_anti").unionByName(single)
    return stay.select("row.*")

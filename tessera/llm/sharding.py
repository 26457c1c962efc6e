"""Sharding by extendible hashing: a directory indexed by hash-prefix bits.

A bucket is a prefix of the bits of a row's key hash. The directory starts with one bucket of no bits; only buckets
over the byte limit split, on their next bit. Bytes are first summed by a prefix long enough that most such cells lie
far below the limit; the buckets of all shorter prefixes are sums of cells. Only rows of cells that are still over
the limit are summed again by more bits.

The hash is the first 60 bits of the MD5 of the key's decimal digits (a null key: of the word null). A bucket whose
rows share one hash cannot split: it stays, over the limit, with its size. A null text has no bytes; repeated rows
share a bucket; of texts only the length is taken, whatever it is; an empty table gives no rows; other columns are not
looked at (``write_shards`` writes them, in folders named by the column ``shard``, or ``shard_`` and so on if that name is taken).

The directory grows with the bytes, so it is joined by sorting and never broadcast; adaptive execution may split a cell
of very many rows, as the directory is a written table.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import prepare, saved

HASH_BITS = 60
#: Bits by which cells lie below the mean bucket, and by which cells over the limit are cut anew.
FINER, STEP = 4, 12


def key_hash(key: str = "doc_id") -> Column:
    digits = F.coalesce(F.col(key).cast("string"), F.lit("null"))
    return F.conv(F.substring(F.md5(digits), 1, HASH_BITS // 4), 16, 10).cast("long")


def _settle(rows: DataFrame, low: int, high: int, limit: int) -> tuple[DataFrame, DataFrame]:
    """(cell, depth, shard, shard_bytes, shard_rows) of the cells of ``high`` bits that fit at a depth from ``low`` on, and the other cells."""
    cells = rows.groupBy(F.shiftright("h", HASH_BITS - high).alias("cell")).agg(F.sum("bytes").alias("b"), F.count("*").alias("n"), F.min("h").alias("lo"), F.max("h").alias("hi"))
    cells = saved(cells, "cells")
    up = cells.withColumn("depth", F.explode(F.sequence(F.lit(low), F.lit(high)))).withColumn("prefix", F.expr(f"shiftright(cell, {high} - depth)"))
    sums = up.groupBy("depth", "prefix").agg(F.sum("b").alias("shard_bytes"), F.sum("n").alias("shard_rows"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    fits = saved(sums.where((F.col("shard_bytes") <= limit) | (F.col("lo") == F.col("hi"))).drop("lo", "hi"), "fits")
    # prefixes so short that none of them fits are no keys of the join: one of them would meet a large part of all cells
    least = fits.agg(F.min("depth")).first()[0]
    first = up.select("cell", "depth", "prefix").where(F.col("depth") >= (high if least is None else least)).join(fits.hint("merge"), ["depth", "prefix"]).groupBy("cell").agg(F.min(F.struct("depth", "prefix", "shard_bytes", "shard_rows")).alias("x"))
    found = saved(first.select("cell", "x.*").withColumn("shard", F.expr(f"shiftleft(prefix, {HASH_BITS} - depth)")).drop("prefix"), "buckets")
    return found, cells.join(found.hint("merge"), "cell", "left_anti").select("cell")


def assign(docs: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """doc_id, bytes, depth (bits of the bucket's prefix), shard (the prefix, shifted to 60 bits), shard_bytes, shard_rows of every row."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("doc_id"), F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("bytes"), key_hash(key).alias("h"))
    rows = saved(rows, "rows")
    total = rows.agg(F.sum("bytes")).first()[0] or 0
    low, high = 0, min(HASH_BITS, FINER + max(0, math.ceil(math.log2(max(1, total / limit)))))
    pending, parts = rows, []
    while True:
        found, over = _settle(pending, low, high, limit)
        cell = F.shiftright("h", HASH_BITS - high)
        parts.append(pending.withColumn("cell", cell).join(found.hint("merge"), "cell").drop("cell", "h"))
        over = saved(over, "over")
        if over.isEmpty():
            break
        pending = saved(pending.withColumn("cell", cell).join(over.hint("merge"), "cell", "left_semi").drop("cell"), "pending")
        low, high = high + 1, min(HASH_BITS, high + STEP)
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.select("doc_id", "bytes", "depth", "shard", "shard_bytes", "shard_rows")


def directory(assigned: DataFrame) -> DataFrame:
    """The directory of ``assign``'s buckets: depth, shard, shard_bytes, shard_rows, and slots: how many entries of a directory
    that is indexed by as many bits as the deepest bucket has point to it. Entries of prefixes that no row has are not listed."""
    buckets = saved(assigned.select("depth", "shard", "shard_bytes", "shard_rows").distinct(), "directory")
    deepest = buckets.agg(F.max("depth")).first()[0] or 0
    return buckets.withColumn("slots", F.expr(f"shiftleft(1L, {deepest} - depth)"))


def write_shards(docs: DataFrame, limit: int, path: str, key: str = "doc_id") -> None:
    """Write ``docs`` as Parquet below ``path``, a folder a shard; rows of a shard go to one task, which its limit bounds."""
    name = "shard"
    while name in (c.lower() for c in docs.columns):
        name += "_"
    where = assign(docs, limit, key).select(F.col("doc_id").alias("key"), F.concat_ws("-", "depth", F.hex("shard")).alias("place")).distinct()
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(key).cast("long").alias("id"))
    rows = rows.join(where.hint("merge"), rows["id"].eqNullSafe(where["key"])).select("row.*", F.col("place").alias(name))
    rows.repartition(name).write.partitionBy(name).parquet(path)

"""Repeated passages by content-defined chunks of a gear rolling hash.

A gear hash rolls over the UTF-8 bytes of each text. A position is a cut where the hash is the least of some window
of ``window`` positions, so cuts depend only on nearby bytes: they fall alike wherever a passage is pasted, an insertion shifts no other chunk, and
no chunk of a text with enough characters is longer than the window. Chunks are deduplicated by a 128-bit digest over
all rows; runs of repeated chunks of at least ``least`` bytes are reported as spans.

A chunk counts as repeated in a row if a row with a smaller doc_id, or an earlier place of the same text, has it.
Any passage shared by two texts of at least ``least + 2 * window + GEAR - 3`` bytes is found.
Defined results: null and empty texts have no spans; a row with a null doc_id comes after all others (among them, in the
order of the table) and its spans have a null doc_id, so ``without_spans`` leaves it whole; rows that repeat a doc_id
keep each other's chunks, are told apart by ``mark``, a hash of the text, and each lose only what is repeated in their own text; texts of any length are read whole; an empty table gives no rows; other columns are not
looked at, and ``without_spans`` returns them as they are, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import prepare, saved

#: Bytes that the rolling hash looks back on; doubling it needs one more pass.
GEAR = 16
WINDOW, LEAST = 80, 80
SPANS = "doc_id long, mark long, start long, end long, bytes long, chunks long, first_doc_id long"

_gear = np.random.default_rng(20240501).integers(0, 1 << 63, 256, np.uint64) << np.uint64(1)


def cut_points(data: bytes, window: int = WINDOW) -> np.ndarray:
    """Increasing chunk starts, from 0, never inside a UTF-8 character."""
    b = np.frombuffer(data, np.uint8)
    if len(b) <= window:
        return np.zeros(min(1, len(b)), np.int64)
    h, span = _gear[b], 1
    while span < GEAR:  # h[i] = sum of gear[b[i - j]] << j for j < span
        more = h.copy()
        more[span:] += h[:-span] << np.uint64(span)
        h, span = more, 2 * span
    keys = (h >> np.uint64(GEAR)) * np.uint64(0x9E3779B97F4A7C15) & np.uint64(0xFFFFFFFF00000000)
    keys[(b & 0xC0) == 0x80] = np.uint64(0xFFFFFFFF00000000)  # inside a character: only if nothing else is there
    keys |= np.arange(len(b), dtype=np.uint64)
    span = 1
    while 2 * span <= window:
        keys, span = np.minimum(keys[:-span], keys[span:]), 2 * span
    if span < window:
        keys = np.minimum(keys[: len(keys) - (window - span)], keys[window - span :])
    at = (keys & np.uint64(0xFFFFFFFF)).astype(np.int64)
    at = at[np.r_[True, at[1:] != at[:-1]]]
    at = at[(b[at] & 0xC0) != 0x80]
    return at if len(at) and at[0] == 0 else np.r_[0, at]


def chunk_table(docs: DataFrame, window: int = WINDOW, unnamed: int | None = None) -> DataFrame:
    """doc_id, mark (a hash of the text), start (byte), size (bytes), digest (two halves) and again (an earlier place of this text has it) of each chunk.

    ``unnamed``: rows with a null doc_id are numbered from there; without it they are left out.
    """
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        h = xxhash.xxh3_128_digest
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                ids, marks, starts, sizes, digests, more, again = [], [], [], [], [], [], []
                for doc, mark, data in zip(*(c.to_pylist() for c in batch.slice(at, 1000).columns), strict=True):
                    cuts = cut_points(data, window)
                    ends = np.r_[cuts[1:], len(data)] if len(cuts) else cuts
                    own = np.frombuffer(b"".join([h(data[s:e]) for s, e in zip(cuts.tolist(), ends.tolist(), strict=True)]), np.int64).reshape(-1, 2)
                    first = np.zeros(len(own), bool)
                    order = np.lexsort((np.arange(len(own)), own[:, 1], own[:, 0]))
                    first[order[np.r_[True, (np.diff(own[order], axis=0) != 0).any(axis=1)][: len(own)]]] = True
                    ids.append(np.full(len(own), doc, np.int64))
                    marks.append(np.full(len(own), mark, np.int64))
                    starts.append(cuts)
                    sizes.append(ends - cuts)
                    digests.append(own[:, 0])
                    more.append(own[:, 1])
                    again.append(~first)
                if ids:
                    cat = np.concatenate
                    yield pa.RecordBatch.from_arrays([pa.array(cat(ids)), pa.array(cat(marks)), pa.array(cat(starts)), pa.array(cat(sizes).astype(np.int32)), pa.array(cat(digests)), pa.array(cat(more)), pa.array(cat(again))],
                                                     names=["doc_id", "mark", "start", "size", "digest", "more", "again"])

    rows = docs.where("text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    if unnamed is not None:  # numbers above all ids stand for null ids
        rows = rows.withColumn("doc_id", F.coalesce("doc_id", F.lit(unnamed) + F.monotonically_increasing_id()))
    return rows.where("doc_id is not null").mapInArrow(run, "doc_id long, mark long, start long, size int, digest long, more long, again boolean")


def _above_ids(docs: DataFrame) -> int | None:
    """The first number above all ids if a row has a null id, else None."""
    ids = docs.agg(F.max(F.col("doc_id").cast("long")), F.count(F.when(F.col("doc_id").isNull(), 1))).first()
    if not ids[1]:
        return None
    if (ids[0] or 0) >= 1 << 62:
        raise ValueError("no numbers are left above the ids for rows without one")
    return (ids[0] if ids[0] is not None else -1) + 1


def repeated_spans(docs: DataFrame, window: int = WINDOW, least: int = LEAST) -> DataFrame:
    """SPANS: maximal runs of repeated chunks; start and end are byte offsets in UTF-8, end exclusive.

    first_doc_id is the smallest doc_id that has the run's longest chunk: it keeps it.
    """
    unnamed = _above_ids(docs)
    table = saved(chunk_table(docs, window, unnamed), "chunks")
    firsts = table.groupBy("digest", "more").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"), F.max("again").alias("again"))
    # written, so that the join deals both sides by itself and adaptive execution may split a digest that very many rows have
    firsts = saved(firsts.where("first < last or again").select("digest", "more", "first"), "firsts")
    hits = table.join(firsts, ["digest", "more"]).where("doc_id > first or again").select("doc_id", "mark", "start", "size", "first")
    order = Window.partitionBy("doc_id", "mark").orderBy("start", "size", "first")
    hits = hits.withColumn("new", (F.col("start") > F.coalesce(F.max(F.col("start") + F.col("size")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))).cast("int"))
    hits = hits.withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    spans = hits.groupBy("doc_id", "mark", "run").agg(F.min("start").alias("start"), F.max(F.col("start") + F.col("size")).alias("end"), F.count("*").alias("chunks"), F.max_by("first", F.struct("size", -F.col("start"))).alias("first_doc_id"))
    spans = spans.where(F.col("end") - F.col("start") >= least)
    name = lambda c: F.col(c) if unnamed is None else F.when(F.col(c) < unnamed, F.col(c)).alias(c)
    return spans.select(name("doc_id"), "mark", "start", "end", (F.col("end") - F.col("start")).alias("bytes"), "chunks", name("first_doc_id"))


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with the bytes of ``spans`` taken out of their texts."""
    lists = spans.where("doc_id is not null").groupBy(F.col("doc_id").alias("key"), "mark").agg(F.array_sort(F.collect_set(F.struct("start", "end"))).alias("cuts"))
    # a row travels as one struct, so no name of its columns can clash with what is beside it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("key"), F.xxhash64("text").alias("mark")).join(lists, ["key", "mark"], "left")
    raw = F.col("row.text").cast("binary")
    begins = F.concat(F.array(F.lit(0).cast("long")), F.transform("cuts", lambda s: s["end"]))
    ends = F.concat(F.transform("cuts", lambda s: s["start"]), F.array(F.octet_length("row.text").cast("long")))
    kept = F.transform(F.arrays_zip(begins.alias("b"), ends.alias("e")), lambda x: F.substring(raw, (x["b"] + 1).cast("int"), (x["e"] - x["b"]).cast("int")).cast("string"))
    text = F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(F.array_join(kept, ""))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])

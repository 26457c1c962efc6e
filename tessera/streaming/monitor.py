"""Structured Streaming: tailing new documents, windowed rates, trailing error counts and the adaptive budget.

Streams read through the file source with a checkpoint, so every file is handled once; ``availableNow`` drains what is
there and stops. Event time needs a TIMESTAMP column: cast a TIMESTAMP_NTZ one first.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def tail(spark: SparkSession, path: str, schema: str, fmt: str = "json", files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema).format(fmt)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def drain(df: DataFrame, checkpoint: str, handle: Callable[[DataFrame, int], None] | None = None, path: str | None = None, mode: str = "append"):
    """Run a stream over what is available, to a handler of micro-batches or to Parquet, and wait for it."""
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    query = writer.foreachBatch(handle).start() if handle else writer.format("parquet").start(path)
    query.awaitTermination()
    return query


def route(batch: DataFrame, status: str, paths: dict[str, str]) -> None:
    """Append the rows of each status (accept, audit, redo, ...) to its folder: one pass over the cached batch."""
    batch.persist()
    try:
        for value, path in paths.items():
            batch.where(F.col(status) == value).write.mode("append").json(path)
    finally:
        batch.unpersist()


def rates(events: DataFrame, ts: str, width: str = "15 seconds", late: str | None = "1 minute", kinds: dict[str, str] | None = None) -> DataFrame:
    """window_start, n and a count for each named condition in tumbling windows; on a stream, late rows are dropped by watermark."""
    rows = events.withWatermark(ts, late) if events.isStreaming and late else events
    counts = [F.count(F.when(F.expr(cond), 1)).alias(name) for name, cond in (kinds or {}).items()]
    return rows.groupBy(F.window(ts, width).alias("w")).agg(F.count("*").alias("n"), *counts).select(F.col("w.start").alias("window_start"), "n", *(kinds or {}))


def sliding(events: DataFrame, ts: str, width: str = "300 seconds", slide: str = "60 seconds", late: str = "10 minutes") -> DataFrame:
    rows = events.withWatermark(ts, late) if events.isStreaming else events
    return rows.groupBy(F.window(ts, width, slide).alias("w")).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "n")


def trailing_counts(events: DataFrame, micros: str, group: list[str], seconds: int, name: str = "n_trailing") -> DataFrame:
    """``events`` with the number of the group's events in the ``seconds`` up to each (both ends included): an exact range frame.

    Time is cut into spans as long as the frame. An event's frame reaches back into one earlier span only, so each span's
    window holds its own events and those of the span before: a busy group is dealt over time, not sorted in one task.
    """
    frame = seconds * 1_000_000
    span = F.floor(F.col(micros) / frame)
    dealt = events.withColumn("__span", F.explode(F.array(span, span + 1))).withColumn("__own", F.col("__span") == span)
    w = Window.partitionBy(*group, "__span").orderBy(micros).rangeBetween(-frame, 0)
    return dealt.withColumn(name, F.count("*").over(w)).where("__own").drop("__span", "__own")


def budget_steps(events: DataFrame, group: str, order: str, ok: str, start: int = 8, least: int = 1, most: int = 16, gain_after: int = 3) -> DataFrame:
    """group, final_budget, least_budget, n: a concurrency budget that rises by one after ``gain_after`` successes in a row and falls by one at a failure.

    A fold in event order over one group's ordered outcomes, all in one row: a group is one limiter's log of a period, which
    the period bounds. For endless logs use ``budget_stream``, which keeps two numbers a group.
    """
    outcomes = F.transform(F.array_sort(F.collect_list(F.struct(order, ok))), lambda x: x[ok])
    state = F.struct(F.lit(start).alias("b"), F.lit(0).alias("run"), F.lit(start).alias("low"), F.lit(0).alias("n"))

    def step(s, good):
        gain = good & (s["run"] + 1 >= gain_after)
        b = F.when(gain, F.least(F.lit(most), s["b"] + 1)).when(good, s["b"]).otherwise(F.greatest(F.lit(least), s["b"] - 1))
        run = F.when(~good | gain, F.lit(0)).otherwise(s["run"] + 1)
        return F.struct(b.alias("b"), run.alias("run"), F.least(s["low"], b).alias("low"), (s["n"] + 1).alias("n"))

    folded = events.groupBy(group).agg(F.aggregate(outcomes, state, step).alias("s"))
    return folded.select(group, F.col("s.b").alias("final_budget"), F.col("s.low").alias("least_budget"), F.col("s.n").cast("long").alias("n"))


# The least budget by hour of the day (UTC+8): heavy from 14 to 18, lighter from 11 and until 21.
HEAVY_HOURS, LIGHT_HOURS, FLOORS = (14, 18), (11, 21), (1, 3, 5)


def hour_floor(ts: Column) -> Column:
    """The least concurrency budget at a time (UTC)."""
    hour = F.pmod(F.hour(ts) + 8, F.lit(24))
    return F.when((hour >= HEAVY_HOURS[0]) & (hour < HEAVY_HOURS[1]), FLOORS[0]).when((hour >= LIGHT_HOURS[0]) & (hour < LIGHT_HOURS[1]), FLOORS[1]).otherwise(FLOORS[2])


def budget_by_hour(events: DataFrame, group: str, order: str, ok: str, ts: str, start: int = 8, most: int = 8, gain_after: int = 3, weight: int = 1) -> DataFrame:
    """group, final_budget, slots, n: as ``budget_steps``, but a failure never takes the budget below the floor of its hour, a later hour's higher
    floor lifts it, and it rises to ``most`` at most. slots: calls at a time if each takes ``weight`` places.

    A group is one limiter's log of a period, which the period bounds; for endless logs use ``budget_stream``.
    """
    steps = F.array_sort(F.collect_list(F.struct(order, ok, hour_floor(F.col(ts)).alias("floor"))))
    state = F.struct(F.lit(start).alias("b"), F.lit(0).alias("run"), F.lit(0).alias("n"))

    def step(s, x):
        b = F.greatest(s["b"], x["floor"])  # the floor of the hour comes first
        gain = x[ok] & (s["run"] + 1 >= gain_after)
        after = F.when(gain, F.least(F.greatest(F.lit(most), b), b + 1)).when(x[ok], b).otherwise(F.greatest(x["floor"], b - 1))
        return F.struct(after.alias("b"), F.when(~x[ok] | gain, F.lit(0)).otherwise(s["run"] + 1).alias("run"), (s["n"] + 1).alias("n"))

    folded = events.groupBy(group).agg(F.aggregate(steps, state, step).alias("s"))
    return folded.select(group, F.col("s.b").alias("final_budget"), F.greatest(F.lit(1), F.floor(F.col("s.b") / weight)).cast("int").alias("slots"), F.col("s.n").cast("long").alias("n"))


def budget_stream(events: DataFrame, group: str, order: str, ok: str, start: int = 8, least: int = 1, most: int = 16, gain_after: int = 3) -> DataFrame:
    """The same fold on a stream: state (budget, run) by group, one row a group and micro-batch."""

    def step(key: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        budget, run = state.get if state.exists else (start, 0)
        rows = pd.concat(list(batches)).sort_values(order)
        for good in rows[ok]:
            if not good:
                budget, run = max(least, budget - 1), 0
            elif run + 1 >= gain_after:
                budget, run = min(most, budget + 1), 0
            else:
                run += 1
        state.update((int(budget), int(run)))
        yield pd.DataFrame({group: [key[0]], "budget": [int(budget)]})

    kind = events.schema[group].dataType.simpleString()
    return events.groupBy(group).applyInPandasWithState(step, f"{group} {kind}, budget int", "budget int, run int", "update", "NoTimeout")

"""The state of work items in a stream of their outcomes: deferred retries, quarantine and idle sources, by keyed state with timers.

    outcomes = spark.readStream ... .withWatermark("ts", "1 minute")
    follow(outcomes).writeStream ...

An outcome (key, outcome, ts) is ``ok``, ``error`` or ``quota``. An error counts as an attempt: the item is due again after a delay that doubles with each, and is
quarantined after ``attempts`` of them. A quota answer counts as none: the item is due again after ``cooldown``. Success ends an item; nothing about it
is kept. An item that is due and of which nothing is heard for ``idle`` is reported once as idle and forgotten. Timers run on event time, so they are as the
watermark says, and a query that is started again goes on where its checkpoint ends: an item is reported once, whatever was lost in between.

Each decision is a row (key, action, attempt, at): ``done``, ``retry``, ``quarantined`` or ``idle``. State is one small row a pending item, in RocksDB
(``settings``); it is dealt out by key and not bounded by memory.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

ACTIONS = "key string, action string, attempt int, at timestamp"
ATTEMPTS, DELAY_MS, COOLDOWN_MS, IDLE_MS = 3, 60_000, 600_000, 3_600_000


def settings(spark: SparkSession) -> None:
    """What keyed state with timers needs: the RocksDB state store."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")


class Worklist(StatefulProcessor):
    def __init__(self, attempts: int = ATTEMPTS, delay_ms: int = DELAY_MS, cooldown_ms: int = COOLDOWN_MS, idle_ms: int = IDLE_MS) -> None:
        self.attempts, self.delay, self.cooldown, self.idle = attempts, delay_ms, cooldown_ms, idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # attempts so far; when the item is due again (ms), or null while it is awaited; when it is given up as idle
        self.item = handle.getValueState("item", "attempts int, due long, idle long")

    def _timers(self, *at: int) -> None:
        for old in list(self.handle.listTimers()):
            self.handle.deleteTimer(old)
        for t in at:
            self.handle.registerTimer(t)

    def handleInputRows(self, key: tuple, rows: Iterator[pd.DataFrame], timerValues: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        seen = pd.concat([r[["outcome", "ts"]] for r in rows]).sort_values(["ts", "outcome"], kind="stable")  # of one item: as many as it had tries
        count, due = 0, None
        if self.item.exists():
            count, due, _ = self.item.get()
        out, ended = [], False
        for outcome, ts in zip(seen["outcome"], seen["ts"], strict=True):
            at = int(ts.timestamp() * 1000)
            ended = False
            if outcome == "ok":
                out.append((key[0], "done", count + 1, ts))
                count, due, ended = 0, None, True
            elif outcome == "quota":
                due = at + self.cooldown
            else:
                count += 1
                if count >= self.attempts:
                    out.append((key[0], "quarantined", count, ts))
                    count, due, ended = 0, None, True
                else:
                    due = at + self.delay * 2 ** (count - 1)
            last = at
        if ended:
            self.item.clear()
            self._timers()
        else:
            idle = max(last, due or last) + self.idle
            self.item.update((count, due, idle))
            self._timers(*([due] if due is not None else []), idle)
        yield pd.DataFrame(out, columns=["key", "action", "attempt", "at"])

    def handleExpiredTimer(self, key: tuple, timerValues: object, expiredTimerInfo: object) -> Iterator[pd.DataFrame]:  # noqa: N802, N803
        out = []
        if self.item.exists():
            count, due, idle = self.item.get()
            now = expiredTimerInfo.getExpiryTimeInMs()
            when = pd.Timestamp(now, unit="ms")
            if due is not None and now == due:
                out.append((key[0], "retry", count + 1, when))
                self.item.update((count, None, idle))
            elif now == idle:
                out.append((key[0], "idle", count, when))
                self.item.clear()
        yield pd.DataFrame(out, columns=["key", "action", "attempt", "at"])

    def close(self) -> None:
        pass


def follow(outcomes: DataFrame, attempts: int = ATTEMPTS, delay_ms: int = DELAY_MS, cooldown_ms: int = COOLDOWN_MS, idle_ms: int = IDLE_MS) -> DataFrame:
    """The actions of a stream of outcomes (key, outcome, ts) with a watermark on ts."""
    processor = Worklist(attempts, delay_ms, cooldown_ms, idle_ms)
    return outcomes.groupBy("key").transformWithStateInPandas(statefulProcessor=processor, outputStructType=ACTIONS, outputMode="Append", timeMode="EventTime")

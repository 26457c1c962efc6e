"""Work items through batches of a stream, with a restart in the middle."""

from __future__ import annotations

import json

import pytest

from tessera.streaming import worklist


@pytest.fixture
def stream(spark, tmp_path):
    worklist.settings(spark)
    spark.conf.set("spark.sql.shuffle.partitions", "2")
    (tmp_path / "in").mkdir()

    def run(*rows: tuple[str, str, str]) -> list[tuple]:
        """The actions that one more file of outcomes leads to."""
        n = len(list((tmp_path / "in").iterdir()))
        (tmp_path / "in" / f"{n:03d}.json").write_text("\n".join(json.dumps({"key": k, "outcome": o, "ts": f"2024-01-01 {t}"}) for k, o, t in rows))
        outcomes = spark.readStream.schema("key string, outcome string, ts timestamp").json(f"{tmp_path}/in").withWatermark("ts", "0 seconds")
        found = worklist.follow(outcomes, attempts=3, delay_ms=60_000, cooldown_ms=300_000, idle_ms=3_600_000)
        before = read()
        query = found.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/check").trigger(availableNow=True).start()
        query.awaitTermination(120)
        assert query.exception() is None
        now = read()
        return [x for x in now if x not in before]

    def read() -> list[tuple]:
        if not (tmp_path / "out").exists():
            return []
        return sorted((r["key"], r["action"], r["attempt"], r["at"].strftime("%H:%M:%S")) for r in spark.read.schema(worklist.ACTIONS).parquet(f"{tmp_path}/out").collect())

    yield run
    spark.conf.set("spark.sql.shuffle.partitions", "4")
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def test_retries_quarantine_and_idle_items(stream):
    assert stream(("a", "ok", "00:00:00"), ("b", "error", "00:00:00"), ("c", "quota", "00:00:00"), ("d", "error", "00:00:00"), ("d", "error", "00:00:01"), ("d", "error", "00:00:02")) == [("a", "done", 1, "00:00:00"), ("d", "quarantined", 3, "00:00:02")]
    # each run is a start from the checkpoint; timers fire when the watermark has passed them
    assert stream(("x", "ok", "00:02:00")) == [("b", "retry", 2, "00:01:00"), ("x", "done", 1, "00:02:00")]
    assert stream(("b", "error", "00:02:30"), ("x", "ok", "00:06:00")) == [("b", "retry", 3, "00:04:30"), ("c", "retry", 1, "00:05:00"), ("x", "done", 1, "00:06:00")]
    assert stream(("c", "ok", "00:06:10"), ("x", "ok", "02:00:00")) == [("b", "idle", 2, "01:04:30"), ("c", "done", 1, "00:06:10"), ("x", "done", 1, "02:00:00")]
    assert stream(("x", "ok", "03:00:00")) == [("x", "done", 1, "03:00:00")]  # nothing is kept of what is done, given up or idle

"""Session builder with the settings that the operators are planned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def session(name: str = "tessera", master: str | None = None, **conf: str) -> SparkSession:
    """AQE with skew splitting and coalescing, UTC, Arrow; ``conf`` keys use underscores for dots."""
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    }
    for k, v in (settings | {k.replace("_", "."): v for k, v in conf.items()}).items():
        builder = builder.config(k, v)
    return builder.getOrCreate()

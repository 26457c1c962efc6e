"""Relations stored by key: bucketed and sorted tables that are joined and grouped without moving a row, with filters for point reads.

    store(tables, "fbgn", path, buckets=256, blooms={"citations": ["value", "pmid"]})
    tables = attach(spark, path)

All tables that have the key are dealt into the same buckets by it and sorted in each, so joins on it and groupings by it read the buckets side
by side: the plan has no exchange. A filter on the key reads one bucket, and in its file the row groups whose range holds the key; a filter on another
column with a Bloom filter skips the row groups that do not hold the value. The layout is kept in a file beside the tables, so another session
can attach them. The number of buckets is fixed when they are written: about 1 GB of the largest table a bucket is a good size.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of a row group: small ones let a point read skip more.
ROW_GROUP = 8 << 20


def _bloom_options(columns: list[str], most: int) -> dict[str, str]:
    options = {}
    for c in columns:
        options |= {f"parquet.bloom.filter.enabled#{c}": "true", f"parquet.bloom.filter.expected.ndv#{c}": str(most)}
    return options


def store(tables: dict[str, DataFrame], key: str, path: str, buckets: int = 64, blooms: dict[str, list[str]] | None = None, row_group: int = ROW_GROUP, distinct: int = 100_000) -> None:
    """Write the tables below ``path``. Those with a column ``key`` are bucketed and sorted by it; ``blooms`` names columns with a Bloom filter for
    about ``distinct`` values a row group. Tables without the key are written as they are."""
    layout = {}
    for name, df in tables.items():
        keyed = key in df.columns
        options = {"parquet.block.size": str(row_group)} | _bloom_options((blooms or {}).get(name, []), distinct)
        layout[name] = {"schema": df.schema.jsonValue(), "buckets": buckets if keyed else 0}
        if not keyed:
            df.write.mode("overwrite").options(**options).parquet(f"{path}/{name}")
            continue
        # dealt first, so each bucket is one sorted file
        rows = df.repartition(buckets, key).sortWithinPartitions(key)
        scratch = f"tessera_{uuid.uuid4().hex}"
        rows.write.mode("overwrite").format("parquet").options(path=f"{path}/{name}", **options).bucketBy(buckets, key).sortBy(key).saveAsTable(scratch)
        df.sparkSession.sql(f"DROP TABLE {scratch}")  # its files stay: the path is its own
    spark = next(iter(tables.values())).sparkSession
    spark.createDataFrame([(json.dumps({"key": key, "tables": layout}),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/layout.txt")


def attach(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables that ``store`` wrote below ``path``, with their buckets, under names of their own in the session's catalog."""
    from pyspark.sql.types import StructType

    layout = json.loads(spark.read.text(f"{path}/layout.txt").first()["value"])
    out = {}
    for name, own in layout["tables"].items():
        schema = StructType.fromJson(own["schema"])
        if not own["buckets"]:
            out[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
            continue
        table, quote = f"tessera_{uuid.uuid4().hex}", "`{}`".format
        columns = ", ".join(f"{quote(f.name)} {f.dataType.simpleString()}" for f in schema)
        place = f"{path}/{name}".replace("'", "\\'")
        spark.sql(f"CREATE TABLE {table} ({columns}) USING parquet CLUSTERED BY ({quote(layout['key'])}) SORTED BY ({quote(layout['key'])}) INTO {own['buckets']} BUCKETS LOCATION '{place}'")
        out[name] = spark.table(table)
    return out


def point(table: DataFrame, column: str, values: list) -> DataFrame:
    """The rows with one of a few values of a column: literals that reach the scan, its buckets, row groups and Bloom filters."""
    return table.where(F.col(column) == values[0]) if len(values) == 1 else table.where(F.col(column).isin(values))

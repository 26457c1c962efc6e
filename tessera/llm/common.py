"""Helpers shared by the corpus operators: shared storage, lineage cuts, shipping of the package, components."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: The characters that separate words: space and the five ASCII controls from tab to carriage return.
ASCII_SPACE = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


#: Folders made since the session began, and those of open ``scratch`` blocks.
_made: list[str] = []
_shipped: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Send this package to the Python workers, once an application, as a zip that Spark hands out."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    held = tempfile.NamedTemporaryFile(prefix="tessera-", suffix=".zip", delete=False)  # of the driver only: Spark copies it
    with zipfile.ZipFile(held, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, str(f.relative_to(package.parent)))
    held.close()
    sc.addPyFile(held.name)
    _shipped.add(sc.applicationId)


def prepare(spark: SparkSession) -> str:
    """Send this package to the workers and return the folder that driver and executors share.

    The folder is the session's ``spark.checkpoint.dir``. Only where that is unset and all tasks run on this machine,
    as in tests, is a folder of this machine used instead.
    """
    _ship(spark)
    env = spark.sparkContext.environment
    # workers give freed memory back
    for name, value in (("ARROW_DEFAULT_MEMORY_POOL", "system"), ("MALLOC_ARENA_MAX", "2"), ("MALLOC_TRIM_THRESHOLD_", "4194304"), ("MALLOC_MMAP_THRESHOLD_", "4194304")):
        env.setdefault(name, value)
    # rows hold whole texts: smaller Arrow batches than for narrow rows, unless the session asks for other sizes
    for name, default, value in (("maxRecordsPerBatch", "10000", "2000"), ("maxBytesPerBatch", "67108864b", "2m")):
        if spark.conf.get(f"spark.sql.execution.arrow.{name}") == default:
            spark.conf.set(f"spark.sql.execution.arrow.{name}", value)
    shared = spark.conf.get("spark.checkpoint.dir", None)
    jsc = spark.sparkContext._jsc.sc()
    if not shared and jsc.getCheckpointDir().isDefined():
        shared = jsc.getCheckpointDir().get()
    if not shared:
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = "file://" + tempfile.mkdtemp(prefix="tessera-")
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(shared)
    return shared.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder. What is written there goes with ``scratch`` or ``clean_up``."""
    path = f"{prepare(spark)}/{name}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def saved(df: DataFrame, name: str = "table") -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage is cut and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def clean_up(spark: SparkSession, since: int = 0) -> None:
    """Remove the intermediate folders made after the first ``since``. Results that were not yet read need them."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    while len(_made) > since:
        path = jvm.org.apache.hadoop.fs.Path(_made.pop())
        path.getFileSystem(conf).delete(path, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Intermediate folders made inside go at the end: write what is to stay, with ``keep``, before it."""
    since = len(_made)
    try:
        yield
    finally:
        clean_up(spark, since)


def keep(df: DataFrame, name: str, path: str) -> DataFrame:
    """``saved`` to a path of its own, which no ``scratch`` removes."""
    df.write.parquet(f"{path}/{name}")
    return df.sparkSession.read.schema(df.schema).parquet(f"{path}/{name}")


def parts(spark: SparkSession, rows: int, per_task: int) -> int:
    """Number of tasks for ``rows`` small rows: it grows with the rows, and small tables still use all cores."""
    return max(int(spark.sparkContext.defaultParallelism), -(-rows // per_task))


#: Bits of a sieve: 8 MB, however many keys it holds.
SIEVE_BITS = 1 << 26


def sieve(hashes: DataFrame, column: str) -> Broadcast:
    """A bitmap of fixed size that has a bit for every one of the uniform long ``column``. It spares a join rows that have no partner; the join decides.

    Its words are made by grouped aggregation; at most 2**20 of them reach the driver.
    """
    h = F.col(column).bitwiseAND(SIEVE_BITS - 1).alias("h")
    words = hashes.select(h).select(F.shiftright("h", 6).cast("int").alias("w"), F.expr("shiftleft(1L, cast(h & 63 AS int))").alias("b")).groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
    bits = np.zeros(SIEVE_BITS // 64, np.int64)
    bits[words.column("w").to_numpy()] = words.column("b").to_numpy()
    return hashes.sparkSession.sparkContext.broadcast(bits)


def passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Whether each of ``hashes`` may be one of the sieve's."""
    h = hashes & (SIEVE_BITS - 1)
    return (bits[h >> 6] >> (h & 63)) & 1 == 1


def sifted(rows: DataFrame, column: str, through: Broadcast) -> DataFrame:
    """The ``rows`` whose uniform long ``column`` passes the sieve."""
    import pyarrow as pa

    def run(batches):  # noqa: ANN001, ANN202
        for b in batches:
            for at in range(0, b.num_rows, 1000):
                some = b.slice(at, 1000)
                some = some.filter(pa.array(passes(through.value, some.column(column).to_numpy(zero_copy_only=False))))
                if some.num_rows:
                    yield some

    return rows.mapInArrow(run, rows.schema)


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """Connected components by alternating large-star and small-star rounds.

    ``edges`` holds pairs of long ids in any order; self-loops, repeats and nulls are ignored. Returns one row
    (node, root) for each node that has an edge; root is the smallest id of its component. Every round is a pair
    of grouped minima and joins whose large keys adaptive execution may split; no round gathers edges in one task
    or on the driver. A round's edges are written to the shared folder, so a lost executor repeats one round.
    """
    e = edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u > v").distinct()
    e = saved(e, "cc")
    files = parts(edges.sparkSession, e.count(), 100_000)  # no round has more edges, so a few files hold those of a small table

    def kept(rows: DataFrame) -> DataFrame:
        return saved(rows.coalesce(files), "cc")

    mark = None
    for _ in range(max_rounds):
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # minima are written: so joined, both sides are dealt anew and adaptive execution may split a node of very many edges
        low = kept(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v").distinct()
        large = kept(large)
        low = kept(large.groupBy("u").agg(F.min("v").alias("m")))
        small = large.join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u > v")
        e = kept(small.unionByName(low.select("u", F.col("m").alias("v"))).distinct())
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == mark:
            break
        mark = now
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    roots = e.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("root"))
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)

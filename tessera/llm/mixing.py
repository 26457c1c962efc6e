"""Mixing sources to target weights by Sainte-Lague apportionment.

A source's target is its weight's share of the mix, stopped at ``ceiling`` times its size, the excess reshared. The mix
is allocated in blocks of equal length: the house has as many seats as blocks fit in all targets, and seats go to
sources by the highest quotients target / (2n - 1). A source's seats go to its shards by the same rule, with their
words as weights, which gives integer quotas. A shard's documents, in seeded order, form the stream that is cut into
blocks; the quota takes whole passes and then the stream's first blocks.

Seats are not dealt one by one: the n-th seat of weight w is taken if w / (2n - 1) is at least half of a divisor, so the
divisor is narrowed down by grouped sums, many candidates at once, until the seats it gives can differ in a few only;
those few are ranked by their quotients. Every step is an aggregation of a narrow table; no group is gathered in a task.

Defined results: a null text has size zero and is never taken; a null source is the last one; repeated rows count as
often as they occur, and are taken alike up to order; texts of any length are counted whole; an empty table gives no
rows. Nothing depends on partitioning, but for which rows are taken among several without an id. Other columns are not
looked at, and ``apply_mix`` returns them as they are, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import WORD, prepare, saved

WEIGHTS = (3.0, 1.0, 2.0)
SHARD_ROWS = 2000
#: Words of a block at most, and blocks of the smallest target at least: for it, blocks of all sources get shorter.
BLOCK, BLOCKS = 256, 512
#: Divisors tried at once, and times that they are narrowed down at most.
DIVISORS, ROUNDS = 48, 8


def word_count(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def ranks(df: DataFrame, order: list[Column], name: str) -> DataFrame:
    """``df`` (written) with the place of each row, from 0: sorted by ranges, so no task sorts all of it."""
    # per partition of the written table: its rows follow each other, and partitions are counted
    pid, at = f"{name}_part", f"{name}_at"
    sorted_ = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn(pid, F.spark_partition_id()).withColumn(at, F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33))
    sorted_ = saved(sorted_, "ranks")
    before, total = [], 0
    for part, n in sorted(tuple(r) for r in sorted_.groupBy(pid).count().collect()):  # a row a partition
        before.append((part, total))
        total += n
    starts = df.sparkSession.createDataFrame(before, f"{pid} int, {name}_before long")
    return sorted_.join(F.broadcast(starts), pid).withColumn(name, F.col(at) + F.col(f"{name}_before")).drop(pid, at, f"{name}_before")  # starts: a row a partition


def targets(sizes: DataFrame, share: float = 1.5, ceiling: float = 2.0, weights: tuple[float, ...] = WEIGHTS) -> DataFrame:
    """``sizes`` (source, source_size, ...; a row per source) with target.

    Sources in code-point order (null last) weigh ``weights``, repeating. A source once stopped at its ceiling stays
    stopped, so each pass over the table of sources stops at least one or is the last.
    """
    ranked = ranks(sizes, [F.col("source").asc_nulls_last()], "__k")
    weight = F.get(F.array(*[F.lit(float(w)) for w in weights]), F.pmod("__k", F.lit(len(weights))).cast("int"))
    table = saved(ranked.select("*", weight.alias("__w"), (F.lit(float(ceiling)) * F.col("source_size")).alias("__max")), "targets")
    total = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    rate, stopped = 0.0, -1
    while True:
        over = (F.col("__w") * F.lit(rate) > F.col("__max")) if stopped >= 0 else F.lit(False)
        n, filled, weighing = table.agg(
            F.count(F.when(over, 1)), F.coalesce(F.sum(F.when(over, F.col("__max"))), F.lit(0.0)), F.coalesce(F.sum(F.when(~over, F.col("__w"))), F.lit(0.0))
        ).first()
        if n == stopped or not weighing:
            break
        stopped, rate = n, (total - filled) / weighing
    amount = F.when(F.lit(bool(weighing)) & (F.col("__w") * F.lit(rate) <= F.col("__max")), F.col("__w") * F.lit(rate)).otherwise(F.col("__max"))
    return table.select(*sizes.columns, amount.alias("target"))


def _seats(weight: Column, divisor: Column, cap: Column) -> Column:
    """Seats that a divisor gives to a weight: those whose quotient is at least half of it, ``cap`` at most."""
    return F.least(cap, F.floor(weight / divisor + 0.5).cast("long"))


def apportion(rows: DataFrame, by: str, key: str, houses: DataFrame) -> DataFrame:
    """``rows`` (by, key, weight double, cap long; written) with ``seats``: in each group ``by``, the house's seats (``houses``: by, house)
    go to the highest quotients weight / (2n - 1), a row taking ``cap`` of them at most; ties go to the smaller key.

    A group whose caps do not fill its house gets all of them; rows without weight get none.
    """
    w, cap = F.col("weight"), F.col("cap")
    live = rows.where((w > 0) & (cap > 0))
    found = live.groupBy(by).agg(F.sum(w).alias("w"), F.count("*").alias("m"), F.max(w).alias("top"), F.min(w / (cap + 0.5)).alias("full"), F.sum("cap").alias("caps"))
    found = found.join(houses, by).withColumn("house", F.least("house", "caps"))
    # at ``high`` the sum of seats is the house or less, at ``low`` it is the house or more
    some = F.col("house") > F.col("m") / 2
    high = F.least(F.when(some, F.col("w") / (F.col("house") - F.col("m") / 2)).otherwise(F.col("top") * 2.01), F.col("top") * 2.01)
    low = F.least(F.col("w") / (F.col("house") + F.col("m") / 2), F.col("full"))
    bracket = saved(found.select(by, "house", (low * (1 - 1e-9)).alias("low"), (high * (1 + 1e-9)).alias("high")), "bracket")
    edge = lambda j: F.col("low") + (F.col("high") - F.col("low")) * (j / F.lit(float(DIVISORS)))
    group = [by, "house", "low", "high"]
    for _ in range(ROUNDS):
        tried = live.join(bracket.select(group), by).withColumn("j", F.explode(F.sequence(F.lit(0), F.lit(DIVISORS))))
        sums = tried.groupBy(*group, "j").agg(F.sum(_seats(w, edge(F.col("j")), cap)).alias("s"))
        # the last divisor that still gives the house or more, and the first that gives no more than it
        over = F.max(F.when((F.col("s") >= F.col("house")) & (F.col("j") < DIVISORS), F.struct("j", "s"))).alias("over")
        under = F.min(F.when((F.col("s") <= F.col("house")) & (F.col("j") > 0), F.struct("j", "s"))).alias("under")
        found = sums.groupBy(*group).agg(over, under, F.max(F.when(F.col("j") == DIVISORS, F.col("s"))).alias("last"))
        under_j, over_j = F.coalesce("under.j", F.lit(DIVISORS)), F.coalesce("over.j", F.lit(0))
        given = F.coalesce("under.s", "last")
        found = found.select(by, "house", edge(F.least(over_j, under_j)).alias("low"), edge(under_j).alias("high"), given.alias("given"), F.greatest(F.coalesce("over.s", given), given).alias("loose"))
        bracket = saved(found, "bracket")
        if bracket.where((F.col("given") < F.col("house")) & (F.col("loose") > F.col("house") + 8)).isEmpty():
            break
    joined = live.join(bracket, by).withColumn("seats", _seats(w, F.col("high"), cap)).withColumn("more", _seats(w, F.col("low"), cap))
    joined = saved(joined, "seats")
    # seats between the two divisors, a few in each group but for ties, are ranked by quotient
    open_ = joined.where((F.col("more") > F.col("seats")) & (F.col("given") < F.col("house"))).withColumn("n", F.explode(F.sequence(F.col("seats") + 1, F.col("more"))))
    order = Window.partitionBy(by).orderBy(F.desc(F.col("weight") / (2 * F.col("n") - 1)), key)
    taken = open_.withColumn("place", F.row_number().over(order)).where(F.col("place") <= F.col("house") - F.col("given")).groupBy(by, key).agg(F.count("*").alias("extra"))
    done = joined.select(by, key, "seats").join(taken, [by, key], "left").select(by, key, (F.col("seats") + F.coalesce("extra", F.lit(0))).alias("seats"))
    return rows.join(done, [by, key], "left").withColumn("seats", F.coalesce("seats", F.lit(0)))


def block_length(table: DataFrame) -> tuple[int, int]:
    """(words of a block, seats of the house) for a table of sources with their targets."""
    least, total = table.where("target > 0").agg(F.min("target"), F.sum("target")).first()
    block = max(1, min(BLOCK, int((least or 0) / BLOCKS)))
    return block, int((total or 0) / block + 0.5)


def mix(docs: DataFrame, share: float = 1.5, ceiling: float = 2.0, weights: tuple[float, ...] = WEIGHTS, seed: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """doc_id, size, source_size, target, taken (words the mix takes of the row, repeats counted) for every row."""
    return decisions(docs, share, ceiling, weights, seed, shard_rows).select("doc_id", "size", "source_size", "target", "taken")


def _places(docs: DataFrame, seed: int) -> DataFrame:
    """doc_id, mark (a hash of the text), name (of the source; it tells null from all others), size and h, the seeded place, of each row."""
    name = F.when(F.col("source").isNotNull(), F.concat(F.lit("s"), F.col("source").cast("string"))).otherwise(F.lit(""))
    # the place comes from id and text; rows without an id are told apart by where they stand
    place = F.struct(F.lit(seed), F.col("doc_id").cast("long"), F.xxhash64("text"), F.when(F.col("doc_id").isNull(), F.monotonically_increasing_id()))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), name.alias("name"), word_count().alias("size"), F.xxhash64(place).alias("h"))


def decisions(docs: DataFrame, share: float = 1.5, ceiling: float = 2.0, weights: tuple[float, ...] = WEIGHTS, seed: int = 20, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The columns of ``mix`` and mark (a hash of the text)."""
    prepare(docs.sparkSession)
    rows = saved(_places(docs, seed), "sizes")
    sums = rows.groupBy("name").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = targets(sums.withColumn("source", F.when(F.col("name") != "", F.substring("name", 2, 1 << 30))), share, ceiling, weights)
    sources = saved(sources.withColumn("shards", F.ceil(F.col("n") / shard_rows)).drop("source", "n"), "sources")
    block, house = block_length(sources)
    own = saved(sources.select("name", F.lit(0).alias("all"), F.col("target").alias("weight"), F.ceil(F.lit(float(ceiling)) * F.col("source_size") / block).alias("cap")), "own")
    seats = apportion(own, "all", "name", docs.sparkSession.createDataFrame([(0, house)], "all int, house long")).select("name", F.col("seats").alias("house"))
    seats = saved(seats, "seats")
    wide = rows.join(sources, "name").withColumn("shard", F.pmod(F.xxhash64(F.lit(seed + 1), "h"), F.col("shards")))
    shards = wide.groupBy("name", "shard").agg(F.sum("size").alias("words"))
    shards = shards.select("name", "shard", "words", F.ceil(F.col("words") / block).alias("blocks"), F.col("words").cast("double").alias("weight"), F.floor(F.lit(float(ceiling)) * F.ceil(F.col("words") / block)).alias("cap"))
    quotas = saved(apportion(saved(shards, "shards"), "name", "shard", seats).select("name", "shard", "blocks", F.col("seats").alias("quota")), "quotas")
    wide = wide.join(quotas, ["name", "shard"])
    stream = Window.partitionBy("name", "shard").orderBy("h", "doc_id", "size").rowsBetween(Window.unboundedPreceding, 0)
    wide = wide.withColumn("before", F.sum("size").over(stream) - F.col("size"))
    wide = wide.withColumn("passes", F.when(F.col("blocks") > 0, F.floor(F.col("quota") / F.col("blocks"))).otherwise(F.lit(0)))
    rest = (F.col("quota") - F.col("passes") * F.col("blocks")) * block - F.col("before")
    taken = F.col("passes") * F.col("size") + F.greatest(F.lit(0), F.least(rest, F.col("size")))
    return wide.select("doc_id", "mark", "size", "source_size", "target", taken.cast("long").alias("taken"))


def apply_mix(docs: DataFrame, **how) -> DataFrame:
    """The mixed corpus: each row of ``docs`` as often as it is taken whole, and once with its first words if a part is left.

    A partly taken text ends after its last taken word. Rows are told apart by doc_id and text; rows that repeat both
    share their words evenly.
    """
    taken = decisions(docs, **how).groupBy("doc_id", "mark").agg(F.sum("taken").alias("taken"), F.sum("size").alias("all"))
    # a row travels as one struct, so no name of its columns can clash with what is beside it
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("own_mark"), word_count().alias("size"))
    rows = rows.join(taken, rows["id"].eqNullSafe(taken["doc_id"]) & (rows["own_mark"] == taken["mark"]))
    rows = rows.withColumn("own", F.when(F.col("all") > 0, F.round(F.col("size") * F.col("taken") / F.col("all"))).otherwise(F.lit(0)).cast("long"))
    copies = F.when(F.col("size") > 0, F.ceil(F.col("own") / F.col("size"))).otherwise(F.lit(0)).cast("int")
    rows = rows.withColumn("copy", F.explode(F.when(copies > 0, F.sequence(F.lit(1), copies)).otherwise(F.array().cast("array<int>"))))
    part = F.when(F.col("copy") * F.col("size") > F.col("own"), F.col("own") - (F.col("copy") - 1) * F.col("size"))
    lengths = F.transform(F.regexp_extract_all("row.text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1)), lambda x: F.char_length(x))
    end = F.aggregate(F.slice(lengths, F.lit(1), part.cast("int")), F.lit(0), lambda a, x: a + x)
    rows = rows.withColumn("end", F.when(part.isNotNull(), end))
    text = F.when(F.col("end").isNull(), F.col("row.text")).otherwise(F.substring(F.col("row.text"), F.lit(1), F.col("end")))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])

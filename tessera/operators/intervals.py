"""Closed intervals: overlap filter, batch and pairwise joins, lift-over with the dominant target.

An interval has a group (chromosome, type) and inclusive ends, so touching ends overlap. Where the right side is small, the group
key makes a broadcast hash join with the range as residual. For two large sides, both are dealt into bins of
``width``; a pair meets in every common bin and counts in the first, so no distinct is needed. Where lengths differ widely, no
width is right: then bins have as many widths as the data have lengths (in powers of two).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def overlaps(df: DataFrame, group: str, start: int, end: int, on: tuple[str, str, str] = ("chr", "start", "end")) -> DataFrame:
    """Rows of ``df`` that overlap one interval; three predicates that reach the scan."""
    g, s, e = on
    return df.where((F.col(g) == group) & (F.col(e) >= start) & (F.col(s) <= end))


def overlap_join(a: DataFrame, b: DataFrame, on_a: tuple[str, str, str] = ("chr", "start", "end"), on_b: tuple[str, str, str] = ("chr", "start", "end"), width: int | str | None = None, parts: int | None = None) -> DataFrame:
    """All pairs of overlapping intervals of ``a`` and ``b``, whose columns must have different names.

    ``width``: deal both sides into bins (for two large sides) of one width, or of a width by their lengths (``"levels"``); else an
    equi-join on the group with a range residual, of which AQE broadcasts a side that is small. ``parts``: deal bins of one width to so many tasks, where the pairs are many more than the rows that AQE sees.
    """
    (ga, sa, ea), (gb, sb, eb) = on_a, on_b
    cond = (F.col(ga) == F.col(gb)) & (F.col(ea) >= F.col(sb)) & (F.col(sa) <= F.col(eb))
    if width is None:
        return a.join(b, cond)
    if width == "levels":
        return _join_by_levels(a, b, on_a, on_b)

    def bins(df: DataFrame, s: str, e: str, name: str) -> DataFrame:
        ok = df.where(F.col(s) <= F.col(e))
        return ok.withColumn(name, F.explode(F.sequence(F.floor(F.col(s) / width), F.floor(F.col(e) / width))))

    first = F.floor(F.greatest(F.col(sa), F.col(sb)) / width)
    left, right = bins(a, sa, ea, "__bin_a"), bins(b, sb, eb, "__bin_b")
    if parts:
        left, right = left.repartition(parts, "__bin_a", ga), right.repartition(parts, "__bin_b", gb)
    return left.join(right, (F.col("__bin_a") == F.col("__bin_b")) & cond).where(F.col("__bin_a") == first).drop("__bin_a", "__bin_b")


def _level(start: str, end: str) -> Column:
    """The least k such that the interval is at most 2**k long."""
    return F.length(F.bin((F.col(end) - F.col(start)).cast("long"))) - F.when(F.col(end) == F.col(start), 1).otherwise(0)


def _levels(df: DataFrame, level: str) -> list[int]:
    return sorted(r[0] for r in df.select(level).distinct().collect())  # a number a level, about 60 at most


def _bin(c: str, level: str) -> Column:
    return F.expr(f"shiftright(cast(`{c}` AS bigint), `{level}`)")


def _join_by_levels(a: DataFrame, b: DataFrame, on_a: tuple[str, str, str], on_b: tuple[str, str, str]) -> DataFrame:
    """Overlapping pairs that meet in bins as wide as the longer of the two: an interval at most 2**k long lies in two bins of
    that width, whatever its place.

    So an interval is dealt into two bins at its own level and at each higher level that the other side has, never into
    more than twice the levels in use (about 60 at most), however long it is; a pair meets at the higher of its two levels only, in the bin where its
    common part begins. At each level the intervals that are at home there meet all others, and only those: two short ones never meet in a wide bin, so
    what is compared grows with the results. The levels in use are one aggregate of each side. One long interval shares its bin with all that it overlaps: these are
    its results, and adaptive execution may split them.
    """
    (ga, sa, ea), (gb, sb, eb) = on_a, on_b

    def leveled(df: DataFrame, s: str, e: str, name: str) -> tuple[DataFrame, list[int]]:
        rows = df.where(F.col(s) <= F.col(e)).withColumn(f"__own_{name}", _level(s, e))
        return rows, _levels(rows, f"__own_{name}")

    (ra, la), (rb, lb) = leveled(a, sa, ea, "a"), leveled(b, sb, eb, "b")

    def dealt(rows: DataFrame, s: str, e: str, name: str, levels: Column) -> DataFrame:
        rows = rows.withColumn(f"__level_{name}", F.explode(levels))
        return rows.withColumn(f"__bin_{name}", F.explode(F.array_distinct(F.array(_bin(s, f"__level_{name}"), _bin(e, f"__level_{name}")))))

    def home(rows: DataFrame, s: str, e: str, name: str) -> DataFrame:
        return dealt(rows, s, e, name, F.array(f"__own_{name}"))

    def guests(rows: DataFrame, s: str, e: str, name: str, others: list[int], same: bool) -> DataFrame:
        own = F.col(f"__own_{name}")
        return dealt(rows, s, e, name, F.filter(F.array(*[F.lit(x).cast("int") for x in others]).cast("array<int>"), lambda x: (x >= own) if same else (x > own)))

    begins = F.greatest(F.col(sa), F.col(sb)).cast("long")
    meets = (F.col(ga) == F.col(gb)) & (F.col("__level_a") == F.col("__level_b")) & (F.col("__bin_a") == F.col("__bin_b")) & (F.col(ea) >= F.col(sb)) & (F.col(sa) <= F.col(eb))
    longer_a = home(ra, sa, ea, "a").join(guests(rb, sb, eb, "b", la, True), meets)
    longer_b = guests(ra, sa, ea, "a", lb, False).join(home(rb, sb, eb, "b"), meets)
    pairs = longer_a.unionByName(longer_b).withColumn("__begins", begins)
    return pairs.where("__bin_a = shiftright(__begins, __level_a)").drop("__begins", *[f"__{x}_{n}" for x in ("own", "level", "bin") for n in "ab"])


def overlap_aggregates(regions: DataFrame, items: DataFrame, on_regions: tuple[str, str, str], on_items: tuple[str, str, str], region: list[str], value: str) -> DataFrame:
    """Of each region that overlaps any items: ``region``, n (the items), least and most (of their ``value``), without making the pairs.

    Items that begin in a region are a range of starts: it is cut into at most two dyadic bins a level, which are aggregated once for all regions,
    and two ends of less than a bin of the lowest level, where single items are looked at. That level is so low that its bins hold about one item. Items that begin before a region and reach
    into it hold its start: they are found by levels of their lengths, as in a join. Work grows with the rows times the levels, and with the items over one point.
    """
    (g, s, e), (gi, si, ei) = on_regions, on_items
    merged = [F.sum("n").alias("n"), F.min("least").alias("least"), F.max("most").alias("most")]
    asked = regions.where(F.col(s) <= F.col(e)).select(*region, F.col(g).alias("__g"), F.col(s).cast("long").alias("__s"), F.col(e).cast("long").alias("__e"))
    own = items.where(F.col(si) <= F.col(ei)).groupBy(F.col(gi).alias("__g"), F.col(si).cast("long").alias("__is"), F.col(ei).cast("long").alias("__ie")).agg(F.count("*").alias("n"), F.min(value).alias("least"), F.max(value).alias("most"))
    starts = own.groupBy("__g", "__is").agg(*merged)
    found = starts.agg(F.count("*"), F.count_distinct("__g"), F.min("__is"), F.max("__is")).first()
    if not found[0]:
        return regions.sparkSession.createDataFrame([], asked.select(*region).join(own.select("n", "least", "most")).schema)
    low = max(0, ((found[3] - found[2]) * max(1, found[1]) // found[0]).bit_length() - 1)
    high = max(low, (found[3] - found[2]).bit_length())
    levels = list(range(low, high + 1))

    # bins of all levels that lie in [s, e], as far as there are starts: at each level those that no wider bin inside takes in
    within = asked.withColumn("__f", F.greatest("__s", F.lit(found[2]))).withColumn("__l", F.least("__e", F.lit(found[3]))).where("__f <= __l")
    first, last = (lambda k: F.shiftright(F.col("__f") + (2**k - 1), k)), (lambda k: F.shiftright(F.col("__l") + 1, k) - 1)
    parts = []
    for k in levels:
        a, b = first(k), last(k)
        left = (a <= b) & ((a % 2 != 0) if k < high else F.lit(True))
        right = (a <= b) & (b % 2 == 0) & ~(left & (a == b))
        if k == high:
            parts.append(F.when(a <= b, F.transform(F.sequence(a, F.greatest(a, b)), lambda x: F.struct(F.lit(high).alias("k"), x.alias("bin")))))
        else:
            parts += [F.when(left, F.array(F.struct(F.lit(k).alias("k"), a.alias("bin")))), F.when(right, F.array(F.struct(F.lit(k).alias("k"), b.alias("bin"))))]
    nodes = F.flatten(F.array_compact(F.array(*parts)))
    lowest = starts.groupBy("__g", F.shiftright("__is", low).alias("__bin")).agg(*merged)
    tree = lowest.select("*", F.explode(F.array(*[F.lit(k) for k in levels])).alias("__k")).groupBy("__g", "__k", F.expr(f"shiftright(__bin, __k - {low})").alias("__bin")).agg(*merged)
    inner = within.select(*region, "__g", F.explode(nodes).alias("x")).select(*region, "__g", F.col("x.k").alias("__k"), F.col("x.bin").alias("__bin")).join(tree, ["__g", "__k", "__bin"])

    # the ends of the range: the lowest bins of both where they are not wholly inside
    bin_s, bin_e = F.shiftright("__f", low), F.shiftright("__l", low)
    cut = F.array_distinct(F.array_compact(F.array(F.when(bin_s < first(low), bin_s), F.when(bin_e > last(low), bin_e))))
    edges = within.select(*region, "__g", "__s", "__e", F.explode(cut).alias("__bin")).join(starts.withColumn("__bin", F.shiftright("__is", low)), ["__g", "__bin"]).where("__is >= __s AND __is <= __e")

    # items that begin before s and reach it, by the levels of their lengths
    sized = own.where("__is < __ie").withColumn("__k", _level("__is", "__ie"))
    held = sized.withColumn("__bin", F.explode(F.array_distinct(F.array(_bin("__is", "__k"), _bin("__ie", "__k")))))
    points = asked.select(*region, "__g", "__s", F.explode(F.array(*[F.lit(k).cast("int") for k in _levels(sized, "__k")]).cast("array<int>")).alias("__k")).withColumn("__bin", _bin("__s", "__k"))
    over = points.join(held, ["__g", "__k", "__bin"]).where("__is < __s AND __ie >= __s")

    columns = [*region, "n", "least", "most"]
    return inner.select(columns).unionByName(edges.select(columns)).unionByName(over.select(columns)).groupBy(*region).agg(*merged)


def overlap(sa: Column, ea: Column, sb: Column, eb: Column) -> tuple[Column, Column, Column]:
    """(start, end, length) of the common part of two overlapping closed intervals."""
    s, e = F.greatest(sa, sb), F.least(ea, eb)
    return s, e, e - s + 1


#: Classes of intervals are counted in so many buckets, to find those that need to be cut.
BUCKETS = 1 << 16


def _classes(df: DataFrame, on: tuple[str, str, str], columns: list[str], most: int) -> DataFrame:
    """A row for equal intervals of ``df``: group, start, end and an array for each of ``columns``, in order of the first; about ``most`` intervals at most.

    Larger classes are cut by a hash of the members. Which these are is seen from the numbers of rows in ``BUCKETS`` buckets, of which those over ``most`` are broadcast.
    """
    rows = df.withColumn("__bucket", F.pmod(F.xxhash64(*on), F.lit(BUCKETS)))
    large = rows.groupBy("__bucket").agg(F.ceil(F.count("*") / most).alias("__parts")).where("__parts > 1")
    part = F.pmod(F.xxhash64(*columns), F.coalesce("__parts", F.lit(1)))
    cut = rows.join(F.broadcast(large), "__bucket", "left").withColumn("__part", part)
    rows = cut.groupBy(*on, "__part").agg(F.sort_array(F.collect_list(F.struct(*columns))).alias("__members"))
    return rows.select(*on, *[F.col("__members")[c].alias(c) for c in columns])


def _repeat(df: DataFrame, on: tuple[str, str, str]) -> bool:
    """There are about two or more rows to each interval, by one aggregate."""
    n, different = df.agg(F.count("*"), F.approx_count_distinct(F.xxhash64(*on))).first()
    return n >= 2 * different


#: Pairs, and rows, of a task where intervals repeat: its output is that large, whatever AQE sees of its input.
PAIRS, ROWS, MOST_PARTS = 20_000_000, 500_000, 4000


def _parts(df: DataFrame, on: tuple[str, str, str], width: int) -> int | None:
    """Tasks for the pairs of ``df`` dealt in bins, about half the squares of the rows that start in a bin, by one aggregate; none if the pairs of one task are more."""
    g, s, _ = on
    pairs, rows, bins = df.groupBy(g, F.floor(F.col(s) / width).alias("__bin")).agg(F.count("*").cast("double").alias("n")).agg(F.sum(F.col("n") * F.col("n") / 2), F.sum("n"), F.count("*")).first()
    return min(math.ceil(pairs / PAIRS + rows / ROWS), bins, MOST_PARTS) if bins and pairs > PAIRS else None


def pair_overlaps(df: DataFrame, id_: str, ordinal: str, on: tuple[str, str, str] = ("chr", "start", "end"), label: str | None = None, width: int | str | None = None, carried: tuple[str, ...] = (), together: int | None = None) -> DataFrame:
    """Unordered pairs of different overlapping intervals of ``df``: id_a, id_b (in order of ``ordinal``), group, start, end, bp, is_cross.

    Rows without a group or an end take no part, nor do those whose ends are 0. is_cross: the labels differ. ``carried``: columns that a pair gets of both, as c_a and c_b.
    ``together``: where intervals repeat (``_repeat``), about so many equal ones at most are dealt, sorted and met as one row, and become pairs after the join. The pairs are the same, but the join holds and compares less, and
    those of copies follow one another, so that columns compress. A task holds about the square of ``together`` pairs at once. Bins of one width are dealt to tasks by the pairs to be made (``_parts``).
    """
    g, s, e = on
    ok = df.where(F.col(g).isNotNull() & (F.coalesce(F.col(s), F.lit(0)) != 0) & (F.coalesce(F.col(e), F.lit(0)) != 0))
    packed = bool(together) and _repeat(ok, on)
    if packed:
        columns = list(dict.fromkeys([ordinal, id_, label or id_, *carried]))
        classes = _classes(ok, on, columns, together)
        side = lambda x: classes.select(F.col(g).alias(f"g_{x}"), F.col(s).alias(f"s_{x}"), F.col(e).alias(f"e_{x}"), *[F.col(c).alias(f"__all_{c}_{x}") for c in columns])
    else:
        side = lambda x: ok.select(F.col(id_).alias(f"id_{x}"), F.col(ordinal).alias(f"o_{x}"), F.col(g).alias(f"g_{x}"), F.col(s).alias(f"s_{x}"), F.col(e).alias(f"e_{x}"), F.col(label or id_).alias(f"l_{x}"), *[F.col(c).alias(f"{c}_{x}") for c in carried])
    parts = _parts(ok, on, width) if packed and isinstance(width, int) else None
    pairs = overlap_join(side("a"), side("b"), ("g_a", "s_a", "e_a"), ("g_b", "s_b", "e_b"), width, parts)
    if packed:
        for x in "ab":
            own = {c: F.get(f"__all_{c}_{x}", F.col(f"__at_{x}")) for c in columns[1:]} | {ordinal: F.col(f"__one_{x}")}
            pairs = pairs.select("*", F.posexplode(f"__all_{ordinal}_{x}").alias(f"__at_{x}", f"__one_{x}"))
            pairs = pairs.select("*", *[own[c].alias(f"{k}_{x}") for k, c in (("id", id_), ("o", ordinal), ("l", label or id_), *[(c, c) for c in carried])])
    pairs = pairs.where("o_a < o_b")
    start, end, bp = overlap(F.col("s_a"), F.col("e_a"), F.col("s_b"), F.col("e_b"))
    return pairs.select("id_a", "id_b", F.col("g_a").alias(g), start.alias("overlap_start"), end.alias("overlap_end"), bp.alias("overlap_bp"), (F.col("l_a") != F.col("l_b")).alias("is_cross"), "o_a", "o_b", *[f"{c}_{x}" for c in carried for x in "ab"])


def count_inside(pairs: DataFrame, items: DataFrame, group: str, item_on: tuple[str, str, str], item_id: str, width: int | str | None = None) -> DataFrame:
    """``pairs`` with n_items: the items that overlap each pair's common part; ``width`` as in ``overlap_join``."""
    keyed = items.select(*[F.col(c).alias(f"__{k}") for k, c in zip("gse", item_on, strict=True)], F.col(item_id).alias("__id"))
    hits = overlap_join(pairs.select("id_a", "id_b", group, "overlap_start", "overlap_end"), keyed, (group, "overlap_start", "overlap_end"), ("__g", "__s", "__e"), width)
    counts = hits.groupBy("id_a", "id_b").agg(F.count("__id").alias("n_items"))
    return pairs.join(counts, ["id_a", "id_b"], "left").withColumn("n_items", F.coalesce("n_items", F.lit(0)))


def _running(points: DataFrame, columns: list[str]) -> DataFrame:
    """``points`` (__g, __p and numbers, one row a position) with the sums of the numbers up to each position of the group.

    Positions are summed by ranges of about 4000, the ranges' totals are summed in order, and then each range by itself: no task holds a group's positions.
    """
    found = points.agg(F.count("*"), F.count_distinct("__g"), F.min("__p"), F.max("__p")).first()
    width = (found[3] - found[2]) * max(1, found[1]) * 4000 // found[0] if found[0] else 0
    points = points.withColumn("__range", F.shiftright("__p", min(62, width.bit_length())))
    whole = Window.partitionBy("__g").orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("__g", "__range").orderBy("__p").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = points.groupBy("__g", "__range").agg(*[F.sum(c).alias(c) for c in columns])
    before = totals.select("__g", "__range", *[F.coalesce(F.sum(c).over(whole), F.lit(0)).alias(f"__before_{c}") for c in columns])
    own = points.select("__g", "__range", "__p", *[F.sum(c).over(inside).alias(c) for c in columns])
    return own.join(before, ["__g", "__range"]).select("__g", "__p", *[(F.col(c) + F.col(f"__before_{c}")).alias(c) for c in columns])


def pair_counts(df: DataFrame, id_: str, ordinal: str, items: DataFrame, on: tuple[str, str, str] = ("chr", "start", "end"), item_on: tuple[str, str, str] = ("chr", "start", "end"), width: int | str | None = None) -> DataFrame:
    """id_a, id_b, n_items of ``pair_overlaps``: the items that overlap a pair's common part, without joining pairs and items.

    These are the items that begin by the common part's end, less those that end before its start. Both numbers grow with the position, and the
    common part ends with the first end and starts with the last start: so each interval gets both once, and a pair takes the lesser and the greater of two. Items whose end is before their start take no part.
    """
    g, s, e = on
    gi, si, ei = item_on
    own = items.where(F.col(gi).isNotNull() & (F.col(si) <= F.col(ei)))
    at = lambda rows, group, c, begun, done: rows.select(F.col(group).alias("__g"), F.col(c).cast("long").alias("__p"), F.lit(begun).cast("long").alias("begun"), F.lit(done).cast("long").alias("done"))
    points = at(own, gi, si, 1, 0).unionByName(at(own, gi, ei, 0, 1)).unionByName(at(df, g, s, 0, 0)).unionByName(at(df, g, e, 0, 0)).where("__g IS NOT NULL AND __p IS NOT NULL")
    points = points.groupBy("__g", "__p").agg(F.sum("begun").alias("begun"), F.sum("done").alias("done"), F.sum("done").alias("here"))
    sums = _running(points.drop("here"), ["begun", "done"]).join(points.select("__g", "__p", "here"), ["__g", "__p"])
    side = lambda c, value, name: sums.select(F.col("__g").alias(g), F.col("__p").alias(c), value.alias(name))
    ranked = df.join(side(s, F.col("done") - F.col("here"), "__done"), [g, s]).join(side(e, F.col("begun"), "__begun"), [g, e])
    pairs = pair_overlaps(ranked, id_, ordinal, on, None, width, ("__begun", "__done"))
    return pairs.select("id_a", "id_b", (F.least("__begun_a", "__begun_b") - F.greatest("__done_a", "__done_b")).alias("n_items"))


def lift(members: DataFrame, region: list[str], target: tuple[str, str, str], position: list[str]) -> DataFrame:
    """Lift regions by the target coordinates of their members.

    ``members`` has a row per (region, member) with the member's target group, start and end (null or 0: no
    counterpart, counted as dropped). The dominant target is the most frequent group, ties to the one that comes
    first by ``position``; start and end are its least and greatest. Members are only aggregated; the windows run over
    a region's targets. Regions without any counterpart keep a null target.
    """
    g, s, e = target
    mapped = F.col(g).isNotNull() & (F.coalesce(F.col(s), F.lit(0)) != 0) & (F.coalesce(F.col(e), F.lit(0)) != 0)
    groups = members.groupBy(*region, F.when(mapped, F.col(g)).alias("target_chr")).agg(F.count("*").alias("n"), F.min(F.struct(*position)).alias("first"), F.min(s).alias("target_start"), F.max(e).alias("target_end"))
    best = Window.partitionBy(*region).orderBy(F.col("target_chr").isNull(), F.desc("n"), "first")
    whole = Window.partitionBy(*region)
    ranked = groups.select(
        "*", F.row_number().over(best).alias("__k"), F.sum("n").over(whole).alias("n_members"),
        F.sum(F.when(F.col("target_chr").isNull(), F.col("n")).otherwise(0)).over(whole).alias("dropped"),
    ).where("__k = 1")
    none = F.col("target_chr").isNull()
    return ranked.select(
        *region, "n_members", "target_chr", F.when(~none, F.col("target_start")).alias("target_start"), F.when(~none, F.col("target_end")).alias("target_end"), "dropped",
        F.when(none, 0).otherwise(F.col("n_members") - F.col("dropped") - F.col("n")).alias("other_chr"),
    )

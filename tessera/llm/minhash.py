"""MinHash near-duplicates: bottom-k sketches of one hash function, inverted lists, exact Jaccard similarity.

A text's set are the hashes of its distinct shingles; its sketch are the ``SKETCH`` least of them. Equal sets collapse first. Two
sets of a similarity of 0.8 or more have floor(size / 5) unshared values each at most, so the least value they share is among the
first floor(size / 5) + 1 of both: in inverted lists of the sketches sets of under 5 * SKETCH shingles meet for certain,
larger ones but for a probability of 0.2 ** SKETCH.

Lists of a few members give all their pairs. Longer ones come from large groups of copies and from passages that many documents
share. A document of whose values more than floor(size / 5), or ``COLD``, lie in short lists shares one of these with each of its near-duplicates (for
certain; or but for a probability of 1e-8, that of 32 unshared ones among 64 of a pair's union), so only the others follow their long lists: each is paired with the list's head (drawn by a hash, so
that lists of the same documents have different ones), and lists are told apart by the next values of the sketches: the same is done with
the runs of 2 and of 4 values from there on. Candidates grow with the rows, not with the square of a list.

Pairs whose sketches estimate a similarity under 0.5 from the union's bottom-k sketch are dropped (6 standard deviations below 0.8). What is
left forms components, in which full sets are compared, each with all others that are not in its group already; only links so confirmed count.
A link between two documents is thus found if both are like some third one, a list's head, by half: it need not be a candidate itself.

What heads and runs leave is found by an exact join (``rest``): of the sets with few values in short lists, those in long lists whose members are in different groups
meet by the prefixes of their full sets, frequent values last, and are compared in full. Cold sets and followed lists (``COLD``, ``STARTS``) thus only decide how much comes early.

Defined results: null and empty texts and those without words have an empty set, no links, and their own doc_id as component;
repeated rows are linked; rows with a null doc_id link like any other and get their component's id, but never name one, and are not kept;
texts of any length are read whole; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, passes, prepare, saved, sieve, sifted
from tessera.llm.simhash import SIMILARITY, Forest, links_within, shingle_rows, shingle_set

#: Values of a sketch, and the estimated similarity (as a fraction) from which a pair is looked at.
SKETCH, PLAUSIBLE = 64, (1, 2)
#: A list of more members is long; with so many values in short lists a set does not follow its long ones.
LONG, COLD = 16, 32
#: With more values in short lists a set meets all similar ones there, but for a chance of 1e-17 (that of 45 unshared ones among 64 of a union).
ENOUGH = 44
#: So many long lists of a set are followed (all but 0.2 ** STARTS of its near-duplicates are in one of them); widths of the
#: runs of values from there on that tell their members apart.
STARTS, RUNS = 16, (1, 2, 4)


def sketches(docs: DataFrame, width: int = 4, seed: int = 42, size: int = SKETCH) -> DataFrame:
    """doc_id, mark (a hash of the text), n (shingles), set_id (a digest of their set) and sketch (the least hashes in order) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                n, ids, least = [], [], []
                for t in b.column("text").to_pylist():
                    own = shingle_set(t or b"", width, seed)
                    n.append(len(own))
                    ids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                    least.append(own[:size].tobytes())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(n, pa.int64()), pa.array(ids, pa.binary()), pa.array(least, pa.binary())], names=["doc_id", "mark", "n", "set_id", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, n long, set_id binary, sketch binary")


def _values(nodes: DataFrame, among: Broadcast | None = None) -> DataFrame:
    """(value, node, early) of the sketches; ``among``: only values that pass this sieve. early: one of the first floor(n / 5) + 1."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                b = batch.slice(at, 2000)
                own = [np.frombuffer(s, np.int64) for s in b.column("sketch").to_pylist()]
                if own:
                    value, node = np.concatenate(own), np.repeat(b.column("node").to_numpy(), [len(x) for x in own])
                    early = np.concatenate([np.arange(len(x)) <= _unshared(n) for x, n in zip(own, b.column("n").to_pylist(), strict=True)])
                    if among is not None:
                        held = passes(among.value, value)
                        value, node, early = value[held], node[held], early[held]
                    yield pa.RecordBatch.from_arrays([pa.array(value), pa.array(node), pa.array(early)], names=["value", "node", "early"])

    return nodes.select("node", "n", "sketch").mapInArrow(run, "value long, node long, early boolean")


def _unshared(n: int) -> int:
    """So many of n values at most are missing in a similar set."""
    return n * (SIMILARITY[1] - SIMILARITY[0]) // SIMILARITY[1]


def _runs(starts: DataFrame, nodes: DataFrame) -> DataFrame:
    """(value, node): hashes of the values of a node's sketch from each of its ``starts`` (an array) on, for each width in RUNS that is not cut short."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in batches:
            values, owners = [], []
            for node, begun, sketch in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = np.frombuffer(sketch, np.uint64)
                for i in np.searchsorted(own, np.array(begun, np.int64).view(np.uint64)).tolist():
                    found = [xxhash.xxh64_intdigest(sketch[8 * i : 8 * (i + width)]) - (1 << 63) for width in RUNS if i + width // 2 < len(own)]
                    values += found
                    owners += [node] * len(found)
            if values:
                yield pa.RecordBatch.from_arrays([pa.array(values, pa.int64()), pa.array(owners, pa.int64())], names=["value", "node"])

    return starts.join(nodes.select("node", "sketch"), "node").select("node", "starts", "sketch").mapInArrow(run, "value long, node long")


def _pairs(members: DataFrame) -> DataFrame:
    """All pairs (a, b) of the short lists ``members`` (value, node)."""
    lists = members.groupBy("value").agg(F.array_sort(F.collect_list("node")).alias("l")).select(F.posexplode("l").alias("k", "a"), "l")
    return lists.select("a", F.explode(F.slice("l", F.col("k") + 2, F.size("l"))).alias("b"))


def inverted(nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lists (value, m, and their least and greatest node a and b) of two or more members, and the members (value, node, early, m) of those of more. Written."""
    values = _values(nodes)
    lists = saved(values.groupBy("value").agg(F.count("*").alias("m"), F.min("node").alias("a"), F.max("node").alias("b")).where("m > 1"), "lists")
    crowded = lists.where("m > 2").select("value", "m")
    return lists, saved(_values(nodes, sieve(crowded, "value")).join(crowded, "value"), "members")


def candidates(nodes: DataFrame, long: int = LONG, cold: int = COLD, held: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Distinct pairs (a, b), a < b, of ``nodes`` (node, n, sketch) that meet in a list: all of a short one, some of a long one. ``held``: their ``inverted`` lists. Written."""
    lists, members = held or inverted(nodes)
    found = [lists.where("m = 2").select("a", "b"), _pairs(members.where(F.col("m") <= long))]
    far = members.where(F.col("m") > long)
    busy = far.groupBy("node").agg(F.count("*").alias("far")).join(nodes.select("node", "n"), "node")
    unshared = F.floor(F.col("n") * (SIMILARITY[1] - SIMILARITY[0]) / SIMILARITY[1])
    busy = busy.where(F.least(F.lit(SKETCH), F.col("n")) - F.col("far") <= F.least(F.lit(cold - 1), unshared)).select("node")
    # values are uniform hashes; their order as signed numbers is as good as any
    starts = far.join(busy, "node").groupBy("node").agg(F.slice(F.array_sort(F.collect_list("value")), 1, STARTS).alias("starts"))
    rows = saved(_runs(starts, nodes), "runs")
    if not rows.isEmpty():
        lists = saved(rows.groupBy("value").agg(F.count("*").alias("m"), F.min_by("node", F.xxhash64("value", "node")).alias("head")).where("m > 1"), "lists")
        rows = rows.join(lists, "value")
        found.append(_pairs(rows.where(F.col("m") <= long)))
        found.append(rows.where((F.col("m") > long) & (F.col("node") != F.col("head"))).select(F.least("head", "node").alias("a"), F.greatest("head", "node").alias("b")))
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return saved(every.where("a < b").distinct(), "pairs")


def plausible(pairs: DataFrame, nodes: DataFrame) -> DataFrame:
    """Spanning links of the pairs whose union's sketch allows for the similarity: a task returns fewer than it has nodes."""
    over, under = PLAUSIBLE

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                _, seen = np.unique(np.concatenate([np.frombuffer(x, ">u4"), np.frombuffer(y, ">u4")]), return_counts=True)
                seen = seen[:SKETCH]  # the union's sketch
                keep.append(under * int((seen == 2).sum()) >= over * len(seen))
            kept.append(np.stack([batch.column(c).to_numpy() for c in "ab"])[:, np.array(keep, bool)])
        if kept:
            a, b = np.concatenate(kept, axis=1)
            ids, at = np.unique(np.r_[a, b], return_inverse=True)
            forest = Forest(len(ids))
            forest.link(at[: len(a)], at[len(a) :])
            moved = np.flatnonzero(forest.root != np.arange(len(ids)))
            yield pa.RecordBatch.from_arrays([pa.array(ids[forest.root[moved]]), pa.array(ids[moved])], names=["a", "b"])

    size = lambda c, n: nodes.select(F.col("node").alias(c), F.col("n").alias(n))
    sized = F.least("na", "nb") * SIMILARITY[1] >= F.greatest("na", "nb") * SIMILARITY[0]
    pairs = saved(pairs.join(size("a", "na"), "a").join(size("b", "nb"), "b").where(sized).select("a", "b"), "sized")
    paired = pairs.select(F.explode(F.array("a", "b")).alias("node")).select(F.xxhash64("node").alias("h"))
    own = sifted(nodes.select(F.xxhash64("node").alias("h"), "node", "sketch"), "h", sieve(paired, "h")).select("node", "sketch").mapInArrow(_upper_halves, "node long, x binary")
    side = lambda c, x: own.select(F.col("node").alias(c), F.col("x").alias(x))
    return pairs.join(side("a", "x"), "a").join(side("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(run, "a long, b long")


def _upper_halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, x) of (node, sketch): the upper 32 bits of the values, in the same order. They tell them apart well enough for an estimate."""
    for b in batches:
        halves = [(np.frombuffer(s, np.uint64) >> np.uint64(32)).astype(">u4").tobytes() for s in b.column("sketch").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("node"), pa.array(halves, pa.binary())], names=["node", "x"])


def rest(docs: DataFrame, nodes: DataFrame, far: DataFrame, found: DataFrame, width: int = 4, seed: int = 42, long: int = LONG) -> DataFrame | None:
    """Links (a, b) of all similar pairs of different groups (``found``: node, root) that meet in the long lists ``far`` (value, node, early) only. Written; None if no list has two groups.

    The sets of the lists' members are joined by their prefixes: values that more than ``long`` of them have come last in the order, so a common passage joins
    only sets that hardly have anything else. The first common value of a similar pair is among the first floor(n / 5) + 1 of both, and behind it there must be room for what they share.
    """
    # of a pair's least 64 values at most as many are unshared as sets differ in; so many values in short lists may be missed, with one more the pair met in one
    few = F.least(F.lit(ENOUGH), F.floor(F.col("n") * (SIMILARITY[1] - SIMILARITY[0]) / SIMILARITY[0]))
    busy = far.groupBy("node").agg(F.count("*").alias("far")).join(nodes.select("node", "n"), "node").where(F.least(F.lit(SKETCH), F.col("n")) - F.col("far") <= few).select("node")
    far = far.where("early").join(busy, "node")
    grouped = saved(far.join(found, "node", "left").select("value", "node", F.coalesce("root", "node").alias("grp")), "far")
    open_ = saved(grouped.groupBy("value").agg(F.min("grp").alias("least"), F.max("grp").alias("most")).where("least < most").select("value"), "open")
    if open_.isEmpty():
        return None
    own = saved(grouped.join(open_, "value").select("node", "grp").distinct(), "own")
    sets = saved(_sets(docs, nodes.join(own, "node").select(F.col("node").alias("rep"), F.col("grp").alias("root"), "least", "mark"), width, seed), "sets")

    def every(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 200):
                yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(b"".join(b.column("hashes").slice(at, 200).to_pylist()), np.int64))], names=["value"])

    counts = sets.select("hashes").mapInArrow(every, "value long").groupBy("value").count()
    frequent = sieve(saved(counts.where(F.col("count") > long), "frequent"), "value")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 200):
                b = batch.slice(at, 200)
                whole = [np.frombuffer(h, np.int64) for h in b.column("hashes").to_pylist()]
                if not whole:
                    continue
                early = [x[np.argsort(passes(frequent.value, x), kind="stable")][: _unshared(len(x)) + 1] for x in whole]
                k = [len(x) for x in early]
                owners = [np.repeat(x, k) for x in (b.column("rep").to_numpy(), b.column("root").to_numpy(), [len(x) for x in whole])]
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in (np.concatenate(early), *owners, np.concatenate([np.arange(x) for x in k]))], names=["value", "rep", "grp", "n", "at"])

    rows = saved(sets.select("rep", "root", "hashes").mapInArrow(first, "value long, rep long, grp long, n long, at long"), "prefixes")
    over, under = SIMILARITY
    side = lambda x: rows.select("value", *[F.col(c).alias(f"{c}_{x}") for c in ("rep", "grp", "n", "at")])
    room = F.least(F.col("n_a") - F.col("at_a"), F.col("n_b") - F.col("at_b"))
    # the pair's intersection c has under * c >= over * (n_a + n_b - c)
    pairs = side("a").join(side("b"), "value").where((F.col("rep_a") < F.col("rep_b")) & (F.col("grp_a") != F.col("grp_b")) & (room * (over + under) >= (F.col("n_a") + F.col("n_b")) * over))
    pairs = saved(pairs.select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")).distinct(), "rest")

    def similar(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
                common = len(np.intersect1d(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), assume_unique=True))
                keep.append(under * common >= over * ((len(x) + len(y)) // 8 - common))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    whole = lambda c, x: sets.select(F.col("rep").alias(c), F.col("hashes").alias(x))
    return saved(pairs.join(whole("a", "x"), "a").join(whole("b", "y"), "b").select("a", "b", "x", "y").mapInArrow(similar, "a long, b long"), "links")


def _sets(docs: DataFrame, members: DataFrame, width: int, seed: int) -> DataFrame:
    """rep, root and hashes (the full set) of the nodes ``members`` (rep, root, least, mark), one row each."""
    # one row of each set: the document that gave it its smallest doc_id
    texts = sifted(docs.select(F.col("doc_id").cast("long").alias("own"), F.xxhash64("text").alias("mark"), "text"), "mark", sieve(members, "mark"))
    texts = texts.join(members, "mark").where(F.col("own").eqNullSafe(F.col("least")))
    return shingle_rows(texts.select("rep", "root", "text"), width, seed).groupBy("rep").agg(F.first("root").alias("root"), F.first("hashes").alias("hashes"))


def near_components(docs: DataFrame, width: int = 4, seed: int = 42, long: int = LONG, cold: int = COLD) -> DataFrame:
    """doc_id, n_shingles, component_id (the component's smallest doc_id) and kept (whether that is the row's own) of every row."""
    rows = saved(sketches(docs, width, seed), "sketches")
    nodes = rows.where("n > 0").groupBy("set_id").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("first"), F.first("mark").alias("mark"), F.first("n").alias("n"), F.first("sketch").alias("sketch"))
    nodes = saved(nodes.select("set_id", F.col("first.doc_id").alias("least"), F.coalesce("first.mark", "mark").alias("mark"), "n", "sketch", F.monotonically_increasing_id().alias("node")), "nodes")
    held = inverted(nodes)
    near = components(plausible(candidates(nodes, long, cold, held), nodes))
    members = saved(nodes.join(near.select("node", "root"), "node").select(F.col("node").alias("rep"), "root", "least", "mark"), "near")
    found = components(links_within(saved(_sets(docs, members, width, seed), "sets")))
    more = rest(docs, nodes, held[1].where(F.col("m") > long), found, width, seed, long)
    if more is not None and not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("root").alias("b")).unionByName(more))
    tops = saved(nodes.join(found, "node", "left").select("set_id", "least", F.coalesce("root", "node").alias("root")), "tops")
    names = tops.groupBy("root").agg(F.min("least").alias("component_id"))
    tops = saved(tops.join(names, "root").select("set_id", "component_id"), "names")
    out = rows.join(tops, "set_id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False)))

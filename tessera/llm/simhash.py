"""SimHash near-duplicates: fingerprints, linked by a binary trie self-join, then components.

Equal fingerprints collapse to one representative first. The trie of the rest is walked as pairs of nodes, level by
level for many pairs at once: a pair carries the number of bits in which its two prefixes differ and is dropped when
that exceeds the budget. The walk is dealt out by rotations of the bit order. A rotation takes some bits as exact (a
task needs only nodes that agree on them) and walks the rest.

64 bits and a budget of 4 (``BITS64``): five rotations, each with one of five blocks exact. Four differing bits leave
a block untouched, so every pair within the budget survives in some rotation: the join is complete.

256 bits (``SIMILAR``, of distinct shingles): the candidates for a similarity of 0.8, at 56 or fewer differing bits; a
rotation has half of one of sixteen 16-bit blocks exact and allows one differing bit in its other half. Two shingle sets
of Jaccard similarity 0.8 differ in about 39 of 256 bits, with a standard deviation of about 6. ``keep_one_each`` compares
all pairs in each component of candidates by their exact similarity, so no link rests on fingerprints alone and no link
depends on another one that was refused.

Tasks return spanning links, not all pairs, and pass over node pairs that lie in one component already. The members
of a bucket that very many share are dealt into chunks; each pair of chunks is a bucket of its own.

Defined results: null and empty texts have fingerprint zero and are linked like any other; repeated rows share their
fingerprint; rows with a null doc_id link like any other and get their component's id, but never name one (a component
of such rows only has a null id); texts of any length are read whole; an empty table gives no rows; other columns are
not looked at, and ``keep_one_each`` returns them as they are, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import components, parts, prepare, saved


class Rule(NamedTuple):
    """words: 64-bit words of a fingerprint. exact: bits of a rotation that agree. head: bits above the rest with a budget
    of their own (head_budget). budget: differing bits of a linked pair at most."""

    words: int
    budget: int
    exact: tuple[tuple[int, int], ...]  # (lowest bit, width) in the word
    head: int = 0
    head_budget: int = 0
    distinct: bool = False  # repeats of a shingle count once


BITS64 = Rule(1, 4, ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12)))
SIMILAR = Rule(4, 56, tuple((low, 8) for low in range(0, 64, 8)), 8, 1, True)
#: The Jaccard similarity (as a fraction) of distinct shingles from which documents are near-duplicates.
SIMILARITY = (4, 5)
#: Members and bytes of shingle hashes in a chunk of a component of candidates; a task compares the pairs of two chunks.
CHUNK_MEMBERS, CHUNK_BYTES = 300, 6 << 20
#: A bucket of the self-join with more members than this is dealt into chunks.
HOT_BUCKET = 60_000
#: A node pair with at most this many pairs of members is compared; node pairs and pairs of members held at once.
LEAF, FRONTIER, PAIRS = 48, 100_000, 400_000


def shingle_hashes(text: bytes, width: int, seed: int) -> list[int]:
    """XXH64 of the shingles of ``width`` words, repeats included; A-Z lower-cased."""
    import xxhash

    words = text.lower().split()  # of bytes: ASCII letters and ASCII white space only
    if not words:
        return []
    joined, h = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= width:
        return [h(joined, seed)]
    gaps = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32).tolist()
    starts, ends = [0, *(g + 1 for g in gaps[: len(gaps) - width + 1])], [*gaps[width - 1 :], len(joined)]
    return [h(joined[s:e], seed) for s, e in zip(starts, ends, strict=True)]


def shingle_set(text: bytes, width: int, seed: int) -> np.ndarray:
    """The distinct shingle hashes, sorted."""
    return np.unique(np.array(shingle_hashes(text, width, seed), np.uint64))


def fingerprint(text: bytes, width: int = 4, seed: int = 42, words: int = 1) -> bytes:
    """SimHash, big-endian: a bit is set if it is set in over half the hashes. Words after the first use remixed hashes."""
    return simhash(np.array(shingle_hashes(text, width, seed), np.uint64), words)


def simhash(hashes: np.ndarray, words: int) -> bytes:
    out = []
    for k in range(words):
        some = hashes
        if k:
            some = (some ^ (some >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9 + 2 * k)
            some = (some ^ (some >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
            some ^= some >> np.uint64(31)
        counts = np.zeros(64, np.int64)
        for at in range(0, len(some), 1 << 14):
            counts += np.unpackbits(some[at : at + (1 << 14)].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int32)
        out.append(np.packbits(2 * counts > len(some)).tobytes())
    return b"".join(out)


def fingerprints(docs: DataFrame, width: int = 4, seed: int = 42, words: int = 1) -> DataFrame:
    """doc_id and fp (binary) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                fps = [fingerprint(t or b"", width, seed, words) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fps, pa.binary())], names=["doc_id", "fp"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("binary").alias("text")).mapInArrow(run, "doc_id long, fp binary")


class Forest:
    """Union-find over 0..n-1 that takes links as arrays."""

    def __init__(self, n: int) -> None:
        self.root = np.arange(n)

    def link(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            ra, rb = self.root[a], self.root[b]
            apart = ra != rb
            if not apart.any():
                return
            a, b, ra, rb = a[apart], b[apart], ra[apart], rb[apart]
            np.minimum.at(self.root, np.maximum(ra, rb), np.minimum(ra, rb))
            while not np.array_equal(up := self.root[self.root], self.root):
                self.root = up


def _compare(fps: np.ndarray, i: np.ndarray, j: np.ndarray, budget: int, forest: Forest, index: np.ndarray) -> None:
    """Link those of the pairs (i, j) that are within the budget."""
    for at in range(0, len(i), PAIRS):
        a, b = i[at : at + PAIRS], j[at : at + PAIRS]
        apart = forest.root[index[a]] != forest.root[index[b]]
        a, b = a[apart], b[apart]
        near = np.bitwise_count(fps[a] ^ fps[b]).sum(axis=1, dtype=np.int32) <= budget
        forest.link(index[a[near]], index[b[near]])


def _members(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """All pairs of members of the node pairs [a, b) x [c, d), in pieces; of a node with itself those with i < j."""
    n = (b - a) * (d - c)
    cuts = np.searchsorted(np.cumsum(n), np.arange(0, n.sum(), PAIRS), side="right") if len(n) else []
    bounds = sorted({0, *map(int, cuts), len(n)})
    for s, e in zip(bounds, bounds[1:], strict=False):
        m = n[s:e]
        k = np.arange(m.sum()) - np.repeat(np.cumsum(m) - m, m)
        wide = np.repeat(d[s:e] - c[s:e], m)
        i, j = np.repeat(a[s:e], m) + k // wide, np.repeat(c[s:e], m) + k % wide
        keep = (i < j) | np.repeat(a[s:e] != c[s:e], m)
        yield i[keep], j[keep]


def trie_join(top: np.ndarray, fps: np.ndarray, starts: np.ndarray, ends: np.ndarray, rule: Rule, low: int, forest: Forest, index: np.ndarray) -> None:
    """Link all pairs within the rule in each bucket [start, end), sorted by ``top``, whose lowest ``low`` bits need no walk."""
    for step in (1, 2, 3):  # neighbours first: dense groups come together early and are passed over below
        at = np.arange(max(0, len(top) - step))
        bucket = np.repeat(np.arange(len(starts)), ends - starts)
        at = at[bucket[at] == bucket[at + step]]
        _compare(fps, at, at + step, rule.budget, forest, index)
    zeros: dict[int, np.ndarray] = {}
    stack = [(64, starts, ends, starts, ends, np.zeros(len(starts), np.int32))]
    while stack:
        bit, a, b, c, d, err = stack.pop()
        roots = forest.root[index]
        change = np.r_[0, np.cumsum(roots[1:] != roots[:-1])]
        done = (change[b - 1] == change[a]) & (change[d - 1] == change[c]) & (roots[a] == roots[c])
        a, b, c, d, err = (x[~done] for x in (a, b, c, d, err))
        small = ((b - a) * (d - c) <= LEAF) | (bit == low)
        for i, j in _members(a[small], b[small], c[small], d[small]):
            _compare(fps, i, j, rule.budget, forest, index)
        a, b, c, d, err = (x[~small] for x in (a, b, c, d, err))
        if not len(a):
            continue
        if len(a) > FRONTIER:
            half = len(a) // 2
            stack += [(bit, *(x[half:] for x in (a, b, c, d, err))), (bit, *(x[:half] for x in (a, b, c, d, err)))]
            continue
        bit -= 1
        if bit not in zeros:
            zeros = {bit: np.r_[0, np.cumsum((top >> np.uint64(bit)) & np.uint64(1) == 0)]}
        z = zeros[bit]
        m, n = a + z[b] - z[a], c + z[d] - z[c]
        other = a != c
        budget = rule.head_budget if 64 - bit <= rule.head else rule.budget
        children = [(a, m, c, n, err), (m, b, n, d, err), (a, m, n, d, err + 1), tuple(x[other] for x in (m, b, c, n, err + 1))]
        a, b, c, d, err = (np.concatenate(x) for x in zip(*children, strict=True))
        alive = (a < b) & (c < d) & (err <= budget)
        stack.append((bit, *(x[alive] for x in (a, b, c, d, err))))


def _rotations(fp: np.ndarray, rule: Rule) -> Iterator[tuple[int, np.ndarray, np.ndarray, int]]:
    """(number, exact bits, word turned so that its exact bits are lowest and its head is on top, width of the exact bits)."""
    at = 0
    for w in range(rule.words):
        x = fp[:, w]
        for low, width in rule.exact:
            turn = lambda y, by: y if not by else (y >> np.uint64(by)) | (y << np.uint64(64 - by))
            turned = turn(x, low)
            exact = turned & np.uint64((1 << width) - 1)
            if rule.head and low // rule.head % 2 == 0:  # the other half of the block lies above the exact half: bring it to the top
                rest, block = turned >> np.uint64(width), np.uint64((1 << rule.head) - 1)
                turned = ((rest & block) << np.uint64(64 - rule.head)) | ((rest >> np.uint64(rule.head)) << np.uint64(width)) | exact
            yield at, exact, turned, width
            at += 1


def _words(column: pa.Array | pa.ChunkedArray, words: int) -> np.ndarray:
    """Fingerprints as rows of 64-bit words, without an object for each."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    _, ends, data = column.buffers()
    first = int(np.frombuffer(ends, np.int32)[column.offset])
    return np.frombuffer(data, ">u8", len(column) * words, first).astype(np.uint64).reshape(-1, words)


def near_links(reps: DataFrame, rule: Rule = BITS64, hot: int = HOT_BUCKET) -> DataFrame:
    """Spanning links (a, b) among representatives (fp binary, distinct; rep long): same components as all pairs within the rule."""
    spark = reps.sparkSession
    prepare(spark)
    rotations = rule.words * len(rule.exact)

    def dealt(crowded: dict[int, int]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in range(0, batch.num_rows, 5000):
                    b = batch.slice(at, 5000)
                    if not b.num_rows:
                        continue
                    fp, rep, raw = _words(b.column("fp"), rule.words), b.column("rep").to_numpy(), b.column("fp")
                    chunk = (rep.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)
                    for r, exact, _, _ in _rotations(fp, rule):
                        key = (np.int64(r) << np.int64(16)) + exact.astype(np.int64)
                        row, deal = np.arange(len(rep)), np.zeros(len(rep), np.int64)
                        if crowded and (n := np.array([crowded.get(k, 1) for k in key.tolist()])).max() > 1:
                            row = np.repeat(row, n)
                            j = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
                            i = (chunk[row] % n[row].astype(np.uint64)).astype(np.int64)
                            deal = np.where(n[row] > 1, 1 + np.maximum(i, j) * (np.maximum(i, j) + 1) // 2 + np.minimum(i, j), 0)
                        yield pa.RecordBatch.from_arrays([pa.array(key[row]), pa.array(deal), raw.take(pa.array(row)), pa.array(rep[row])], names=["key", "deal", "fp", "rep"])

        return reps.select("fp", "rep").mapInArrow(run, "key long, deal long, fp binary, rep long")

    # at most rotations * 2**13 keys; only their counts reach the driver
    crowded = {k: -(-n // hot) for k, n in dealt({}).groupBy("key").count().where(F.col("count") > hot).collect()}

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        got = [b for b in batches if b.num_rows]
        if not got:
            return
        t = pa.Table.from_batches(got)
        fps, rep, key, deal = _words(t.column("fp"), rule.words), t.column("rep").to_numpy(), t.column("key").to_numpy(), t.column("deal").to_numpy()
        ids, index = np.unique(rep, return_inverse=True)
        forest = Forest(len(ids))
        for r, _, turned, width in _rotations(fps, rule):
            rows = np.flatnonzero(key >> 16 == r)
            if not len(rows):
                continue
            rows = rows[np.lexsort((turned[rows], deal[rows], key[rows]))]
            starts = np.flatnonzero(np.r_[True, (np.diff(key[rows]) != 0) | (np.diff(deal[rows]) != 0)])
            ends = np.r_[starts[1:], len(rows)]
            trie_join(turned[rows], fps[rows], starts, ends, rule, width, forest, index[rows])
        moved = np.flatnonzero(forest.root != np.arange(len(ids)))
        yield pa.RecordBatch.from_arrays([pa.array(ids[moved], pa.int64()), pa.array(ids[forest.root[moved]], pa.int64())], names=["a", "b"])

    return dealt(crowded).repartition(parts(spark, rotations * reps.count(), 150_000), "key", "deal").mapInArrow(walk, "a long, b long")


def near_components(docs: DataFrame, width: int = 4, rule: Rule = BITS64, seed: int = 42, hot: int = HOT_BUCKET) -> DataFrame:
    """doc_id, fp and component_id (the component's smallest doc_id) of every row of ``docs``."""
    fps = saved(fingerprints(docs, width, seed, rule.words), "fps")
    # every distinct fingerprint is a node, with a number of its own: also those that only rows without a doc_id have
    reps = saved(fps.groupBy("fp").agg(F.min("doc_id").alias("least")).withColumn("rep", F.monotonically_increasing_id()), "reps")
    nodes = components(near_links(reps, rule, hot))
    roots = reps.join(nodes, reps["rep"] == nodes["node"], "left").select("fp", "least", F.coalesce("root", "rep").alias("root"))
    roots = saved(roots, "roots")
    names = saved(roots.groupBy("root").agg(F.min("least").alias("component_id")), "names")
    tops = saved(roots.join(names, "root").select("fp", "component_id"), "tops")
    return fps.join(tops, "fp", "left").select("doc_id", "fp", "component_id")


def shingle_sets(docs: DataFrame, width: int, rule: Rule, seed: int = 42) -> DataFrame:
    """doc_id, mark (a hash of the text), fp and set_id (a digest of the set of shingles) of every row."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                b = batch.slice(at, 1000)
                fps, ids = [], []
                for t in b.column("text").to_pylist():
                    own = shingle_set(t or b"", width, seed)
                    fps.append(simhash(own, rule.words))
                    ids.append(hashlib.blake2b(own.tobytes(), digest_size=16).digest())
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("mark"), pa.array(fps, pa.binary()), pa.array(ids, pa.binary())], names=["doc_id", "mark", "fp", "set_id"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"), F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "doc_id long, mark long, fp binary, set_id binary")


def link_similar(sets: list[np.ndarray], sides: np.ndarray, groups: np.ndarray, similarity: tuple[int, int] = SIMILARITY) -> Forest:
    """Link the members whose sets are similar; if there are two sides, only members of different sides are compared, and members
    of one group are linked already, so they are not compared."""
    sizes = np.array([len(x) for x in sets])
    ends = np.cumsum(sizes)
    starts = ends - sizes
    values, flat = np.unique(np.concatenate(sets), return_inverse=True)
    forest, has, (over, under) = Forest(len(sets)), np.zeros(len(values), bool), similarity
    order = np.argsort(groups, kind="stable")
    same = groups[order[1:]] == groups[order[:-1]]
    forest.link(order[:-1][same], order[1:][same])
    both = sides.min() != sides.max()
    for i in range(len(sets) - 1):
        j = np.arange(i + 1, len(sets))
        open_ = (forest.root[j] != forest.root[i]) & (under * np.minimum(sizes[j], sizes[i]) >= over * np.maximum(sizes[j], sizes[i]))
        if both:
            open_ &= sides[j] != sides[i]
        j = j[open_]
        if not len(j):
            continue
        has[flat[starts[i] : ends[i]]] = True
        base = starts[j[0]]
        shared = np.r_[0, np.cumsum(has[flat[base : ends[j[-1]]]], dtype=np.int64)]
        common = shared[ends[j] - base] - shared[starts[j] - base]
        has[flat[starts[i] : ends[i]]] = False
        j = j[under * common >= over * (sizes[j] + sizes[i] - common)]
        forest.link(np.full(len(j), i), j)
    return forest


def _block_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links (a, b) of the blocks (root, low, high) of rows (side, rep, grp, hashes), which follow each other."""

    def links(held: list[tuple]) -> Iterator[pa.RecordBatch]:
        reps = np.array([r for _, r, _, _ in held])
        forest = link_similar([np.frombuffer(h, np.uint64) for *_, h in held], np.array([s for s, *_ in held]), np.array([g for _, _, g, _ in held]))
        moved = np.flatnonzero(forest.root != np.arange(len(reps)))
        yield pa.RecordBatch.from_arrays([pa.array(reps[moved], pa.int64()), pa.array(reps[forest.root[moved]], pa.int64())], names=["a", "b"])

    key, held = None, []
    for batch in batches:
        for root, low, high, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (root, low, high) != key:
                if len(held) > 1:
                    yield from links(held)
                key, held = (root, low, high), []
            held.append(tuple(row))
    if len(held) > 1:
        yield from links(held)


def _pair_links(rows: DataFrame, members_max: int, inside: bool = False) -> DataFrame:
    """Links (a, b) among the rows (root, rep, grp, hashes) of each root, in blocks of two chunks; ``inside``: in blocks of one chunk only. Written."""
    size = F.octet_length("hashes")
    chunks = F.greatest(F.ceil(F.count("*") / members_max), F.ceil(F.sum(size) / CHUNK_BYTES), F.lit(1)).cast("int")
    dealt = rows.join(saved(rows.groupBy("root").agg(chunks.alias("n")), "chunks"), "root").withColumn("side", F.pmod(F.xxhash64("rep"), F.col("n")).cast("int"))
    other = F.col("side") if inside else F.explode(F.sequence(F.lit(0), F.col("n") - 1))
    dealt = dealt.withColumn("k", other).select("root", F.least("side", "k").alias("low"), F.greatest("side", "k").alias("high"), "side", "rep", "grp", "hashes")
    amount = rows.agg(F.count("*"), F.sum(size)).first()
    tasks = max(parts(rows.sparkSession, amount[0], 2000), -(-(amount[1] or 0) // CHUNK_BYTES))
    return saved(dealt.repartition(tasks, "root", "low", "high").sortWithinPartitions("root", "low", "high").mapInArrow(_block_links, "a long, b long"), "similar")


def shingle_rows(texts: DataFrame, width: int, seed: int = 42) -> DataFrame:
    """rep, root and hashes (the set of shingles, sorted) of rows (rep, root, text). Written."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(t or b"", width, seed).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("rep"), batch.column("root"), pa.array(sets, pa.binary())], names=["rep", "root", "hashes"])

    return saved(texts.select("rep", "root", F.col("text").cast("binary").alias("text")).mapInArrow(run, "rep long, root long, hashes binary"), "sets")


def similar_links(docs: DataFrame, members: DataFrame, width: int, seed: int = 42, members_max: int = CHUNK_MEMBERS) -> DataFrame:
    """Links (a, b) of the nodes ``members`` (rep, root, mark): their components are those of all similar pairs that share a root."""
    texts = docs.select(F.xxhash64("text").alias("mark"), "text").join(members, "mark").select("rep", "root", "text")
    return links_within(shingle_rows(texts, width, seed), members_max)


def links_within(sets: DataFrame, members_max: int = CHUNK_MEMBERS) -> DataFrame:
    """Links (a, b) of the sets (rep, root, hashes): their components are those of all similar pairs that share a root.

    The members of a root are compared in chunks of bounded size. Where a root has several chunks, one member of each group
    so found is compared with those of the other chunks, which joins the groups of copies that a large root consists of; only
    roots that are still apart are compared over all pairs of chunks, and members of one group are passed over there.
    """
    near = _pair_links(sets.withColumn("grp", F.col("rep")), members_max, inside=True)
    roots = sets.groupBy("root").agg(F.count("*").alias("m"), F.sum(F.octet_length("hashes")).alias("size"))
    large = saved(roots.where((F.col("m") > members_max) | (F.col("size") > CHUNK_BYTES)).select("root"), "large")
    if large.isEmpty():
        return near
    rows = sets.join(large, "root")

    def grouped(links: DataFrame) -> DataFrame:
        found = components(links).withColumnRenamed("root", "grp")
        return rows.join(found, rows["rep"] == found["node"], "left").select("root", "rep", F.coalesce("grp", "rep").alias("grp"), "hashes")

    heads = saved(grouped(near).where("rep = grp"), "heads")
    near = near.unionByName(_pair_links(heads, members_max))
    now = saved(grouped(near), "grouped")
    apart = now.groupBy("root").agg(F.min("grp").alias("least"), F.max("grp").alias("most")).where("least < most").select("root")
    apart = saved(apart, "apart")
    return near if apart.isEmpty() else near.unionByName(_pair_links(now.join(apart, "root"), members_max))


def keep_one_each(docs: DataFrame, width: int = 5, rule: Rule = SIMILAR, hot: int = HOT_BUCKET) -> DataFrame:
    """``docs`` with one document of each near-duplicate group: that with the smallest doc_id. Null doc_ids stay.

    Two documents are linked if the Jaccard similarity of their distinct shingles is 0.8 or more; groups are components.
    Rows are told apart by doc_id and text, as one doc_id may occur with several texts.
    """
    rows = saved(shingle_sets(docs, width, rule), "fps")
    nodes = rows.groupBy("fp", "set_id").agg(F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "mark"))).alias("first"), F.min("mark").alias("mark"))
    nodes = saved(nodes.withColumn("rep", F.monotonically_increasing_id()), "reps")
    near = components(near_links(nodes.select("fp", "rep"), rule, hot))
    members = saved(nodes.join(near, nodes["rep"] == near["node"]).select("rep", "root", "mark"), "near")
    groups = components(similar_links(docs, members, width))
    tops = nodes.join(groups, nodes["rep"] == groups["node"], "left").select("fp", "set_id", "first", F.coalesce("root", "rep").alias("group"))
    keepers = tops.groupBy("group").agg(F.min("first").alias("keep"))
    found = rows.join(tops.join(keepers, "group").select("fp", "set_id", "keep"), ["fp", "set_id"])
    gone = found.where("doc_id is not null and (doc_id <> keep.doc_id or mark <> keep.mark)").select("doc_id", "mark").distinct()
    # a row travels as one struct, so no name of its columns can clash with the keys beside it
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("mark"))
    return whole.join(gone, ["doc_id", "mark"], "left_anti").select("row.*")

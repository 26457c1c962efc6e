"""Spelling variants: words within one edit of each other, by forward and backward minimal acyclic automata.

Two words one inserted, deleted or replaced code point apart agree on the first half or on the last half of the shorter
one. So a word stands in four buckets: by its first and by its last half, among words of its own length and one more, and
of its own length and one less. Buckets are dealt out, and a task builds, for each length and direction, the minimal
acyclic automaton of its words (of the reversed words in the backward direction) and looks up each word: the half is
matched exactly, the rest is completed with one error. The counts of words below the automaton's edges add up to a
word's number, so an answer is a number, and the same one found twice is dropped. A pair that agrees on both halves
counts in the forward direction only. A task returns, of each word, the number of near words and the best of them; pairs never
leave it. A bucket of very many words is dealt into chunks of dictionary words, and all its words are looked up in each.

Forms point to words of at least ten times the count, so a chain is short; roots are found by pointer doubling.

Defined results: null, empty and letterless texts have no words; a null doc_id counts as an empty one in the damage;
repeated rows count as often as they stand there; words of any length take part; of equally frequent near words the
smallest is the form; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import parts, prepare, saved

LEAST_LENGTH, LEAST_COUNT, FACTOR = 7, 2, 10
#: One in so many words of a text loses a code point before it is counted; 0: none does.
DAMAGED = 31
#: Dictionary words of a bucket that one task takes; rows of a task; words looked up at once; distinct words counted at once.
HOT_BUCKET, TASK_ROWS, BLOCK, HELD = 100_000, 100_000, 2048, 200_000
#: A table of an automaton's edges by state and label has at most so many cells; beyond, edges are searched.
CELLS = 8_000_000


def damaged(run: str, raw: bytes, prefix: int, one_in: int) -> str:
    """``run`` (``raw`` in UTF-8), without a code point if ``one_in`` divides the CRC-32 that goes on from ``prefix``."""
    h = zlib.crc32(raw, prefix)
    if h % one_in:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def vocabulary(docs: DataFrame, least: int = LEAST_LENGTH, times: int = LEAST_COUNT, one_in: int = DAMAGED) -> DataFrame:
    """word and n of the words of at least ``least`` code points that occur ``times`` times: runs of Latin letters, A-Z lower-cased."""
    prepare(docs.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = re.compile(f"[a-zÀ-ÿ]{{{least},}}")
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], names=["word", "n"])
            total.clear()
            return batch

        for batch in batches:
            for doc, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                own = Counter(letters.findall(text.lower().decode(errors="replace")))  # of bytes: only A-Z change
                if one_in:
                    prefix = zlib.crc32(f"{'' if doc is None else doc}:".encode())
                    for word, n in own.items():
                        word = damaged(word, word.encode(), prefix, one_in)
                        if len(word) >= least:
                            total[word] += n
                else:
                    total.update(own)
                if len(total) > HELD:
                    yield out()
        if total:
            yield out()

    rows = docs.where("text is not null").select("doc_id", F.col("text").cast("binary").alias("text"))
    return rows.mapInArrow(run, "word string, n long").groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= times)


class Automaton:
    """The minimal acyclic automaton of distinct sorted words, as rows of codes (0: past the end), with perfect-hash numbers."""

    def __init__(self, codes: np.ndarray, lengths: np.ndarray) -> None:
        n, width = codes.shape
        differ = codes[1:] != codes[:-1]
        shared = np.r_[-1, differ.argmax(axis=1)] if n > 1 else np.array([-1])
        self.labels_max = int(codes.max(initial=0)) + 2  # one label more, of no edge
        known: dict[tuple[bool, bytes], int] = {}
        first: list[np.ndarray] = []  # packed edges (label, target) of each state
        self.final_of: list[bool] = []
        below_starts, below = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for depth in range(width, -1, -1):
            starts = np.flatnonzero((lengths >= depth) & (shared < depth))  # the first word through each node of the trie
            final = lengths[starts] == depth
            packed = (codes[below_starts, depth].astype(np.int64) << 32) | below if len(below) else np.zeros(0, np.int64)
            bounds = np.searchsorted(below_starts, starts)
            fan = np.diff(np.r_[bounds, len(below_starts)])
            state = np.empty(len(starts), np.int64)
            # nodes with one edge at most, which are the most, are told apart all at once
            for end in (False, True):
                for k, rows in ((0, np.flatnonzero((fan == 0) & (final == end))), (1, np.flatnonzero((fan == 1) & (final == end)))):
                    if not len(rows):
                        continue
                    keys, back = np.unique(packed[bounds[rows]], return_inverse=True) if k else (np.zeros(1, np.int64), np.zeros(len(rows), np.int64))
                    state[rows] = np.array([self._state(known, first, end, keys[j : j + k]) for j in range(len(keys))])[back]
            for j in np.flatnonzero(fan > 1).tolist():
                state[j] = self._state(known, first, bool(final[j]), packed[bounds[j] : bounds[j] + fan[j]])
            below_starts, below = starts, state
        self.root = int(below[0])
        self.final = np.array(self.final_of)
        fan = np.array([len(x) for x in first])
        self.bounds = np.r_[0, np.cumsum(fan)]
        edges = np.concatenate(first) if len(first) else np.zeros(0, np.int64)
        self.label, self.target = edges >> 32, edges & 0xFFFFFFFF
        count = np.zeros(len(first), np.int64)
        self.skip = np.zeros(len(edges), np.int64)
        for s in range(len(first)):  # states come after those that they lead to
            a, b = self.bounds[s], self.bounds[s + 1]
            sums = np.cumsum(count[self.target[a:b]]) + self.final[s] if b > a else ()
            if b > a:
                self.skip[a + 1 : b] = sums[:-1]
                self.skip[a] = self.final[s]
            count[s] = sums[-1] if b > a else self.final[s]
        source = np.repeat(np.arange(len(first)), fan)
        self.keys = source * self.labels_max + self.label
        self.table = None
        if len(first) * self.labels_max <= CELLS:
            self.table = np.full(len(first) * self.labels_max, -1, np.int32)
            self.table[self.keys] = np.arange(len(edges))

    def _state(self, known: dict, first: list[np.ndarray], final: bool, edges: np.ndarray) -> int:
        key = (final, edges.tobytes())
        if key not in known:
            known[key] = len(first)
            first.append(edges)
            self.final_of.append(final)
        return known[key]

    def edge(self, state: np.ndarray, label: np.ndarray) -> np.ndarray:
        """The edges from the states by the labels; -1: none."""
        key = state * self.labels_max + label
        if self.table is not None:
            return self.table[key].astype(np.int64)
        at = np.minimum(np.searchsorted(self.keys, key), max(len(self.keys) - 1, 0))
        return np.where(self.keys[at] == key, at, -1) if len(self.keys) else np.full(len(key), -1)

    def near(self, codes: np.ndarray, lengths: np.ndarray, exact: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, number) of the dictionary words one error after ``exact`` codes away from each row. Rows of the ``longest`` length may
        lose a code; the others may have one replaced, or gain one."""
        padded = np.c_[codes, np.zeros(len(codes), codes.dtype)].astype(np.int64)
        row, state, number = np.arange(len(codes)), np.full(len(codes), self.root), np.zeros(len(codes), np.int64)
        for p in range(exact):
            at = self.edge(state, padded[row, p])
            row, at, number = row[at >= 0], at[at >= 0], number[at >= 0]
            state, number = self.target[at], number + self.skip[at]
        pool = [np.zeros(0, np.int64)] * 4  # row, position, state, number after the error
        rows_found, numbers_found = [], []
        p = exact
        while len(row) or len(pool[0]):
            new = [pool]
            if len(row):
                own, size = padded[row, p], lengths[row]
                drop = (size == longest) & (p < size) & (padded[row, np.minimum(p + 1, padded.shape[1] - 1)] != own)
                new.append([row[drop], np.full(drop.sum(), p + 1), state[drop], number[drop]])
                grow = size < longest
                r, s, u, o = row[grow], state[grow], number[grow], own[grow]
                fan = self.bounds[s + 1] - self.bounds[s]
                at = np.repeat(self.bounds[s], fan) + np.arange(fan.sum()) - np.repeat(np.cumsum(fan) - fan, fan)
                r, u, o = np.repeat(r, fan), np.repeat(u, fan), np.repeat(o, fan)
                other = self.label[at] != o  # a code put in before its like is found behind it
                at, r, u, o = at[other], r[other], u[other], o[other]
                to, u = self.target[at], u + self.skip[at]
                inside = p < lengths[r]
                new.append([r, np.full(len(r), p), to, u])
                new.append([r[inside], np.full(inside.sum(), p + 1), to[inside], u[inside]])
                more = p < size
                at = np.where(more, self.edge(state, own), -1)
                row, at, number = row[at >= 0], at[at >= 0], number[at >= 0]
                state, number = self.target[at], number + self.skip[at]
            r, q, s, u = (np.concatenate(x) for x in zip(*new, strict=True))
            end = q == lengths[r]
            done = end & self.final[s]
            rows_found.append(r[done])
            numbers_found.append(u[done])
            r, q, s, u = r[~end], q[~end], s[~end], u[~end]
            at = self.edge(s, padded[r, q])
            r, q, u, at = r[at >= 0], q[at >= 0], u[at >= 0], at[at >= 0]
            pool = [r, q + 1, self.target[at], u + self.skip[at]]
            p += 1
        found = np.unique(np.concatenate(rows_found) * np.int64(1 << 32) + np.concatenate(numbers_found))
        return found >> 32, found & 0xFFFFFFFF


class Dictionary:
    """The words of one direction and length (``m`` code points and one more) in a task, as an automaton."""

    def __init__(self, words: list[str], n: list[int], backward: bool, m: int) -> None:
        self.backward, self.m = backward, m
        self.exact = m - m // 2 if backward else m // 2
        self.codes, lengths = self._codes(words)
        self.alphabet = np.unique(np.r_[np.zeros(1, np.uint32), self.codes.ravel()])
        turned = np.searchsorted(self.alphabet, self._turned(self.codes, lengths)).astype(np.uint32)
        order = np.lexsort(turned.T[::-1])
        self.codes, self.words = self.codes[order], np.array(words, object)[order]
        self.n = np.array(n, np.int64)[order]
        self.automaton = Automaton(turned[order], lengths[order])
        by = np.lexsort((*self.codes.T[::-1], -self.n))
        self.rank = np.empty(len(by), np.int64)
        self.rank[by] = np.arange(len(by))
        self.by = by

    def _codes(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        codes = np.array(words, f"<U{self.m + 1}").view(np.uint32).reshape(len(words), self.m + 1)
        return codes, np.where(codes[:, self.m] > 0, self.m + 1, self.m)

    def _turned(self, codes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        if not self.backward:
            return codes
        short = np.c_[codes[:, self.m - 1 :: -1], np.zeros(len(codes), codes.dtype)]
        return np.where((lengths > self.m)[:, None], codes[:, ::-1], short)

    def best(self, words: list[str]) -> Iterator[tuple[str, int, int, str]]:
        """(word, near words, n of the best one, the best one) of those of ``words`` that have any here."""
        codes, lengths = self._codes(words)
        turned = self._turned(codes, lengths)
        at = np.minimum(np.searchsorted(self.alphabet, turned), len(self.alphabet) - 1)
        strange = self.alphabet[at] != turned  # in no word here
        labels = np.where(strange, self.automaton.labels_max - 1, at).astype(np.uint32)
        row, number = self.automaton.near(labels, lengths, self.exact, self.m + 1)
        if self.backward and len(row):  # what agrees on both halves counts forward
            half = self.m // 2
            apart = (codes[row, :half] != self.codes[number, :half]).any(axis=1)
            row, number = row[apart], number[apart]
        if not len(row):
            return
        near, low = np.bincount(row, minlength=len(words)), np.full(len(words), len(self.rank))
        np.minimum.at(low, row, self.rank[number])
        for k in np.flatnonzero(near).tolist():
            top = self.by[low[k]]
            yield words[k], int(near[k]), int(self.n[top]), self.words[top]


def _lookups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (backward, m, chunk, own, word, n), sorted, the own words of a dictionary first: each is looked up in its own."""

    def out(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.int64(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=["word", "n_near", "form_n", "form"])

    def found(held: list[tuple], key: tuple | None) -> Iterator[tuple]:
        nonlocal dictionary
        words = [w for w, _, _ in held]
        if dictionary is None and key is not None:
            own = [(w, n) for w, n, mine in held if mine]
            dictionary = Dictionary([w for w, _ in own], [n for _, n in own], key[0], key[1]) if own and len(held) > 1 else False
        for at in range(0, len(words) if dictionary else 0, BLOCK):
            yield from dictionary.best(words[at : at + BLOCK])

    key, held, dictionary, rows = None, [], None, []
    for batch in batches:
        for backward, m, chunk, own, word, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (backward, m, chunk) != key:
                rows += found(held, key)
                key, held, dictionary = (backward, m, chunk), [], None
            elif not own and len(held) >= BLOCK:  # all own words have come
                rows += found(held, key)
                held = []
            held.append((word, n, own))
        if len(rows) >= BLOCK:
            yield out(rows)
            rows = []
    rows += found(held, key)
    if rows:
        yield out(rows)


def near_words(words: DataFrame, hot: int = HOT_BUCKET) -> DataFrame:
    """word, n_near and best (a struct of -n and word) of the distinct words (word, n) that have near ones."""
    spark = words.sparkSession
    prepare(spark)
    size = F.length("word")

    def bucket(backward: bool, m: Column) -> Column:
        half = F.floor(m / 2).cast("int")
        part = F.substring(F.col("word"), size - (m - half) + 1, m - half) if backward else F.substring(F.col("word"), F.lit(1), half)
        return F.struct(F.lit(backward).alias("backward"), m.alias("m"), F.xxhash64(F.lit(backward), m, part).alias("bucket"))

    entries = words.select("word", "n", F.explode(F.array(*[bucket(b, m) for b in (False, True) for m in (size, size - 1)])).alias("e")).select("word", "n", "e.*").where("m > 0")
    crowded = saved(entries.groupBy("bucket").count().where(F.col("count") > hot), "crowded")
    chunks, own = F.lit(0), F.lit(True)
    if not crowded.isEmpty():
        entries = entries.join(crowded, "bucket", "left").withColumn("of", F.coalesce(F.ceil(F.col("count") / hot), F.lit(1)).cast("int"))
        entries = entries.withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("of") - 1)))
        chunks, own = F.col("chunk"), F.pmod(F.xxhash64("word"), F.col("of")) == F.col("chunk")
    dealt = entries.select("bucket", "backward", "m", chunks.alias("chunk"), own.alias("own"), "word", "n")
    tasks = parts(spark, 4 * words.count(), TASK_ROWS)
    order = ["backward", "m", "chunk", F.col("own").desc()]
    looked = dealt.repartition(tasks, "bucket", "chunk").sortWithinPartitions(*order).select("backward", "m", "chunk", "own", "word", "n")
    found = looked.mapInArrow(_lookups, "word string, n_near long, form_n long, form string")
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("word"))).alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """word and root: where the pointers (word, form) lead to in the end. Pointers are doubled until none moves."""
    now = saved(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        then = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        now = saved(now.join(then, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if now.where("moved").isEmpty():
            return now.drop("moved")
        now = now.drop("moved")


def groups(words: DataFrame, factor: int = FACTOR, hot: int = HOT_BUCKET) -> DataFrame:
    """word, form, root, n, n_near and form_n of the distinct words (word, n)."""
    words = saved(words, "words")
    near = near_words(words, hot).select(F.col("word").alias("near_word"), "n_near", F.col("best.word").alias("top"), (-F.col("best.less")).alias("top_n"))
    joined = words.join(near, words["word"] == near["near_word"], "left")
    takes = F.col("top_n") >= factor * F.col("n")
    found = saved(joined.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(takes, F.col("top")).alias("form"), F.when(takes, F.col("top_n")).alias("form_n")), "forms")
    ends = roots(found.where("form is not null"))
    return found.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")

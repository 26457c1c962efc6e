"""A stored text index that answers ranked searches by itself, reading as little of it as the k best need.

    build(docs, "doc_id", ["title", "text"], path)
    StoredIndex.load(spark, path).search("license OR apache", 20)

Four tables, written once: ``postings`` (doc, field, term, tf, positions, in_doc, len) for phrases and NEAR; ``impacts`` (term, level,
doc, tf, len, part), where part is a term's BM25 share in a document but for its idf and level is the part in ``LEVELS`` steps, in
ranges of terms, each in order of (term, falling level), so that statistics skip all but the levels asked for; ``levels`` (term, level, n, top): how many rows a level has
and its largest part; ``totals`` (n, mean). A search reads no text.

OR and AND of words end early. The levels of the query's words, at most LEVELS rows a word, say before anything is read what each level can add to a
score. The highest levels are read first, as far as a few thousand rows go; their documents' whole scores give a k-th best
score, a lower bound for the final one. Then levels are added until what all others can add up to lies below it: no document outside can
come in, so the answer is exact, after two jobs at most. Phrases, NEAR, prefixes and NOT are matched on postings first and scored on the impacts of their words.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructField, StructType

from tessera.operators.search import B, K1, Node, QueryError, _stemmed, by_term, matches, parse, query_terms, safe, terms_of
from tessera.storage import remove

LEVELS = 32
#: Rows that the first look at a query's highest levels reads at least; a query whose words have no more rows than DIRECT is answered at once.
FIRST, DIRECT = 10_000, 200_000
#: Words of whole documents that are grouped at once; a longer document is grouped by itself.
WORDS = 1 << 18
#: Scores are compared and returned to so many digits.
DIGITS = 6
TABLES = ("postings", "impacts", "levels", "totals")


def _part(tf: Column, length: Column, mean: Column | float) -> Column:
    return tf * (K1 + 1) / (tf + K1 * (1 - B + B * length / mean))


def _grouper(fields: list[str], size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What makes postings of sorted documents (doc and the words of each field) in a worker; nested, so that workers need not have this package."""

    def starts_of(values: pa.Array) -> np.ndarray:
        """Where runs of equal values begin."""
        codes = values.dictionary_encode("encode").indices.to_numpy()
        return np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """The batches, cut so that rows of one document, which follow one another, lie in one table."""
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            if held and not held[-1].column(0)[-1].equals(b.column(0)[0]):
                yield pa.Table.from_batches(held)
                held = []
            starts = starts_of(b.column(0))
            if len(starts) > 1:
                yield pa.Table.from_batches([*held, b.slice(0, starts[-1])])
                held = []
            held.append(b.slice(starts[-1]))
        if held:
            yield pa.Table.from_batches(held)

    def group(table: pa.Table) -> pa.RecordBatch:
        """The postings of whole documents: words are numbered, and their places sorted by document, word, field and position."""
        table = table.combine_chunks()
        ids = table.column(0).combine_chunks()
        starts = starts_of(ids)
        run_of_row = np.repeat(np.arange(len(starts)), np.diff(np.r_[starts, len(ids)]))
        words, runs, places, of_field = [], [], [], []
        for k in range(len(fields)):
            lists = table.column(k + 1).combine_chunks()
            n = pc.fill_null(pc.list_value_length(lists), 0).to_numpy()
            words.append(lists.flatten())
            runs.append(np.repeat(run_of_row, n))
            places.append(np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n))
            of_field.append(np.full(n.sum(), k))
        run, place, field = np.concatenate(runs), np.concatenate(places).astype(np.int32), np.concatenate(of_field)
        coded = pa.concat_arrays(words).dictionary_encode()
        code, n = coded.indices.to_numpy().astype(np.int64), len(run)
        key = run * len(coded.dictionary) + code
        if len(starts) < len(ids):  # a document of several rows
            order = np.lexsort((place, field, key))
        elif (shift := n.bit_length()) + (len(starts) * len(coded.dictionary)).bit_length() < 63:  # as numbers these are sorted several times faster than by argsort
            order = np.sort((key << shift) | np.arange(n)) & ((1 << shift) - 1)
        else:
            order = np.argsort(key, kind="stable")
        of_key, of_row = key[order], field[order]
        new_key = np.r_[True, of_key[1:] != of_key[:-1]][:n]
        at = np.flatnonzero(new_key | np.r_[True, of_row[1:] != of_row[:-1]][:n])
        tf, first = np.diff(np.r_[at, n]), new_key[at]
        in_doc = np.zeros(len(at), np.int64)
        if len(at):
            in_doc[first] = np.add.reduceat(tf, np.flatnonzero(first))
        head = order[at]
        return pa.RecordBatch.from_pydict({
            "doc": ids.take(pa.array(starts)).take(pa.array(run[head])), "field": pa.array(fields, pa.string()).take(pa.array(of_row[at])), "term": coded.dictionary.take(pa.array(code[head])),
            "tf": pa.array(tf, pa.int64()), "positions": pa.ListArray.from_arrays(pa.array(np.r_[at, n], pa.int32()), pa.array(place[order])),
            "in_doc": pa.array(in_doc, pa.int64(), mask=~first), "len": pa.array(np.bincount(run, minlength=len(starts))[run[head]], pa.int64()),
        })

    def grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in whole(batches):
            starts = starts_of(table.column(0).combine_chunks())
            sizes = sum(pc.fill_null(pc.list_value_length(table.column(k + 1)), 0).to_numpy().astype(np.int64) for k in range(len(fields)))
            ends = np.r_[starts[1:], table.num_rows]
            before = np.r_[0, np.cumsum(sizes)]
            at = 0
            while at < len(starts):
                to = max(at + 1, int(np.searchsorted(before[ends], before[starts[at]] + size, "right")))
                yield group(table.slice(starts[at], ends[to - 1] - starts[at]))
                at = to

    return grouped


def _counted(docs: DataFrame, id_: str, fields: list[str], stemmed: bool) -> DataFrame:
    """The rows of ``search.postings`` with in_doc, the word's number in all fields (at the first field that has it, else null), and len, the document's words.

    No row is made for a place of a word: the texts are dealt and sorted by document, and their words are grouped in arrays of about ``WORDS``.
    """
    texts = docs.select(F.col(id_).alias("doc"), *[F.col(f).alias(f"t{k}") for k, f in enumerate(fields)]).repartition("doc").sortWithinPartitions("doc")
    wide = texts.select("doc", *[terms_of(F.col(f"t{k}"), stemmed).alias(f"w{k}") for k in range(len(fields))])
    kind = docs.schema[id_].dataType
    schema = StructType([StructField("doc", kind), *[StructField(c, StringType()) for c in ("field", "term")], StructField("tf", LongType()), StructField("positions", ArrayType(IntegerType())), *[StructField(c, LongType()) for c in ("in_doc", "len")]])
    return wide.mapInArrow(_grouper(fields, WORDS), schema)


def build(docs: DataFrame, id_: str, fields: list[str], path: str, stemmed: bool = False, parts: int | None = None) -> None:
    """Write the index of ``docs`` below ``path``; the texts are read once.

    Words are taken from the texts and grouped once: dealing by ranges runs what is below it twice, so that is a table, removed at the end. The impacts are
    made of the stored postings, range by range, without a second exchange.
    """
    spark = docs.sparkSession
    _counted(docs, id_, fields, stemmed).write.mode("overwrite").parquet(f"{path}/counted")
    counted = spark.read.parquet(f"{path}/counted")
    n, words = docs.select(id_).count(), counted.agg(F.sum("tf")).first()[0] or 0
    spark.range(1).select(F.lit(n).cast("long").alias("n"), F.lit(words / n if n else 0.0).alias("mean")).write.mode("overwrite").parquet(f"{path}/totals")
    by_term(counted, parts).write.mode("overwrite").parquet(f"{path}/postings")
    remove(spark, f"{path}/counted")
    rows = spark.read.parquet(f"{path}/postings").where("doc IS NOT NULL AND in_doc IS NOT NULL").select("term", "doc", F.col("in_doc").alias("tf"), "len")
    rows = rows.withColumn("part", _part(F.col("tf"), F.col("len"), F.lit(words / n if n else 1.0)))
    rows = rows.select("term", F.floor(F.col("part") * LEVELS / (K1 + 1)).cast("int").alias("level"), "doc", "tf", "len", "part")
    rows.sortWithinPartitions("term", F.desc("level"), "doc").write.mode("overwrite").parquet(f"{path}/impacts")
    levels = spark.read.parquet(f"{path}/impacts").groupBy("term", "level").agg(F.count("*").alias("n"), F.max("part").alias("top"))
    levels.repartitionByRange("term").sortWithinPartitions("term").write.mode("overwrite").parquet(f"{path}/levels")


class StoredIndex:
    def __init__(self, tables: dict[str, DataFrame], stemmed: bool = False) -> None:
        self.postings, self.impacts, self.levels, self.totals = (tables[t] for t in TABLES)
        self.stemmed, self.spark = stemmed, self.impacts.sparkSession

    @classmethod
    def load(cls, spark: SparkSession, path: str, stemmed: bool = False) -> StoredIndex:
        return cls({t: spark.read.parquet(f"{path}/{t}") for t in TABLES}, stemmed)

    def search(self, query: str, k: int = 20, facets: list[DataFrame] | None = None, direct: int = DIRECT, first: int = FIRST) -> DataFrame:
        """doc, score, error as ``search.search`` gives them."""
        try:
            tree = parse(safe(query))
        except QueryError as e:
            kind = self.impacts.schema["doc"].dataType.simpleString()
            return self.spark.createDataFrame([(None, None, str(e))], f"doc {kind}, score double, error string")
        tree = _stemmed(tree) if self.stemmed else tree
        words = tree.items if tree.kind in ("and", "or") else (tree,)
        if all(x.kind == "term" for x in words):
            found = self._words(list(dict.fromkeys(x.items[0] for x in words)), k, tree.kind == "and", facets or [], direct, first)
        else:
            found = self._tree(tree, facets or [])
        scored = found.select("doc", F.round("score", DIGITS).alias("score"), F.lit(None).cast("string").alias("error"))
        return scored.orderBy(F.desc("score"), "doc").limit(k)

    # --- words only ------------------------------------------------------------------------------------------------------

    def _known(self, words: list[str]) -> tuple[dict[str, float], list[tuple[float, str, int, int]]]:
        """idf by word, and (what it can add, word, level, rows) of the words' levels, the most first."""
        rows = self.levels.where(F.col("term").isin(words)).collect()  # at most LEVELS rows a word
        n = self.totals.first()["n"]
        df: dict[str, int] = {}
        for r in rows:
            df[r["term"]] = df.get(r["term"], 0) + r["n"]
        idf = {w: math.log(1 + (n - d + 0.5) / (d + 0.5)) for w, d in df.items()}
        return idf, sorted(((idf[r["term"]] * r["top"], r["term"], r["level"], r["n"]) for r in rows), reverse=True)

    def cuts(self, words: list[str], k: int, every: bool, facets: list[DataFrame], direct: int = DIRECT, first: int = FIRST) -> tuple[dict[str, float], dict[str, int], list[tuple]]:
        """idf by word, the lowest level of each word whose documents can be among the k best (absent: none), and the steps left out."""
        idf, steps = self._known(words)
        if sum(s[3] for s in steps) <= max(direct, k):
            return idf, {w: 0 for w in idf}, []
        cut: dict[str, int] = {}
        at = seen = 0
        while at < len(steps) and seen < max(first, k):
            cut[steps[at][1]], seen, at = steps[at][2], seen + steps[at][3], at + 1
        if at < len(steps):
            least, found = self._scores(idf, cut, seen, every, facets).select(F.round("score", DIGITS).alias("score"), "doc").orderBy(F.desc("score"), "doc").limit(k).agg(F.min("score"), F.count("*")).first()
            while at < len(steps) and (found < k or self._bound(steps[at:]) >= least - 10.0**-DIGITS):
                cut[steps[at][1]], at = steps[at][2], at + 1
        return idf, cut, steps[at:]

    @staticmethod
    def _bound(steps: list[tuple]) -> float:
        """What a document that is in none but these levels can score at most."""
        most: dict[str, float] = {}
        for value, word, _, _ in steps:
            most[word] = max(most.get(word, 0.0), value)
        return sum(most.values())

    def _scores(self, idf: dict[str, float], cut: dict[str, int], rows_in_cut: int | None, every: bool, facets: list[DataFrame]) -> DataFrame:
        """doc, score of the documents that have a word at or above its cut (every word, if so asked)."""
        weight, chosen = F.lit(0.0), F.lit(False)
        for w, x in idf.items():
            weight = F.when(F.col("term") == w, x).otherwise(weight)
        for w, level in cut.items():
            chosen = chosen | ((F.col("term") == w) & (F.col("level") >= level))
        rows = self.impacts.where(F.col("term").isin(list(idf)))
        if rows_in_cut is not None:
            docs = self.impacts.where(chosen).select("doc").distinct()
            rows = rows.join(F.broadcast(docs) if rows_in_cut <= DIRECT else docs, "doc", "left_semi")  # their number is known before
        for f in facets:
            rows = rows.join(f.select("doc").distinct(), "doc", "left_semi")
        found = rows.groupBy("doc").agg(F.sum(F.col("part") * weight).alias("score"), F.count("*").alias("words"))
        return found.where(F.col("words") == len(idf)) if every else found

    def _words(self, words: list[str], k: int, every: bool, facets: list[DataFrame], direct: int, first: int) -> DataFrame:
        idf, cut, left = self.cuts(words, k, every, facets, direct, first)
        if not idf or every and len(idf) < len(words):
            return self.impacts.where("false").select("doc", F.lit(0.0).alias("score"))
        rows = sum(s[3] for s in self._known(words)[1]) - sum(s[3] for s in left) if left else None
        return self._scores(idf, cut, rows, every, facets)

    # --- any tree --------------------------------------------------------------------------------------------------------

    def _tree(self, tree: Node, facets: list[DataFrame]) -> DataFrame:
        docs = matches(self.postings, tree)
        for f in facets:
            docs = docs.join(f.select("doc").distinct(), "doc", "left_semi")
        totals = self.totals.first()
        n, mean = totals["n"], totals["mean"] or 1.0
        any_of, name = F.lit(False), F.lit(None).cast("string")
        for w, prefix in query_terms(tree):
            fits = F.col("term").startswith(w) if prefix else F.col("term") == w
            any_of, name = any_of | fits, F.when(fits, F.lit(f"{w}*" if prefix else w)).otherwise(name)
        hits = self.impacts.where(any_of).groupBy("doc", name.alias("q")).agg(F.sum("tf").alias("tf"), F.first("len").alias("len"))
        df = hits.groupBy("q").agg(F.count("*").alias("df"))  # a row a word
        rows = hits.join(docs, "doc", "left_semi").join(F.broadcast(df), "q")
        idf = F.log(1 + (F.lit(n) - F.col("df") + 0.5) / (F.col("df") + 0.5))
        return rows.groupBy("doc").agg(F.sum(idf * _part(F.col("tf"), F.col("len"), F.lit(mean))).alias("score"))

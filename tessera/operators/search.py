"""Full-text search: boolean grammar with phrases, NEAR and prefixes, BM25, snippets, optionally on word stems.

Without an index, a search is two scans of the texts: the query's words are counted in each row's tokens, one row of
statistics (documents, mean length, frequencies) comes back, and rows that match are scored where they lie; nothing is
exploded or shuffled but the best k. With an index, postings (doc, field, term, tf, positions), every word of the query
is one filtered scan of them; AND, OR and NOT are semi-joins, unions and anti-joins of document sets, a phrase or NEAR
compares position arrays of one (doc, field) row pair. Scores are positive, larger is better.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass, replace

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

from tessera.functions.stems import porter

K1, B = 1.2, 0.75


def tokens(text: Column) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")


@F.pandas_udf(ArrayType(StringType()))
def stems(words: pd.Series) -> pd.Series:
    """Porter stems of arrays of words; a batch stems each word once."""
    known: dict[str, str] = {}
    return words.map(lambda ws: None if ws is None else [known[w] if w in known else known.setdefault(w, porter(w)) for w in ws])


def terms_of(text: Column, stemmed: bool = False) -> Column:
    return stems(tokens(text)) if stemmed else tokens(text)


def postings(docs: DataFrame, id_: str, fields: list[str], stemmed: bool = False) -> DataFrame:
    """doc, field, term, tf, positions. Write it sorted by term (``by_term``) to make term scans selective."""
    # texts are dealt by document before they become a row a word, so that grouping these moves nothing
    texts = docs.select(F.col(id_).alias("doc"), *[F.col(f).alias(f"t{k}") for k, f in enumerate(fields)]).repartition("doc")
    wide = texts.select("doc", *[terms_of(F.col(f"t{k}"), stemmed).alias(f"w{k}") for k in range(len(fields))])
    per_field = F.explode(F.array(*[F.struct(F.lit(f).alias("field"), F.col(f"w{k}").alias("words")) for k, f in enumerate(fields)]))
    each = wide.select("doc", per_field.alias("f")).select("doc", "f.field", F.posexplode("f.words").alias("pos", "term"))
    return each.groupBy("doc", "field", "term").agg(F.count("*").alias("tf"), F.array_sort(F.collect_list("pos")).alias("positions"))


def by_term(index: DataFrame, parts: int | None = None) -> DataFrame:
    """Postings in ranges of terms, so that a written table's statistics let a word's scan skip nearly all of it."""
    return index.repartitionByRange(*([parts] if parts else []), "term", "doc").sortWithinPartitions("term", "doc")


@dataclass(frozen=True)
class Node:
    kind: str  # term, phrase, near, and, or, not
    items: tuple = ()
    distance: int = 10


class QueryError(ValueError):
    """A query that the grammar does not cover."""


def safe(query: str) -> str:
    """The query itself if it uses operators, else its words quoted, so that punctuation is no syntax."""
    if re.search(r"\b(AND|OR|NEAR|NOT)\b", query):
        return query
    return " ".join('"' + w.replace('"', "") + '"' for w in query.split() if w.replace('"', ""))


def parse(query: str) -> Node:
    """OR binds loosest, then AND (also implied between neighbours), then NOT (left operand less right)."""
    lexed = re.findall(r'"[^"]*"|NEAR\s*\(|[()]|,|[^\s(),"]+|"', query)
    at = 0

    def peek() -> str | None:
        return lexed[at] if at < len(lexed) else None

    def take() -> str:
        nonlocal at
        if at >= len(lexed):
            raise QueryError("unexpected end of the query")
        at += 1
        return lexed[at - 1]

    def words(text: str) -> list[str]:
        return [w for w in re.split(r"[\W_]+", text.lower()) if w]

    def atom() -> Node:
        t = take()
        if t == "(":
            inner = either()
            if take() != ")":
                raise QueryError("missing )")
            return inner
        if t.startswith("NEAR"):
            found, distance = [], 10
            while peek() not in (")", None):
                if peek() == ",":
                    take()
                    distance = int(n) if (n := take()).isdigit() else 10
                else:
                    found += words(take())
            if peek() is None or len(found) < 2:
                raise QueryError("malformed NEAR")
            take()
            return Node("near", tuple(found), distance)
        if t in (")", ",", '"', "AND", "OR", "NOT"):
            raise QueryError(f"unexpected {t}")
        prefix = not t.startswith('"') and t.endswith("*")
        w = words(t)
        if not w:
            return Node("none")
        if len(w) == 1:
            return Node("prefix" if prefix else "term", (w[0],))
        return Node("phrase", tuple(w))

    def less() -> Node:
        left = atom()
        while peek() == "NOT":
            take()
            left = Node("not", (left, atom()))
        return left

    def both() -> Node:
        found = [less()]
        while peek() not in (None, ")", "OR", ","):
            if peek() == "AND":
                take()
            found.append(less())
        found = [f for f in found if f.kind != "none"]
        return found[0] if len(found) == 1 else Node("and", tuple(found)) if found else Node("none")

    def either() -> Node:
        found = [both()]
        while peek() == "OR":
            take()
            found.append(both())
        return found[0] if len(found) == 1 else Node("or", tuple(found))

    tree = either()
    if peek() is not None:
        raise QueryError(f"unexpected {peek()}")
    if tree.kind == "none":
        raise QueryError("empty query")
    return tree


def query_terms(node: Node) -> list[tuple[str, bool]]:
    """(word, is a prefix) of the words that score, each once: those not under the right side of NOT."""
    if node.kind in ("term", "prefix", "phrase", "near"):
        return list(dict.fromkeys((w, node.kind == "prefix") for w in node.items))
    items = node.items[:1] if node.kind == "not" else node.items
    return list(dict.fromkeys(t for x in items for t in query_terms(x)))


def _chain(index: DataFrame, words: tuple[str, ...]) -> DataFrame:
    """(doc, field, p0..): a row with the position array of each word."""
    out = None
    for k, w in enumerate(words):
        rows = index.where(F.col("term") == w).select("doc", "field", F.col("positions").alias(f"p{k}"))
        out = rows if out is None else out.join(rows, ["doc", "field"])
    return out


def matches(index: DataFrame, node: Node) -> DataFrame:
    """The documents (doc) that the tree selects, each once."""
    if node.kind == "none":
        return index.where("false").select("doc")
    if node.kind == "term":
        return index.where(F.col("term") == node.items[0]).select("doc").distinct()
    if node.kind == "prefix":
        return index.where(F.col("term").startswith(node.items[0])).select("doc").distinct()
    if node.kind == "phrase":
        rows = _chain(index, node.items)
        start = F.col("p0")
        for k in range(1, len(node.items)):
            start = F.array_intersect(start, _shift(F.col(f"p{k}"), k))
        return rows.where(F.size(start) > 0).select("doc").distinct()
    if node.kind == "near":
        rows = _chain(index, node.items)
        rest = [F.col(f"p{k}") for k in range(1, len(node.items))]
        hit = F.exists("p0", lambda p: _within(p, p, rest, node.distance + 1))
        return rows.where(hit).select("doc").distinct()
    first, *others = (matches(index, x) for x in node.items)
    for other in others:
        first = first.join(other, "doc", {"and": "left_semi", "not": "left_anti"}[node.kind]) if node.kind != "or" else first.unionByName(other)
    return first.distinct() if node.kind == "or" else first


def _shift(positions: Column, k: int) -> Column:
    return F.transform(positions, lambda p: p - k)


def _within(low: Column, high: Column, rest: list[Column], span: int) -> Column:
    """Some choice of a position from each of ``rest`` keeps all within ``span``."""
    if not rest:
        return F.lit(True)
    return F.exists(rest[0], lambda p: (F.greatest(high, p) - F.least(low, p) <= span) & _within(F.least(low, p), F.greatest(high, p), rest[1:], span))


def bm25(index: DataFrame, docs: DataFrame, terms: list[tuple[str, bool]], lengths: DataFrame) -> DataFrame:
    """doc, score over the ``docs`` given: Robertson and Zaragoza's BM25, terms summed over all fields.

    ``lengths`` (doc, len) covers all documents; N and the mean length come from one aggregate over it, document
    frequencies from the terms' own postings.
    """
    any_of = F.lit(False)
    name = None
    for w, prefix in terms:
        fits = F.col("term").startswith(w) if prefix else F.col("term") == w
        any_of = any_of | fits
        label = F.lit(f"{w}*" if prefix else w)
        name = F.when(fits, label) if name is None else name.when(fits, label)
    hits = index.where(any_of).withColumn("q", name).groupBy("doc", "q").agg(F.sum("tf").alias("tf"))
    stats = lengths.agg(F.count("*").alias("n"), F.avg("len").alias("mean"))
    df = hits.groupBy("q").agg(F.count("*").alias("df"))
    rows = hits.join(docs, "doc", "left_semi").join(F.broadcast(df), "q").join(lengths, "doc").crossJoin(F.broadcast(stats))  # df: a row per query term; stats: one row
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    part = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("len") / F.col("mean")))
    return rows.groupBy("doc").agg(F.sum(part).alias("score"))


def _stemmed(node: Node) -> Node:
    """The tree with the stems of its words; prefixes stay."""
    if node.kind in ("term", "phrase", "near"):
        return replace(node, items=tuple(porter(w) for w in node.items))
    return node if node.kind in ("prefix", "none") else replace(node, items=tuple(_stemmed(x) for x in node.items))


def _places(words: Column, term: str) -> Column:
    return F.array_compact(F.transform(words, lambda w, i: F.when(w == term, i)))


def _near(places: list[Column], distance: int) -> Column:
    """Some choice of a place of each word has at most ``distance`` words between its ends."""
    return F.exists(places[0], lambda p: _within(p, p, places[1:], distance + 1))


def _holds(node: Node, fields: list[Column]) -> Column:
    """Whether a row with the token arrays ``fields`` is selected by the tree."""
    if node.kind == "none":
        return F.lit(False)
    if node.kind in ("and", "or", "not"):
        first, *others = (_holds(x, fields) for x in node.items)
        for other in others:
            first = first & other if node.kind == "and" else first | other if node.kind == "or" else first & ~other
        return first
    some = F.lit(False)
    for words in fields:
        if node.kind == "term":
            some = some | F.array_contains(words, node.items[0])
        elif node.kind == "prefix":
            some = some | F.exists(words, lambda w: w.startswith(node.items[0]))
        elif node.kind == "phrase":  # no token holds a space
            some = some | F.contains(F.concat(F.lit(" "), F.array_join(words, " "), F.lit(" ")), F.lit(f" {' '.join(node.items)} "))
        else:
            some = some | _near([_places(words, t) for t in node.items], node.distance)
    return some


def _may_hold(node: Node, low: list[Column]) -> Column:
    """A cheap condition that every row selected by the tree meets: its words' letters occur in the lower-cased texts ``low``."""
    if node.kind == "none":
        return F.lit(False)
    if node.kind == "not":
        return _may_hold(node.items[0], low)
    if node.kind in ("and", "or"):
        first, *others = (_may_hold(x, low) for x in node.items)
        for other in others:
            first = first & other if node.kind == "and" else first | other
        return first
    some = F.lit(False)
    for text in low:
        all_ = F.lit(True)
        for word in node.items:
            all_ = all_ & F.contains(text, F.lit(word))
        some = some | all_
    return some


def _scan(docs: DataFrame, id_: str, fields: list[str], tree: Node, facets: list[DataFrame], stemmed: bool) -> DataFrame:
    """doc, score of the matches, without an index."""
    if stemmed:
        rows = docs.select(F.col(id_).alias("doc"), *[terms_of(F.col(f), True).alias(f"w{k}") for k, f in enumerate(fields)])
        words = [F.col(f"w{k}") for k in range(len(fields))]
        sizes, low = [F.size(ws) for ws in words], None
    else:  # words are counted without being taken apart; only texts that hold a term's letters are
        rows = docs.select(F.col(id_).alias("doc"), *[F.col(f).alias(f"t{k}") for k, f in enumerate(fields)])
        texts = [F.col(f"t{k}") for k in range(len(fields))]
        words, low = [tokens(t) for t in texts], [F.lower(F.coalesce(t, F.lit(""))) for t in texts]
        sizes = [F.regexp_count(t, F.lit(r"[\p{L}\p{N}]+")) for t in low]

    def count(term: str, prefix: bool) -> Column:
        hit = (lambda w: w.startswith(term)) if prefix else (lambda w: w == term)
        each = [F.size(F.filter(ws, hit)) for ws in words]
        if low is not None:
            each = [F.when(F.contains(t, F.lit(term)), n).otherwise(0) for t, n in zip(low, each, strict=True)]
        return sum(each[1:], each[0])

    terms = query_terms(tree)
    tf = [count(*t).alias(f"tf{k}") for k, t in enumerate(terms)]
    holds = _holds(tree, words) if low is None else _may_hold(tree, low) & _holds(tree, words)
    counted = rows.select("doc", sum(sizes[1:], sizes[0]).alias("len"), *tf, holds.alias("hit"))
    n, mean, *df = counted.agg(F.count("*"), F.avg("len"), *[F.count(F.when(F.col(f"tf{k}") > 0, 1)) for k in range(len(terms))]).first()  # one row
    hits = counted.where("hit")
    for f in facets:
        hits = hits.join(f.select("doc").distinct(), "doc", "left_semi")
    score = F.lit(0.0)
    for k, d in enumerate(df):
        t = F.col(f"tf{k}")
        score = score + math.log(1 + (n - d + 0.5) / (d + 0.5)) * t * (K1 + 1) / (t + K1 * (1 - B + B * F.col("len") / (mean or 1.0)))
    return hits.select("doc", score.alias("score"))


def search(docs: DataFrame, id_: str, fields: list[str], query: str, k: int = 20, index: DataFrame | None = None, facets: list[DataFrame] | None = None, stemmed: bool = False) -> DataFrame:
    """doc, score of the ``k`` best matches, best first, ties by id. ``facets``: tables with a column doc; each must name a match.

    ``stemmed``: words meet by their Porter stems; an index must then have been built so. A malformed query gives one row
    with doc null and its message in error.
    """
    spark = docs.sparkSession
    try:
        tree = parse(safe(query))
    except QueryError as e:
        kind = docs.schema[id_].dataType.simpleString()
        return spark.createDataFrame([(None, None, str(e))], f"doc {kind}, score double, error string")
    tree = _stemmed(tree) if stemmed else tree
    if index is None:
        scored = _scan(docs, id_, fields, tree, facets or [], stemmed)
    else:
        found = matches(index, tree)
        for f in facets or []:
            found = found.join(f.select("doc").distinct(), "doc", "left_semi")
        lengths = docs.select(F.col(id_).alias("doc"), sum((F.size(tokens(F.col(f))) for f in fields[1:]), F.size(tokens(F.col(fields[0])))).alias("len"))
        scored = bm25(index, found, query_terms(tree), lengths)
    return scored.select("doc", F.round("score", 6).alias("score"), F.lit(None).cast("string").alias("error")).orderBy(F.desc("score"), "doc").limit(k)


def snippet(text: Column, terms: list[str], size: int = 32, marks: tuple[str, str] = ("<b>", "</b>")) -> Column:
    """About ``size`` words around the first match, matches marked."""
    words = F.split(F.coalesce(text, F.lit("")), r"\s+")
    bare = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]", "")
    hits = F.transform(words, lambda w: bare(w).isin(*terms))
    first = F.coalesce(F.nullif(F.array_position(hits, True), F.lit(0)), F.lit(1)).cast("int")
    start = F.greatest(F.lit(1), first - size // 4)
    cut = F.slice(words, start, F.lit(size))
    shown = F.array_join(F.transform(cut, lambda w: F.when(bare(w).isin(*terms), F.concat(F.lit(marks[0]), w, F.lit(marks[1]))).otherwise(w)), " ")
    return F.concat(F.when(start > 1, "...").otherwise(""), shown, F.when(F.size(words) >= start + size, "...").otherwise(""))


def best_snippet(text: Column, terms: list[str], size: int = 32, marks: tuple[str, str] = ("<b>", "</b>")) -> Column:
    """The ``size`` words around the matches that hold most different terms (then most matches, then the first), matches marked.

    A window begins at each match; the best one is moved left by half of what its matches leave free. Without a match it is the first one.
    """
    words = F.split(F.trim(F.coalesce(text, F.lit(""))), r"\s+")
    known = F.array(*[F.lit(t) for t in terms]) if terms else F.array().cast("array<string>")
    bare = lambda w: F.regexp_replace(F.lower(w), r"[^\p{L}\p{N}]", "")

    once = lambda value, then: F.get(F.transform(F.array(value), then), F.lit(0))  # noqa: E731  a value used many times is made once

    def window(ws: Column, ids: Column) -> Column:
        starts = F.filter(F.sequence(F.lit(1), F.size(ids)), lambda k: F.get(ids, k - 1) > 0)
        hits = lambda s: F.filter(F.slice(ids, s, F.lit(size)), lambda x: x > 0)
        rank = lambda s: once(hits(s), lambda h: F.struct(F.size(F.array_distinct(h)).alias("d"), F.size(h).alias("n"), (-s).alias("s")))
        best = F.coalesce(-F.array_max(F.transform(starts, rank))["s"], F.lit(0))
        last = lambda s: F.array_max(F.filter(F.sequence(s, F.least(s + size - 1, F.size(ids))), lambda k: F.get(ids, k - 1) > 0))
        begin = once(best, lambda s: F.when(s > 0, s - F.least(s - 1, F.floor((size - (last(s) - s + 1)) / 2))).otherwise(1).cast("int"))
        return once(begin, lambda b: F.concat(F.when(b > 1, "...").otherwise(""), marked(F.slice(ws, b, F.lit(size)), F.slice(ids, b, F.lit(size))), F.when(F.size(ws) >= b + size, "...").otherwise("")))

    def marked(ws: Column, ids: Column) -> Column:
        return F.array_join(F.zip_with(ws, ids, lambda w, k: F.when(k > 0, F.concat(F.lit(marks[0]), w, F.lit(marks[1]))).otherwise(w)), " ")

    coded = once(words, lambda ws: F.struct(ws.alias("ws"), F.transform(ws, lambda w: F.array_position(known, bare(w)).cast("int")).alias("ids")))
    return once(coded, lambda c: window(c["ws"], c["ids"]))

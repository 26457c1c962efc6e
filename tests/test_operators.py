from __future__ import annotations

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.operators import dedup, intervals, lookup, quality, search, vectors

SPANS = st.lists(st.tuples(st.sampled_from("xy"), st.integers(0, 120), st.integers(0, 40)), min_size=1, max_size=25)


@given(SPANS, SPANS, st.sampled_from([7, 30, 1000]))
@settings(max_examples=10, deadline=None)
def test_binned_overlap_join_equals_the_plain_one(spark, a, b, width):
    left = spark.createDataFrame([(k, g, s, s + n) for k, (g, s, n) in enumerate(a)], "a long, ga string, sa long, ea long")
    right = spark.createDataFrame([(k, g, s, s + n) for k, (g, s, n) in enumerate(b)], "b long, gb string, sb long, eb long")
    on = ("ga", "sa", "ea"), ("gb", "sb", "eb")
    got = sorted((r["a"], r["b"]) for r in intervals.overlap_join(left, right, *on, width=width).collect())
    want = sorted((i, j) for i, (g, s, n) in enumerate(a) for j, (h, t, m) in enumerate(b) if g == h and s + n >= t and s <= t + m)
    assert got == want == sorted((r["a"], r["b"]) for r in intervals.overlap_join(left, right, *on).collect())


def test_pair_overlaps(spark):
    rows = [("m_A", "2R", 10_966_645, 13_213_848, "p"), ("c_D", "2R", 10_628_099, 11_168_099, "q"), ("z", "2R", 13_213_848, 13_213_900, "p"), ("no", None, 1, 5, "p"), ("zero", "2R", 0, 99_999_999, "p"), ("cross", "3L", 17, 5, "p")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "o int, id string, chr string, start long, end long, fam string")
    got = {(r["id_a"], r["id_b"]): (r["overlap_start"], r["overlap_end"], r["overlap_bp"], r["is_cross"]) for r in intervals.pair_overlaps(df, "id", "o", label="fam").collect()}
    assert got == {("m_A", "c_D"): (10_966_645, 11_168_099, 201_455, True), ("m_A", "z"): (13_213_848, 13_213_848, 1, False)}


def test_lift(spark):
    rows = [("r", 1, "X", 10, 20), ("r", 2, "Y", 5, 6), ("r", 3, "Y", 1, 9), ("r", 4, "X", 30, 40), ("r", 5, None, None, None), ("r", 6, "X", 0, 3), ("s", 1, None, 1, 1)]
    df = spark.createDataFrame(rows, "region string, pos int, chr string, s long, e long")
    got = [tuple(r) for r in intervals.lift(df, ["region"], ("chr", "s", "e"), ["pos"]).orderBy("region").collect()]
    assert got == [("r", 6, "X", 10, 40, 2, 2), ("s", 1, None, None, None, 1, 0)]


def test_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, [0.0, 0.0]), (3, [-3.0, -4.0]), (4, [4.0, 3.0])], "vec_id long, embedding array<float>")
    got = [tuple(r) for r in vectors.semantic_topk(df, vectors.literal([3.0, 4.0]), 3).collect()]
    assert got == [(1, 1.0), (4, 0.96), (2, 0.0)]
    ids = spark.createDataFrame([(3,), (99,)], "vec_id long")
    assert [r["vec_id"] for r in vectors.semantic_topk(df, vectors.literal([3.0, 4.0]), 3, ids=ids).collect()] == [3]
    assert [[round(x, 6) for x in r[0]] for r in df.orderBy("vec_id").select(vectors.normalise(F.col("embedding"))).collect()] == [[0.6, 0.8], [0.0, 0.0], [-0.6, -0.8], [0.8, 0.6]]
    same = spark.range(2).select(vectors.hashed_embedding(F.lit("One two, two")).alias("v")).distinct().collect()
    assert len(same) == 1 and sum(x * x for x in same[0]["v"]) == pytest.approx(1)


WORDS = ["alpha", "beta", "gamma", "delta", "alphabet"]


def holds(node: search.Node, words: list[str]) -> bool:
    """Brute-force evaluation of a query tree over one document."""
    if node.kind == "none":
        return False
    if node.kind == "term":
        return node.items[0] in words
    if node.kind == "prefix":
        return any(w.startswith(node.items[0]) for w in words)
    if node.kind == "phrase":
        return any(words[i : i + len(node.items)] == list(node.items) for i in range(len(words)))
    if node.kind == "near":
        import itertools

        places = [[i for i, w in enumerate(words) if w == t] for t in node.items]
        return any(max(p) - min(p) <= node.distance + 1 for p in itertools.product(*places))
    if node.kind == "not":
        return holds(node.items[0], words) and not holds(node.items[1], words)
    return {"and": all, "or": any}[node.kind](holds(x, words) for x in node.items)


def test_boolean_search_equals_brute_force(spark):
    rng = random.Random(4)
    docs = [(k, " ".join(rng.choice(WORDS) for _ in range(rng.randrange(0, 9)))) for k in range(60)]
    df = spark.createDataFrame(docs, "id long, body string")
    index = search.postings(df, "id", ["body"]).cache()
    for q in ["alpha", "alpha beta", "alpha AND beta OR gamma", '"alpha beta"', "alpha NOT beta", "(alpha OR gamma) NOT delta", "alph* NOT alpha", "NEAR(alpha beta, 1)", "NEAR(alpha beta gamma, 2)", '"beta gamma" OR "delta delta"', "nothing"]:
        tree = search.parse(q)
        got = sorted(r["doc"] for r in search.matches(index, tree).collect())
        assert got == [k for k, t in docs if holds(tree, t.split())], q
        with_index, without = (search.search(df, "id", ["body"], q, 100, i).collect() for i in (index, None))
        tree = search.parse(search.safe(q))
        assert with_index == without and sorted(r["doc"] for r in without) == [k for k, t in docs if holds(tree, t.split())], q


def test_search_queries(spark):
    df = spark.createDataFrame([(1, "red fox", None), (2, "red red fox jumps over", "dog"), (3, "blue", "red")], "id long, a string, b string")
    found = search.search(df, "id", ["a", "b"], "red fox", 10).collect()
    assert [r["doc"] for r in found] == [1, 2] and all(r["score"] > 0 for r in found)
    assert [r["doc"] for r in search.search(df, "id", ["a", "b"], "red", 10, facets=[spark.createDataFrame([(3,), (3,)], "doc long")]).collect()] == [3]
    for bad in ("AND", "red AND", "NEAR(red", "", '""'):
        (row,) = search.search(df, "id", ["a"], bad, 10).collect()
        assert row["doc"] is None and row["error"]
    assert search.safe("what's up?") == '"what\'s" "up?"' and search.safe("a AND b") == "a AND b"
    snip = spark.range(1).select(search.snippet(F.lit("a b c Red, fox d e f g h i j k l m n"), ["red"], 6)).first()[0]
    assert "<b>Red,</b>" in snip and snip.endswith("...")
    words = ["jumping", "jumped", "jumps", "class", "bodies", "is", "relational", "été", "x2"]
    (stems,) = spark.createDataFrame([(words,)], "w array<string>").select(search.stems("w")).first()
    assert stems == ["jump", "jump", "jump", "class", "bodi", "is", "relat", "été", "x2"]
    found = search.search(spark.createDataFrame([(1, "it runs"), (2, "running late"), (3, "a ruin")], "id long, body string"), "id", ["body"], "running", stemmed=True)
    assert {r["doc"] for r in found.collect()} == {1, 2}


def test_near_duplicates_report_the_first_earlier_row(spark):
    rows = [(1, "g", ["aaaa", "bbbb", "cccc", "dddd"]), (2, "g", ["aaaa", "bbbb", "cccc", "dddd", "eeee"]), (3, "g", ["aaaa", "bbbb", "cccc", "dddd"]), (4, None, ["aaaa", "bbbb", "cccc", "dddd"]), (5, "g", []), (6, None, ["aaaa", "bbbb", "cccc", "dddd"])]
    df = spark.createDataFrame(rows, "id long, g string, t array<string>")
    got = {r["id"]: r["earlier"] for r in dedup.near_duplicates(df, ["g"], "id", "id", "t").collect()}
    assert got == {2: 1, 3: 1, 6: 4}


def test_records(spark):
    df = spark.createDataFrame([("a ", 1, None), ("A", 2, 5), (" b", 3, 1), (None, 4, 1), (None, 5, 1)], "name string, pos long, score long")
    assert sorted(r["pos"] for r in dedup.first_wins(df, [dedup.folded(F.col("name"))], ["pos"]).collect()) == [1, 3, 4]
    assert sorted(r["pos"] for r in dedup.best_record(df, [dedup.folded(F.col("name"))], [F.col("score")], ["pos"]).collect()) == [2, 3, 4]
    merged = dedup.full_merge(spark.createDataFrame([("k", None), ("a", 1)], "k string, v long"), spark.createDataFrame([("k", 2), ("b", 3)], "k string, v long"), "k", ["v"], ("x", "y"))
    assert sorted(tuple(r) for r in merged.collect()) == [("a", 1, "x"), ("b", 3, "y"), ("k", 2, "x+y")]
    d = spark.range(1).select(dedup.compare_lists(F.array(F.lit("a"), F.lit("b")), F.array(F.lit("b"), F.lit("c"))).alias("d")).first()["d"]
    assert (d["added"], d["dropped"], d["stable"], round(d["stability"], 6)) == (["c"], ["a"], ["b"], 0.333333)
    curated = spark.createDataFrame([("g", "retinitis RPX47")], "k string, name string")
    proposed = spark.createDataFrame([("g", "RPX47 disease"), ("g", "ALS1 disease"), ("h", "RPX47 disease")], "k string, name string")
    kept = sorted(tuple(r) for r in dedup.unmatched_by_token(curated, proposed, "k", "name").collect())
    assert kept == [("g", "ALS1 disease"), ("g", "retinitis RPX47"), ("h", "RPX47 disease")]
    terms = dedup.decode(spark.createDataFrame([("g", ["x", "no", "y"])], "k string, ids array<string>"), "k", "ids", spark.createDataFrame([("x", "X"), ("y", "Y")], "id string, term string"), "id", 2)
    assert [r["term"] for r in terms.collect()] == ["X"]


def test_lookups(spark):
    names = spark.createDataFrame([("Wing",), ("w2",), ("old",), ("none",)], "query string")
    g = spark.createDataFrame([("id1", "wing"), ("id2", "w2")], "id string, symbol string")
    s = spark.createDataFrame([("id2", "WING", True), ("id1", "old", False), ("id2", "old", True)], "id string, syn string, cur boolean")
    got = {r["query"]: (r["id"], r["tier"]) for r in lookup.resolve(names, [(g, "id", "id", []), (g, "symbol", "id", []), (s, "syn", "id", [~F.col("cur")])]).collect()}
    assert got == {"Wing": ("id1", 1), "w2": ("id2", 1), "old": ("id2", 2)}
    df = spark.createDataFrame([("Zinc oxide", "A", 1), ("Zinc oxide", "—", 2), ("Zinc oxide", "", 3)], "drug string, label string, pos int")
    assert [r["id"] for r in lookup.letters(df, "drug", "label", ["pos"]).orderBy("pos").collect()] == ["zinc_oxide_A", "zinc_oxide_A", "zinc_oxide_B"]
    like = spark.createDataFrame([("50% of",), ("500",)], "t string").where(lookup.containing(F.col("t"), "50%")).collect()
    assert [r["t"] for r in like] == ["50% of"]


def test_quality_checks(spark):
    b = spark.createDataFrame(
        [("g", "b1", "c", "d", "wing size reduced strongly", "high", "low", 'says "the wings were much smaller than normal ones"'), ("g", "b2", "c", "d", "wing size reduced strongly", None, "low", 'says "an entirely invented sentence of this text"')],
        "fbgn string, bullet_id string, category string, direction string, phenotype string, confidence string, text_specificity string, evidence_text string")
    assert [tuple(r)[:4] for r in quality.repeated_bullets(b).collect()] == [("g", "bullet.near_duplicate", "warn", "b2")]
    inputs = spark.createDataFrame([("g", "The wings were much smaller than normal ones.")], "fbgn string, text string")
    assert {r["item"] for r in quality.weak_grounding(b, inputs, "fbgn", "phenotype", "text", "bullet_id").collect()} == {"b1", "b2"}
    assert [r["item"] for r in quality.quotes_not_found(b, inputs, "fbgn", "evidence_text", "text", "bullet_id").collect()] == ["b2"]
    cited = quality.ids_in_text(spark.createDataFrame([("g", "FBrf0000001 FBrf0000001")], "fbgn string, t string"), "fbgn", "t")
    assert [r["value"] for r in cited.collect()] == ["FBrf0000001"]
    many = spark.createDataFrame([("g", "high", "low")] * 20 + [("h", None, None)] * 3, "fbgn string, confidence string, text_specificity string")
    assert sorted((r["entity"], r["code"]) for r in quality.distributions(many).collect()) == [("g", "confidence.over_confident"), ("g", "specificity.too_low"), ("h", "confidence.all_null")]
    few = quality.cohort_outliers(spark.createDataFrame([(1, 100), (900, 100)], "v long, s int"), "v", "s").collect()
    assert all(not r["is_outlier"] and r["z"] is None for r in few)
    rows = [(v, 100) for v in (10, 11, 9, 10, 12, 10, 11, 9, 10, 11, 10, 9, 200)]
    got = quality.cohort_outliers(spark.createDataFrame(rows, "v long, s int"), "v", "s").where("is_outlier").collect()
    assert [(r["v"], r["s"]) for r in got] == [(200, 94)]
    raw = spark.createDataFrame([("x", "bad", "either", "abcdef", "high", "e"), ("y", "other", None, "abc", None, "e"), ("z", "other", "either", "abcdef", "odd", " ")], "id string, category string, direction string, phenotype string, confidence string, evidence_text string")
    fixed = {r["id"]: (r["category"], r["direction"], r["confidence"], r["lint"]) for r in quality.lint(raw, ("other",), ("either",), ("high",)).collect()}
    assert fixed == {"x": ("other", "either", "high", ["category.coerced"]), "z": ("other", "either", None, ["confidence.invalid", "evidence.missing"])}

"""The stored text index against searches without one, and against what it says it reads."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from tessera.operators import ranked, search


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(6)
    words = [f"w{k}" for k in range(60)] + ["running", "runs", "fox", "foxes"]
    weight = [1 / (k + 1) for k in range(len(words))]
    rows = [(k, rng.choice(["red fox", "blue", "w1 w2", None]), " ".join(rng.choices(words, weight, k=rng.choice([0, 3, 10, 40, 200])))) for k in range(3000)]
    return spark.createDataFrame(rows, "id long, title string, body string").cache()


@pytest.fixture(scope="module")
def index(spark, corpus, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    ranked.build(corpus, "id", ["title", "body"], path, parts=4)
    return ranked.StoredIndex.load(spark, path)


QUERIES = ["w1", "w3 w50", "w0 OR w59", "w40 OR w41 OR w0 OR nothing", "w2 AND w30 AND w0", "w0 AND nothing", "nothing", '"w1 w2"', "NEAR(w5 w9, 3)", "w3* AND fox", "w7 NOT w0", "(w55 OR w56) AND w1", "red fox"]


@pytest.mark.parametrize("direct", [ranked.DIRECT, 0])
@pytest.mark.parametrize("query", QUERIES)
def test_same_as_without_an_index(corpus, index, query, direct):
    want = search.search(corpus, "id", ["title", "body"], query, 25).collect()
    got = index.search(query, 25, direct=direct, first=200)
    assert [(r["doc"], pytest.approx(r["score"], abs=2e-6)) for r in got.collect()] == [(r["doc"], r["score"]) for r in want]


def test_facets_come_before_the_limit(spark, corpus, index):
    facets = [corpus.where("id % 7 = 0").select(F.col("id").alias("doc"))]
    want = search.search(corpus, "id", ["title", "body"], "w2 OR w40", 15, facets=facets).collect()
    got = index.search("w2 OR w40", 15, facets, direct=0, first=100).collect()
    assert [r["doc"] for r in got] == [r["doc"] for r in want] and len(got) == 15


def test_common_words_are_cut(index):
    """Documents that have only the common word are no candidates, and the levels left out cannot reach the k-th score."""
    idf, cut, left = index.cuts(["w0", "w58"], 10, False, [], direct=0, first=100)
    rows = {w: sum(s[3] for s in index._known(["w0", "w58"])[1] if s[1] == w) for w in ("w0", "w58")}
    read = sum(rows.values()) - sum(s[3] for s in left)
    assert idf["w58"] > 5 * idf["w0"] and "w58" in cut and read < sum(rows.values()) / 3


def test_no_text_is_read(index, corpus):
    plan = index.search("w2 OR w40", 5, direct=0)._jdf.queryExecution().toString()
    assert "impacts" in plan and "body" not in plan and "postings" not in plan
    assert "EqualTo(term,w40)" in plan or "In(term" in plan
    assert "TakeOrderedAndProject" in plan
    malformed = index.search("(w1 AND", 5).collect()
    assert malformed[0]["error"] and malformed[0]["doc"] is None


def test_empty_tables_and_stems(spark, tmp_path):
    empty = spark.createDataFrame([], "id long, body string")
    ranked.build(empty, "id", ["body"], f"{tmp_path}/e")
    assert ranked.StoredIndex.load(spark, f"{tmp_path}/e").search("a OR b").collect() == []
    df = spark.createDataFrame([(1, "it runs"), (2, "running late"), (3, "a ruin"), (4, None)], "id long, body string")
    ranked.build(df, "id", ["body"], f"{tmp_path}/s", stemmed=True)
    got = ranked.StoredIndex.load(spark, f"{tmp_path}/s", stemmed=True).search("running").collect()
    want = search.search(df, "id", ["body"], "running", stemmed=True).collect()
    assert [(r["doc"], r["score"]) for r in got] == [(r["doc"], r["score"]) for r in want] and len(got) == 2


def test_snippets_show_the_best_window(spark):
    show = lambda text, terms, size: spark.range(1).select(search.best_snippet(F.lit(text), terms, size, ("[", "]"))).first()[0]
    assert show("a red b c d e f g h Red fox, i j", ["red", "fox"], 4) == "...h [Red] [fox,] i..."
    assert show("red red x y red fox", ["red", "fox"], 3) == "...[red] [fox]"
    assert show("a b c", ["z"], 2) == "a b..." and show(None, ["z"], 2) == "" and show("z", ["z"], 5) == "[z]" and show("a b", [], 5) == "a b"

from __future__ import annotations

import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tessera.functions import positions, render, scoring, text


def values(spark, column, rows, schema="t string"):
    return [r[0] for r in spark.createDataFrame([r if isinstance(r, tuple) else (r,) for r in rows], schema).select(column).collect()]


@pytest.mark.parametrize(
    ("region", "want"),
    [("2L:5,000,000-6,000,000", ("2L", 5_000_000, 6_000_000)), ("2L:5e6-6e6", ("2L", 5_000_000, 6_000_000)), ("X: 5_000 - 6_000", ("X", 5000, 6000)), ("2L", None), ("2L:1-2x", None), ("2L:e-e", None)],
)
def test_regions(spark, region, want):
    assert positions.parse_region(region) == want
    if region != "2L:e-e":
        (got,) = values(spark, positions.region_column(F.col("t")), [region])
        assert (tuple(got) if got else None) == want


def test_positions(spark):
    got = values(spark, positions.parse_position(F.col("t")), ["14.29 Mb", "12,294,089 bp", "13.5", "250000", "x", None, "1.2.3 Mb"])
    assert got == [int(14.29 * 1_000_000), 12_294_089, 13_500_000, 250_000, None, None, None]


def test_intervals(spark):
    got = values(spark, positions.parse_interval(F.col("t")), ["14.05–14.55 Mb", "10,966,645–13,213,848 bp", "3L:17.76–3R:5.85 Mb", "1-2", None])
    assert [tuple(x) for x in got] == [(14_050_000, 14_550_000), (10_966_645, 13_213_848), (17_760_000, 5_850_000), (None, None), (None, None)]


def test_locations(spark):
    got = values(spark, positions.parse_location(F.col("t")), ["2L:100..200(-1)", "X:5..9(1)", "bad"])
    assert [tuple(x) if x else None for x in got] == [("2L", 100, 200, "-"), ("X", 5, 9, "+"), None]


def test_tokens(spark):
    got = values(spark, text.content_tokens(F.col("t")), ["The Mutant flies SHOW reduced, reduced wing-size in 2023!", None, ""])
    assert got == [["reduced", "wing", "size", "2023"], None, []]


def test_tags(spark):
    t = "Larvae show defects in the Malpighian tubules, wings and CNS; third instar larva; eyes. Embryonic lethal"
    assert values(spark, text.lexicon_tags(F.col("t")), [t]) == [["Malpighian tubule", "central nervous system", "eye", "wing"]]
    assert values(spark, text.life_stages(F.col("t")), [t]) == [["embryonic", "larval"]]
    assert values(spark, text.alleles(F.col("t")), ["per01, w1118 and shi[ts1], abc9, FBal0001234 FBal0001234"]) == [["FBal0001234", "per01", "shits1", "w1118"]]


def test_citations(spark):
    (got,) = values(spark, text.citations(F.col("t")), ["see FBrf0000002 and hdm_sub, FBrf0000001, FBrf0000002; CURATOR NOTES"])
    assert [(c["type"], c["value"]) for c in got] == [("fbrf", "FBrf0000002"), ("fbrf", "FBrf0000001"), ("section", "hdm_sub"), ("section", "other_comments_sub")]


def test_specificity(spark):
    rows = [("short", "nothing"), ("about half", "20% of 5 flies"), ("severely reduced", ""), ("x" * 80, "12 hr"), (None, None)]
    assert values(spark, text.specificity(F.col("a"), F.col("b")), rows, "a string, b string") == ["low", "high", "low", "medium", "low"]


def test_quality_and_quadrants(spark):
    q = scoring.annotation_quality(*[F.col(c) for c in "abcdef"])
    rows = [(30, 25, 500, True, True, True), (0, 0, 0, False, False, False), (4, 0, 0, None, False, False), (3, 25, 500, True, True, True), (None, None, None, None, None, None)]
    got = values(spark, q, rows, "a long, b long, c long, d boolean, e boolean, f boolean")
    assert got == pytest.approx([1.0, 0.0, 0.3 * math.log1p(4) / math.log1p(30), 0.7 - 0.15 + 0.3 * math.log1p(3) / math.log1p(30), 0.0])
    assert values(spark, scoring.quadrant(F.col("e"), F.col("q")), [(0.55, 0.5), (0.55, 0.49), (0.54, 0.5), (0.5, 0.4)], "e double, q double") == ["STRONG", "NOVEL_LEAD", "LIKELY_NOT", "CANT_RULE_OUT"]


@given(st.lists(st.lists(st.sampled_from([*scoring.PENALTIES, "unknown"]), max_size=12), min_size=1, max_size=12))
@settings(max_examples=8, deadline=None)
def test_issue_score_is_bounded(spark, codes):
    got = values(spark, scoring.issue_score(F.col("c")), [(c,) for c in codes], "c array<string>")
    assert got == [max(0, 100 - sum(scoring.PENALTIES.get(x, 0) for x in c)) for c in codes]


def test_golden_scores(spark):
    p = "citation.phantom_fbrf"
    assert values(spark, scoring.issue_score(F.col("c")), [([p],), ([p] * 2,), ([p] * 5,), ([],), (None,)], "c array<string>") == [75, 50, 0, 100, 100]
    assert values(spark, scoring.band(F.col("s")), [(90,), (70,), (69,)], "s int") == ["accept", "audit", "redo"]
    assert values(spark, scoring.half_even(F.col("x"), 0.5), [(1.25,), (0.75,)], "x double") == [1.0, 1.0]


def test_answers(spark):
    got = values(spark, text.strip_fences(F.col("t")), ['```json\n{"a": 1}\n```', 'well {"a": {"b": 2}} done', " plain "])
    assert got == ['{"a": 1}', '{"a": {"b": 2}}', "plain"]
    kinds = values(spark, text.error_kind(F.col("s"), F.col("b")), [(429, ""), (200, "you've hit your usage limit"), (500, "x"), (200, "ok")], "s int, b string")
    assert kinds == ["rate_limit", "quota", "api_error", None]


def test_rendering(spark):
    assert values(spark, positions.format_bp(F.col("n")), [(None,), (5,), (1500,), (2_500_000,)], "n long") == ["\u2014", "5 bp", "1,500 bp", "2.50 Mb"]
    assert values(spark, render.link(F.col("a"), F.col("b"), F.col("c")), [("1", "d", "r"), ("", "d", "r"), (None, " ", "r"), (None, None, None)], "a string, b string, c string") == [
        "https://pubmed.ncbi.nlm.nih.gov/1/", "https://doi.org/d", "https://example.org/ref/r", None]
    assert render.markdown(["a"], [(None,), ("x|y",)]).endswith("| x\\|y |")
    bundle = spark.createDataFrame([(["a"] * 20, {"s": "\n".join(map(str, range(100)))})], "abstracts array<string>, sections map<string,string>")
    assert [(len(r[0]), len(r[1]["s"].split("\n"))) for level in (1, 2) for r in render.shrink(bundle, level).collect()] == [(10, 50), (5, 30)]

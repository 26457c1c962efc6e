from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions import bundles
from tessera.operators import quality
from tessera.plans import reports
from test_plans import world  # noqa: F401


def test_reports(world, spark):  # noqa: F811
    atlas, docs = world
    assert "1 pairs, 1 across families" in reports.overlaps(atlas) and "| q1 | q2 |" in reports.overlaps(atlas)
    one = reports.region(atlas, "q1", phenotype="two")
    assert "| 1 | sym2 |" in one and "phenotype number 2" in one
    assert reports.entity(atlas, "sym1").startswith("# sym1 (FBgn0000001)") and "not found" in reports.entity(atlas, "zz")
    issues = spark.createDataFrame([("FBgn0000001", "omim.phantom", "error")], "entity string, code string, severity string")
    assert "| omim.phantom | error | 1 |" in reports.quality_summary(quality.scores(docs, issues), issues)
    a = spark.createDataFrame([("d", "x"), ("d", "y")], "g string, i string")
    b = spark.createDataFrame([("d", "y"), ("e", "z")], "g string, i string")
    assert "| d |  | x | y | 0.5 |" in reports.before_after(a, b, "g", "i") and "| e | z |  |  | 0.0 |" in reports.before_after(a, b, "g", "i")


def test_bundles(world, spark):  # noqa: F811
    _, docs = world
    got = {r["fbgn"]: (r["n_bullets"], r["n_citations"], r["n_tissues"], r["n_omim"], r["n_lint"]) for r in bundles.summaries(docs).collect()}
    assert got["FBgn0000003"] == (3, 6, 6, 1, 0)
    b = spark.createDataFrame([("g", {"auto_summary": "s" * 700, "hdm_sub": " ", "odd": "x"}, [("1", "a" * 2000), ("2", None)])], "k string, sections map<string,string>, abstracts array<struct<pmid:string,abstract:string>>")
    r = bundles.compact(b).first()
    assert ({k: len(v) for k, v in r["sections"].items()}, len(r["abstracts"][0]["abstract"])) == ({"auto_summary": 600}, 1500)
    assert tuple(bundles.sizes(b, "k").first()) == ("g", 702, 2000, 2, 1)
    own = spark.sql("SELECT array(named_struct('synonym', 'sym', 'type', 'a'), named_struct('synonym', 'x', 'type', 'secondary_fbgn'), named_struct('synonym', 'y', 'type', null)) AS s")
    assert own.select(bundles.aliases(F.col("s"), F.lit("sym"))).first()[0] == ["y"]
    c = docs.where("fbgn = 'FBgn0000001'").select(bundles.shown_citations(F.col("bullets")[0]["citations"])).first()[0]
    assert [(x["label"], x["url"]) for x in c] == [("FBrf0000001", "https://example.org/ref/FBrf0000001")]
    p = spark.sql("SELECT array(named_struct('symbol', 'O', 'terms', array(named_struct('term', 't', 'definition', repeat('d', 200))))) AS o, array(named_struct('name', 'D', 'terms', array('u', 'v'))) AS d")
    text = p.select(bundles.inference_prompt(F.lit("S"), F.col("o"), F.col("d"))).first()[0]
    assert text == "Entity: S\nO\n  - t: " + "d" * 150 + "\n* D [u; v]"

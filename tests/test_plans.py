"""Sources, the atlas from documents to verbs, streaming and external calls, on literal fixtures."""

from __future__ import annotations

import gzip
import json

import pytest
from pyspark.sql import functions as F

from tessera.operators import flatten
from tessera.plans import atlas
from tessera.plans.facade import Atlas
from tessera.schemas import CATEGORIES, DIRECTIONS, ENTITY, LEVELS, QTL, violations
from tessera.sources import documents as docs
from tessera.sources import tables
from tessera.streaming import external, monitor


def write(path, text):
    path.parent.mkdir(parents=True, exist_ok=True)
    (gzip.open(path, "wt", encoding="utf-8") if path.suffix == ".gz" else open(path, "w", encoding="utf-8")).write(text)
    return f"file://{path}"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_bulk_tables(spark, tmp_path):
    a = tables.alleles_of(spark, write(tmp_path / "a.tsv.gz", "# c\n\nFBal0000001\ta[1]\tFBgn0000001\ta\nFBal0000002\tb[1]\tFBgn0000002\tb\nbad\tx\tFBgn0000003\tc\nFBal0000009\tshort\n"))
    assert rows(a.select("fbal", "fbgn")) == [("FBal0000001", "FBgn0000001"), ("FBal0000002", "FBgn0000002")]
    gp = tables.genotype_phenotypes(spark, write(tmp_path / "g.tsv", 'a[1]/b[1]\tFBal0000001/FBal0000002\tlethal "x"\tid\tq\tqi\tFBrf1\nz\tFBal0000001 FBal0000001\tviable\tid\n'), a)
    assert rows(gp.select("fbgn", "phenotype", "qualifier")) == [("FBgn0000001", 'lethal "x"', "q"), ("FBgn0000001", "viable", None), ("FBgn0000002", 'lethal "x"', "q")]
    ids = tables.annotation_ids(spark, write(tmp_path / "i.tsv", "sym\tDmel\tFBgn0000001\tFBgn9, FBgn8\tCG1\tCG2\n"))
    assert [(s["synonym"], s["type"], s["is_current"]) for s in ids.first()["synonyms"]] == [("FBgn9", "secondary_fbgn", False), ("FBgn8", "secondary_fbgn", False), ("CG1", "annotation_id", True), ("CG2", "secondary_annotation_id", False)]
    o = tables.human_orthologs(spark, write(tmp_path / "o.tsv", "FBgn1\ts\tH:1\tx\tHS\t12\ty\t123[A b],45[C]\nFBgn2\ts\t\tx\tHT\tbad\n"))
    assert [(r["symbol"], r["diopt_score"], [tuple(d) for d in r["diseases"]]) for r in o.orderBy("fbgn").collect()] == [("HS", 12, [("123", "A b"), ("45", "C")]), ("HT", None, [])]
    p = tables.publications(spark, write(tmp_path / "p.tsv", "FBrf1\t11\tx\t10.1/a\tpaper\tDoe, 1999, J. 2001\nFBrf2\t\tx\t\tpaper\tno year\n"))
    assert rows(p.select("fbrf", "pmid", "year")) == [("FBrf1", "11", 1999), ("FBrf2", None, None)]
    gi = tables.genetic_interactions(spark, write(tmp_path / "gi.tsv", "a\tFBgn1|FBgn2\tb\tFBgn3\tenhanceable\tFBrf1\n"))
    assert rows(gi.select("fbgn", "partner", "symbol")) == [("FBgn1", "FBgn3", "a"), ("FBgn2", "FBgn3", "a"), ("FBgn3", "FBgn1", "b"), ("FBgn3", "FBgn2", "b")]
    cells = ["x:FBgn0000001", "x:FBgn0000002", "-", "-", "-", "-", "psi(two (hybrid)", "-", "pubmed:1", "-", "-", "-"]
    pi = tables.physical_interactions(spark, write(tmp_path / "pi.tsv", "\t".join(cells) + "\n" + "\t".join(["x:FBgn0000001"] * 2 + cells[2:]) + "\n"))
    assert rows(pi.select("fbgn", "partner", "method")) == [("FBgn0000001", "FBgn0000002", "hybrid"), ("FBgn0000002", "FBgn0000001", "hybrid")]
    al = tables.alliance_orthologs(spark, write(tmp_path / "al.tsv", "HGNC:1\tHS\tt\tn\tFB:FBgn1\tfly\tt\tn\ta\tb\nFB:FBgn2\tfly2\tt\tn\tMGI:2\tMs\tt\tn\ta\tb\nMGI:2\tMs\tt\tn\tHGNC:1\tHS\tt\tn\ta\tb\n"))
    assert rows(al) == [("FBgn1", "human", "HGNC:1", "HS"), ("FBgn2", "mouse", "MGI:2", "Ms")]
    c = tables.coordinate_map(spark, write(tmp_path / "c.tsv", "Dmel\ts\tFBgn1\t1-1\t21A\t2L:100..200(-1)\nDsim\ts\tFBgn2\t1\t2\t2L:1..2(1)\nDmel\ts\tFBgn3\t1\t2\tnone\n"))
    assert rows(c) == [("FBgn1", "s", "2L", 100, 200, "-")]
    r = tables.regions(spark, write(tmp_path / "r.bed", "# x\nchr\tstart\tend\n2L\t10\t20\tone\n3R 5 9\n"))
    assert rows(r) == [("2L", 10, 20, "one"), ("3R", 5, 9, "3R:5-9")]
    m = tables.mouse_phenotypes(spark, write(tmp_path / "m.tsv", "Abc<tm1>, Def<x>\tg\tb\tMP:1\nAbc<tm2>\tg\tb\tMP:1\n"))
    assert rows(m) == [("Abc", "MP:1"), ("Def", "MP:1")]
    rp = tables.representative_publications(spark, write(tmp_path / "rp.tsv", "FBgn1\ts\tFBrf0000001|PMID:5,FBrf0000002\n"))
    assert rows(rp) == [("FBgn1", 0, "FBrf0000001", "5"), ("FBgn1", 1, "FBrf0000002", None)]


def test_documents_of_other_kinds(spark, tmp_path, smallest):
    obo = docs.ontology(spark, write(tmp_path / "h.obo", 'format: 1\n\n[Term]\nid: HP:1\nname: One\ndef: "A \\"b\\" c." [x]\n\n[Term]\nid: HP:2\nname: Two\nis_obsolete: true\n\n[Typedef]\nid: p\n\n[Term]\nid: HP:3\nname: Three\n'))
    assert rows(obo) == [("HP:1", "One", 'A \\"b\\" c.'), ("HP:3", "Three", None)]
    xml = "<Set><PubmedArticle><PMID Version='1'>7</PMID><Journal><Title>J</Title><PubDate><Year>2001</Year></PubDate></Journal><ArticleTitle>A <i>b</i></ArticleTitle><AbstractText Label='X'>One</AbstractText><AbstractText>two <b>x</b></AbstractText></PubmedArticle><PubmedArticle><PMID>8</PMID></PubmedArticle></Set>"
    assert rows(docs.articles(spark, write(tmp_path / "a.xml", xml))) == [("7", "A b", 2001, "J", "One two x"), ("8", None, None, None, None)]
    page = "<div id='a'>x <b>y</b><script>no</script></div><div id='b'>z<br>w</div><div data='{&quot;refs&quot;: [1, {&quot;k&quot;: [2]}], &quot;z&quot;: 1}'></div><a href=\"u\">l</a>"
    df = spark.createDataFrame([(1, page), (2, None)], "page_id long, html string")
    assert rows(docs.section_texts(df, "page_id", "html", ids=("a", "b"))) == [(1, "a", "x y"), (1, "b", "z w")]
    assert docs.embedded_json(page, '"refs"') == '[1, {"k": [2]}]' and docs.embedded_json("x", "refs") is None and docs.embedded_json("refs: [1", "refs") is None
    assert rows(docs.links(df, "page_id", "html")) == [(1, 0, "u")]
    best = docs.best_orthologs(spark.createDataFrame([(1, "A:3 B:9 A:7 C:1")], "page_id long, html string"), "page_id", "html", r"([A-Z]):(\d)", 2)
    assert rows(best.select("symbol", "score")) == [("A", 7), ("B", 9)]
    cache = spark.createDataFrame([("1", "x")], "key string, payload string")
    got = docs.fetch_missing(spark.createDataFrame([(1,), (2,), (3,)], "pmid long"), cache, "pmid", lambda ks: {k: k * 2 for k in ks if k != "3"})
    assert rows(got) == [("2", "22"), ("3", None)]


TABLE = """
| QTL | Study Drug | Chr | Peak | Interval | x | y | Release | Phenotype |
|-----|-----|-----|-----|-----|-----|-----|-----|-----|
| CA | Carboplatin | X | 14.29 Mb | 14.05–14.55 Mb | 3.32 | 23% | r5 | fertility |
| — | Malathion | 2R | 12,294,089 bp | 10,966,645–13,213,848 bp | — | 344 genes | r6 | survival |
| — | Malathion | 3L | 6,162,469 bp | 5,515,636–6,735,645 bp | — | 145 genes | r6 | survival |
| D | Methotrexate | 3L–3R | 22.24 Mb (3L) | 3L:17.76–3R:5.85 Mb | 1.92 | 10% | r5 | fertility |

text | not a row
"""


def test_region_table(spark, tmp_path):
    got = {r["id"]: r for r in docs.region_table(spark, write(tmp_path / "q.md", TABLE)).collect()}
    assert sorted(got) == ["carboplatin_CA", "malathion_A", "malathion_B", "methotrexate_D"]
    assert (got["carboplatin_CA"]["start_r5"], got["carboplatin_CA"]["start_r6"], got["carboplatin_CA"]["h2"], got["carboplatin_CA"]["neg_log_p"]) == (14_050_000, None, "23%", 3.32)
    assert (got["malathion_A"]["start_r6"], got["malathion_A"]["gene_count"], got["malathion_A"]["neg_log_p"]) == (10_966_645, 344, None)
    assert (got["methotrexate_D"]["start_r5"], got["methotrexate_D"]["end_r5"], got["methotrexate_D"]["peak_r5"]) == (17_760_000, 5_850_000, 22_240_000)


def entity(n: int, **more) -> dict:
    b = {"category": "behavior", "phenotype": f"phenotype number {n}", "direction": "either", "evidence_text": "evidence", "confidence": "high", "citations": [{"type": "fbrf", "value": "FBrf0000001"}, {"type": "ortholog", "species": "human", "symbol": "HS"}], "tissues": ["wing", "wing"], "life_stages": ["adult"], "alleles": []}
    return {
        "schema_version": "1.2", "fbgn": f"FBgn000000{n}", "symbol": f"sym{n}", "notes": None, "synonyms": [{"synonym": f"old{n}", "type": "alias", "is_current": n == 1}],
        "model": {"provider": "p", "model_id": "m", "harness": None}, "source": {"n_pubs_total": 100 * n, "n_abstracts_used": 1},
        "bullets": [{**b, "id": f"FBgn000000{n}:b{k:02}"} for k in range(1, n + 1)], "references": [{"fbrf": "FBrf0000001", "title": "T", "year": 2000 + n, "pmid": "5"}, {"fbrf": f"FBrf000001{n}", "year": None}],
        "go_slim": {"biological_process": ["growth"]}, "cross_species": {"human_orthologs": [{"symbol": "HS", "diopt_score": n}], "mouse_orthologs": [], "human_disease_links": [{"name": "Some Disease", "omim_id": "123", "via_ortholog": {"symbol": "HS", "species": "human", "diopt_score": 3}}], "mouse_phenotype_links": []},
        **more,
    }


@pytest.fixture(scope="module")
def world(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("atlas")
    for n in (1, 2, 3, 4):
        (folder / "docs").mkdir(exist_ok=True)
        (folder / "docs" / f"{n}.json").write_text(json.dumps(entity(n), indent=1))
    (folder / "docs" / "bad.json").write_text("{not json")
    found = docs.entities(spark, f"file://{folder}/docs")
    r6 = spark.createDataFrame([("FBgn0000001", "2L", 100, 200, "+"), ("FBgn0000002", "2L", 150, 300, "-"), ("FBgn0000003", "3R", 5, 9, "+")], "fbgn string, chr string, start long, end long, strand string")
    r5 = spark.createDataFrame([("FBgn0000001", "2L", 90, 190, "+"), ("FBgn0000002", "2L", 140, 290, "-")], r6.schema)
    atlas.build(found, f"file://{folder}/out", r6, r5)
    t = atlas.load(spark, f"file://{folder}/out")
    vec = t["genes"].select("fbgn", F.when(F.col("fbgn").endswith("2"), F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0))).alias("embedding"))
    rows_ = [("q1", "2L", 120, 160, None, None, "fam1"), ("q2", "2L", 160, 900, None, None, "fam2"), ("q3", "2L", None, None, 100, 200, "fam1"), ("q4", "3R", 1, 3, None, None, "fam1")]
    full = [(i, "l", "d", fam, c, None, s, e, None, s5, e5, None, None, None, "r6", "some phenotype", None) for i, c, s, e, s5, e5, fam in rows_]
    return Atlas(t, vec, spark.createDataFrame(full, QTL), lambda text: [1.0, 0.0] if "two" in text else [0.0, 1.0]), found


def test_relations(world):
    a, found = world
    assert found.count() == 4
    n = {k: v.count() for k, v in a.t.items()}
    assert (n["genes"], n["bullets"], n["citations"], n["tissues"], n["refs"], n["orthologs"], n["diseases"], n["go_slim"], n["synonyms"]) == (4, 10, 20, 20, 8, 4, 4, 4, 4)
    assert {r["value"] for r in a.t["citations"].collect()} == {"FBrf0000001", "human:HS"}
    assert {r["fbgn"]: (r["start"], r["start_r5"], r["n_bullets"], r["n_refs"]) for r in a.t["genes"].collect()}["FBgn0000003"] == (5, None, 3, 2)
    assert found.where(F.size(violations()) > 0).count() == 0
    spoiled = found.withColumn("symbol", F.lit("")).withColumn("bullets", F.transform("bullets", lambda b: b.withField("category", F.lit("odd"))))
    assert all(F is not None and len(r[0]) >= 2 for r in spoiled.select(violations()).collect())
    numbered = flatten.number_bullets(found.where("symbol = 'sym3'").withColumn("bullets", F.transform("bullets", lambda b, i: F.when(i == 1, b.withField("phenotype", F.lit("abc"))).otherwise(b)))).first()
    assert [b["id"] for b in numbered["bullets"]] == ["FBgn0000003:b01", "FBgn0000003:b03"]
    assert "other" in CATEGORIES and "unknown" in DIRECTIONS and "low" in LEVELS and "bullets" in ENTITY


def test_verbs(world):
    a, _ = world
    assert {r["metric"]: r["value"] for r in a.stats().collect()}["bullets.n"] == 10
    assert {r["query"]: r["id"] for r in a.resolve(["SYM1", "old2", "FBgn0000003", "zz"]).collect()} == {"SYM1": "FBgn0000001", "old2": "FBgn0000002", "FBgn0000003": "FBgn0000003"}
    g = a.gene("sym2").first()
    assert (len(g["bullets"]), [r["year"] for r in g["refs"]], [t["tissue"] for t in g["tissues"]]) == (2, [2002, None], ["wing"])
    assert [r["doc"] for r in a.search("number AND 3", category="behavior", tissue="WING").collect()] == ["FBgn0000003"]
    assert a.search("number", category="immune").count() == 0
    assert [r["gene"] for r in a.disease("some dis").collect()] == ["sym1", "sym2", "sym3", "sym4"] and a.disease("123").count() == 4 and a.disease("1").count() == 0
    assert [r["diopt_score"] for r in a.ortholog("hs").collect()] == [4, 3, 2, 1]
    assert a.paper("5").count() == 4 and [r["gene"] for r in a.paper("FBrf0000013").collect()] == ["sym3"]
    assert [r["n_bullets"] for r in a.tissue("Wing").collect()] == [4, 3, 2, 1]
    assert [r["n_in_cat"] for r in a.category("behavior", "high").collect()] == [4, 3, 2, 1] and a.category("behavior", "low").count() == 0
    assert a.go("GROW").count() == 4
    assert [r["fbgn"] for r in a.region("2L:200-260").collect()] == ["FBgn0000001", "FBgn0000002"] and a.region("2L").columns == ["error"]
    lifted = a.lift("2L:100-180", "r5").first()
    assert (lifted["target_chr"], lifted["target_start"], lifted["target_end"], lifted["dropped"]) == ("2L", 100, 300, 0)
    assert [r["fbgn"] for r in a.semantic("two", 1).collect()] == ["FBgn0000002"]
    assert [r["fbgn"] for r in a.ask("two", "2L:1-400").collect()] == ["FBgn0000002", "FBgn0000001"]
    assert a.semantic_filtered("two", [F.col("category") == "immune"], 3).count() == 0


def test_region_ranking(world):
    a, _ = world
    pairs = a.qtl_overlaps().collect()
    assert [(p["id_a"], p["id_b"], p["overlap_bp"], p["n_items"], p["is_cross"]) for p in pairs] == [("q1", "q2", 1, 2, True)]
    assert a.qtl_overlaps("q4").count() == 0
    ranked = a.qtl_rank(phenotype="two").collect()
    by = {}
    for r in sorted(ranked, key=lambda r: (r["id"], r["rank"])):
        by.setdefault(r["id"], []).append((r["fbgn"], r["evidence"], r["quadrant"]))
    assert set(by) == {"q1", "q2", "q3"} and by["q1"][0][:2] == ("FBgn0000002", 1.0) and [x[0] for x in by["q3"]] == ["FBgn0000002", "FBgn0000001"]
    shared = a.qtl_shared("q1", "q2").collect()
    assert {r["fbgn"] for r in shared} == {"FBgn0000001", "FBgn0000002"}
    assert [a.qtl_shared(*x).first()["error"] for x in (("q1", "nope"), ("q1", "q4"), ("q1", "q3"))] == ["not found: nope", "different chr", "missing coordinates"]


def test_exports(world, spark, tmp_path):
    a, _ = world
    atlas.export_bed(a.t["genes"], f"file://{tmp_path}/bed")
    assert [r["value"] for r in spark.read.text(f"file://{tmp_path}/bed").collect()][0] == "2L\t100\t200\tFBgn0000001|sym1\t1\t+"
    atlas.sharded(a.t["bullets"], "fbgn", f"file://{tmp_path}/sh")
    assert atlas.read_one(spark, f"file://{tmp_path}/sh", "fbgn", "FBgn0000003").count() == 3
    atlas.inverted(a.t, f"file://{tmp_path}/inv")
    assert spark.read.json(f"file://{tmp_path}/inv/by_category").first()["entities"] == [f"FBgn000000{n}" for n in (1, 2, 3, 4)]


def test_streams(spark, tmp_path):
    schema = "id long, ts timestamp, kind string, ok boolean"
    (tmp_path / "in").mkdir()
    lines = [{"id": k, "ts": f"2024-01-01T00:00:{k:02}Z", "kind": "a" if k % 2 else "b", "ok": k % 5 != 0} for k in range(40)]
    (tmp_path / "in" / "1.json").write_text("\n".join(map(json.dumps, lines)))
    source = lambda: monitor.tail(spark, f"file://{tmp_path}/in", schema)
    seen = []
    handle = lambda df, n: (seen.append(df.count()), monitor.route(df, "kind", {"a": f"file://{tmp_path}/a", "b": f"file://{tmp_path}/b"}))
    monitor.drain(source(), f"file://{tmp_path}/c1", handle)
    (tmp_path / "in" / "2.json").write_text(json.dumps({**lines[0], "id": 99}))
    monitor.drain(source(), f"file://{tmp_path}/c1", handle)
    assert [n for n in seen if n] == [40, 1] and spark.read.json(f"file://{tmp_path}/a").count() == 20
    monitor.drain(monitor.rates(source(), "ts", "15 seconds", "1 second", {"bad": "not ok"}), f"file://{tmp_path}/c2", path=f"file://{tmp_path}/rates")
    got = sorted((r["n"], r["bad"]) for r in spark.read.parquet(f"file://{tmp_path}/rates").collect())
    assert got == [(15, 3), (16, 4)]  # the last window stays open
    batch = spark.createDataFrame([("k", k, k % 4 != 3) for k in range(12)], "g string, n long, ok boolean")
    assert rows(monitor.budget_steps(batch, "g", "n", "ok", 2, 1, 3)) == [("k", 2, 2, 12)]
    states = []
    q = monitor.budget_stream(source(), "kind", "id", "ok").writeStream.outputMode("update").option("checkpointLocation", f"file://{tmp_path}/c3").trigger(availableNow=True).foreachBatch(lambda df, n: states.extend(map(tuple, df.collect()))).start()
    q.awaitTermination()
    assert {k for k, _ in states} == {"a", "b"}


def test_external_calls(spark):
    prompts = spark.createDataFrame([("a", "First one. Second."), ("b", "quota please"), ("c", "fails twice"), ("d", "odd")], "k string, p string")

    def model(prompt: str, attempt: int) -> tuple[int, str]:
        if "quota" in prompt:
            return 429, "You exceeded your current quota"
        if "twice" in prompt and attempt < 3:
            raise TimeoutError("slow")
        return (200, "no json") if prompt == "odd" else external.stub(prompt, attempt)

    answers = external.call(prompts, "k", "p", model)
    got = {r["key"]: (r["attempts"], r["outcome"]) for r in external.parsed(answers, "summary string").collect()}
    assert got == {"a": (1, "ok"), "b": (1, "quota"), "c": (3, "ok"), "d": (1, "bad_json")}
    usage = spark.sql("SELECT map('m', named_struct('input', 0L, 'prompt', 7L), 'n', named_struct('input', 3L, 'prompt', 9L)) AS u")
    assert usage.select(external.tokens_used(F.col("u"))).first()[0] == 10


def test_audits_are_appended_once(spark, tmp_path):
    from tessera.streaming import review

    asked: list = []
    answer = '{"verdict": "minor_fixes", "accuracy_score": 0.5, "hallucinations": ["x", "y"]}'
    rows = spark.createDataFrame([(str(k), "p") for k in range(4)], "fbgn string, prompt string")
    log = review.run_audits(rows.limit(2), "fbgn", "prompt", lambda p, n: (200, answer), f"{tmp_path}/log")
    assert log.count() == 2 and not asked
    log = review.run_audits(rows, "fbgn", "prompt", lambda p, n: (200, answer) if n else (500, ""), f"{tmp_path}/log")
    assert sorted((r["key"], r["verdict"], r["n_hallucinations"]) for r in log.collect()) == [(str(k), "minor_fixes", 2) for k in range(4)]
    assert [tuple(r) for r in review.verdict_counts(log).collect()] == [("minor_fixes", 4)]


def test_rerank_and_batch_log(spark):
    from tessera.streaming import external, review

    candidates = spark.createDataFrame([("heat", "g2", "a"), ("heat", "g1", "b")], "phenotype string, fbgn string, snapshot string")
    model = lambda p, n: (200, '{"ranking": [{"fbgn": "g1", "verdict": "strong"}, {"fbgn": "g2", "verdict": "weak"}]}' if p.index("g1") < p.index("g2") else "{}")
    assert [tuple(r) for r in review.rerank(candidates, "phenotype", ["snapshot"], model).orderBy("place").collect()] == [("heat", 1, "g1", "strong"), ("heat", 2, "g2", "weak")]
    inputs = spark.createDataFrame([("a", 5, 1), ("b", 6, 2)], "fbgn string, pubs_total int, n_abstracts int")
    answers = external.parsed(external.call(spark.createDataFrame([("a", "x")], "k string, p string"), "k", "p", lambda p, n: (200, '{"bullets": [{"category": "c"}, {"category": "c"}]}')), review.DISTILLED)
    log = {r["fbgn"]: (r["outcome"], r["n_bullets"], r["categories"]) for r in review.batch_log(inputs, "fbgn", answers).collect()}
    assert log == {"a": ("ok", 2, ["c"]), "b": ("not run", None, None)}


def test_fetches_are_repeated(spark):
    from tessera.sources import documents

    calls: dict = {}

    def get(key: str) -> bytes:
        calls[key] = calls.get(key, 0) + 1
        if key == "bad" or calls[key] < 3:
            raise OSError("no answer")
        return b"x" * (10 if key == "long" else 1)

    got = documents.retrying(get, 4, 5)(["long", "short", "bad"])
    assert got == {"long": "x" * 10, "short": None, "bad": None} and calls == {"long": 3, "short": 4, "bad": 4}


def test_an_older_index_and_documents_are_stored(spark, tmp_path):
    from tessera.operators import canonical, search
    from tessera.plans import atlas
    from tessera.schemas import ENTITY

    docs = spark.createDataFrame([('{"fbgn":"FBgn0000001","symbol":"a","bullets":[{"id":"FBgn0000001:b01","phenotype":"runs fast","evidence_text":"e"}],"_lint":[{"code":"x"}]}',)], "j string").selectExpr(f"from_json(j, '{ENTITY}') as d").select("d.*")
    atlas.build_index(docs, f"{tmp_path}/i")
    assert spark.read.parquet(f"{tmp_path}/i/genes").first()["n_lint"] == 1
    bullets, index = spark.read.parquet(f"{tmp_path}/i/bullets"), spark.read.parquet(f"{tmp_path}/i/postings")
    assert [r["doc"] for r in search.search(bullets, "bullet_id", ["phenotype", "evidence_text"], "runs", index=index).collect()] == ["FBgn0000001:b01"]
    canonical.write_documents(docs, f"{tmp_path}/d")
    back = spark.read.schema(ENTITY).json(f"{tmp_path}/d")
    assert back.first()["bullets"][0]["phenotype"] == "runs fast"
    (row,) = canonical.canonical_json(docs).collect()
    import hashlib

    assert row["sha256"] == hashlib.sha256(row["json"].encode()).hexdigest()
    regions = spark.createDataFrame([("b", "g", 5), ("a", "h", 1)], "label string, fbgn string, start int")
    atlas.write_regions(regions, f"{tmp_path}/t")
    assert spark.read.option("sep", "\t").option("header", True).csv(f"{tmp_path}/t").count() == 2


def test_definitions_of_any_length(spark, tmp_path):
    from tessera.sources import documents

    text = "a \\" + '"quoted\\" ' + "word " * 20_000
    (tmp_path / "x.obo").write_text(f'[Term]\nid: HP:1\nname: n\ndef: "{text}" [x]\n\n[Term]\nid: HP:2\nname: m\n')
    rows = {r["id"]: r["definition"] for r in documents.ontology(spark, str(tmp_path / "x.obo")).collect()}
    assert rows["HP:2"] is None and len(rows["HP:1"]) == len(text)

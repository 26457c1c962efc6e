"""Stored relations: no exchange in joins by key, and point reads that skip."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tessera.operators import flatten
from tessera.plans import stored
from tessera.plans.facade import Atlas


def scanned(df) -> int:
    """Rows that the scans of a plan without exchanges gave."""
    df.collect()
    total, open_ = 0, [df._jdf.queryExecution().executedPlan()]
    while open_:
        node = open_.pop()
        if node.nodeName().startswith(("Scan", "AdaptiveSparkPlan")) or "FileScan" in node.nodeName():
            if node.nodeName().startswith("AdaptiveSparkPlan"):
                open_.append(node.executedPlan())
                continue
            total += node.metrics().apply("numOutputRows").value()
        children = node.children()
        open_ += [children.apply(k) for k in range(children.size())]
    return total


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.fixture(scope="module")
def path(spark, tmp_path_factory):
    place = str(tmp_path_factory.mktemp("stored"))
    genes = spark.range(5000).select(F.format_string("FBgn%07d", "id").alias("fbgn"), F.concat(F.lit("s"), "id").alias("symbol"), (F.col("id") % 9).alias("n_bullets"))
    refs = spark.range(60_000).select(F.format_string("FBgn%07d", F.col("id") % 4000).alias("fbgn"), F.sha2(F.col("id").cast("string"), 256).alias("pmid"), F.col("id").alias("year"), F.lit("t").alias("title"))
    stored.store({"genes": genes, "refs": refs, "totals": spark.range(3)}, "fbgn", place, buckets=8, blooms={"refs": ["pmid"]}, row_group=64 << 10, distinct=2000)
    return place


def test_assembly_without_an_exchange(spark, path, no_broadcast):
    t = stored.attach(spark, path)
    whole = flatten.nested(t["genes"], "fbgn", {"refs": (t["refs"], ["year"], ["pmid", "year"])})
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SortMergeJoin" in plan and "Bucketed: true" in plan
    sizes = whole.groupBy(F.size("refs").alias("n")).count().collect()
    assert {(r["n"], r["count"]) for r in sizes} == {(15, 4000), (0, 1000)} and t["totals"].count() == 3


def test_one_entity_reads_one_bucket(spark, path, no_broadcast):
    t = stored.attach(spark, path)
    own = {k: stored.point(v, "fbgn", ["FBgn0000123"]) for k, v in t.items() if k != "totals"}
    one = flatten.nested(own["genes"], "fbgn", {"refs": (own["refs"], ["year"], ["year"])})
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "SelectedBucketsCount: 1 out of 8" in plan
    assert len(one.first()["refs"]) == 15


def test_point_reads_by_bloom_filter(spark, path):
    refs = stored.attach(spark, path)["refs"]
    known, unknown = refs.where("year = 777").first()["pmid"], "f" * 64
    assert scanned(refs) == 60_000
    found = stored.point(refs, "pmid", [known])
    assert scanned(found) < 15_000 and found.count() == 1
    assert scanned(stored.point(refs, "pmid", [unknown])) < 6000 and "EqualTo(pmid" in found._jdf.queryExecution().toString()


def test_verb_gene_on_stored_tables(spark, tmp_path, no_broadcast):
    genes = spark.createDataFrame([("FBgn1", "a", 2), ("FBgn2", "b", 0)], "fbgn string, symbol string, n_bullets int")
    tables = {
        "genes": genes, "synonyms": spark.createDataFrame([("FBgn1", "x", "t", True)], "fbgn string, synonym string, type string, is_current boolean"),
        "bullets": spark.createDataFrame([("FBgn1", "b1", "c", "p", "d", "e", "high")], "fbgn string, bullet_id string, category string, phenotype string, direction string, evidence_text string, confidence string"),
        "citations": spark.createDataFrame([("FBgn1", "b1", "fbrf", "r", "1", None)], "fbgn string, bullet_id string, type string, value string, pmid string, doi string"),
        "refs": spark.createDataFrame([("FBgn1", "r", "t", "m", 1999, "1", None), ("FBgn1", "s", "t", "m", 2001, "2", None)], "fbgn string, fbrf string, title string, miniref string, year int, pmid string, doi string"),
        "orthologs": spark.createDataFrame([("FBgn2", "human", "h", 3)], "fbgn string, species string, symbol string, diopt_score int"),
        "diseases": spark.createDataFrame([("FBgn1", "n", "1", "v")], "fbgn string, name string, omim_id string, via_symbol string"),
        "tissues": spark.createDataFrame([("FBgn1", "brain")] * 2, "fbgn string, tissue string"), "life_stages": spark.createDataFrame([("FBgn1", "adult")], "fbgn string, stage string"),
    }
    stored.store(tables, "fbgn", f"{tmp_path}/t", buckets=4)
    found = Atlas(stored.attach(spark, f"{tmp_path}/t")).gene("a")
    assert "Exchange" not in found._jdf.queryExecution().executedPlan().toString()
    r = found.first()
    assert [x["fbrf"] for x in r["refs"]] == ["s", "r"] and len(r["tissues"]) == 1 and r["orthologs"] == [] and r["synonyms"][0]["synonym"] == "x"
    assert Atlas(stored.attach(spark, f"{tmp_path}/t")).gene("none").collect() == []

from __future__ import annotations

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tessera.llm import exact


def test_stages_in_order():
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "near_dedup", "mix_sources", "pack"]


def test_each_stage_works_on_what_the_one_before_kept(spark, smallest, documents):
    columns, docs = documents.columns, documents
    kept = []
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, smallest)
        if name != "pack":
            assert out.columns == columns
            assert out.join(docs.select("doc_id"), "doc_id", "left_anti").isEmpty()
        kept.append(out.count())
        docs = out
        if name == "exact_dedup":
            assert exact.duplicates(docs).where("not kept").isEmpty()
    assert kept[0] == documents.count() and kept[1] < kept[0] and kept[2] <= kept[1]


def test_run(spark, smallest):
    rows = corpus_pipeline.run(spark, smallest)
    found = rows.agg(F.count("*"), F.max(F.col("offset") + F.col("length")), F.sum("length")).first()
    assert found[0] > 0 and found[1] <= 4096
    assert rows.select("sequence_id").distinct().count() <= -(-found[2] // 4096) * 1.02 + 1


def test_planted_copies_go_and_clean_documents_stay(spark, make_docs, documents, smallest):
    rng = random.Random(8)
    base = {r["doc_id"]: r["text"] for r in documents.where("n_chars > 800").limit(12).collect()}
    clean = []
    for k in range(30):
        words = " ".join(rng.choice(list(base.values())) for _ in range(3)).split()
        rng.shuffle(words)
        clean.append((5000 + k, " ".join(words[:200]), "en", "src1"))
    planted = [(6000 + k, t + "\n", "en", "src2") for k, (_, t, _, _) in enumerate(clean[:10])]
    planted += [(7000 + k, t.replace(t.split()[90], "novel", 1), "en", "src3") for k, (_, t, _, _) in enumerate(clean[10:20])]
    docs = make_docs(clean + planted).select("doc_id", "text", "lang", "source", "n_chars").unionByName(documents)
    for _, stage in corpus_pipeline.STAGES[:3]:
        docs = stage(spark, docs, smallest)
    left = {r["doc_id"] for r in docs.select("doc_id").collect()}
    survivors = [k for k in range(10) if (5000 + k in left) + (6000 + k in left) == 1]
    assert len(survivors) == 10
    assert all(5010 + k in left and 7000 + k not in left for k in range(10))
    assert all(5020 + k in left for k in range(10))


def test_empty(spark, make_docs):
    docs = make_docs([(1, "a")]).limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, "").collect() == []

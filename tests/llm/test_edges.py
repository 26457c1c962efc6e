"""One matrix for all operators and stages: clashing column names, null columns, repeated rows, very long texts, empty tables."""

from __future__ import annotations

import random

import corpus_pipeline
import pytest
from pyspark.sql import functions as F

from tessera.llm import chunks, exact, langid, mixing, packing, pii, sharding, simhash, warc
from tessera.llm.queries import tokenizer_path

#: Names that operators make inside, with and without underscores.
CLASH = (
    "__id __digest __spans __size __taken __own __copy __end __mark __host __tag __logs __p __prior __k __w __max row key id mark own_mark size taken all own copy end cuts digest rep fp h s d t k "
    "logs prior said shard place name stay keep group root piece length offset sequence_id ids_crc32 spans places seats weight cap house h2 block blocks quota before passes start"
).split()


def wide(spark, rows: list[tuple]):
    """Documents (doc_id, text, lang, source, n_chars) with a column of every name in CLASH that tells its row."""
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"`{c}` string" for c in CLASH)
    full = [(*r, *(None,) * (4 - len(r)), None, *[f"{c}{k}" for c in CLASH]) for k, r in enumerate(rows)]
    return spark.createDataFrame(full, schema)


@pytest.fixture(scope="module")
def awkward(spark):
    rng = random.Random(2)
    words = lambda n, tag: " ".join(f"{tag}{rng.randrange(10**4)}" for _ in range(n))
    long_words, one_word = words(150_000, "w"), "x" * 2_000_000
    near = words(300, "n")
    rows = [(1, None, "en", "a"), (2, "", "en", "a"), (None, words(40, "u"), "en", "a"), (3, long_words, "en", "b"), (4, one_word, "de", None), (5, near, "en", "b"), (5, near, "en", "b"), (6, near + " tail", None, "b"), (None, None, None, None)]
    rows += [(10 + k, words(60, "p"), rng.choice(["en", "de", None]), rng.choice(["a", "b", "c"])) for k in range(30)]
    return wide(spark, rows).cache()


@pytest.mark.parametrize("name", ["language_id", "exact_dedup", "near_dedup", "mix_sources"])
def test_stages_keep_columns_of_any_name(spark, awkward, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    out = stage(spark, awkward, "")
    assert out.columns == awkward.columns
    before = {r["__id"]: r for r in awkward.collect()}
    rows = out.collect()
    for r in rows:
        own = before[r["__id"]]
        assert all(r[c] == own[c] for c in awkward.columns if c != "text")
        assert r["text"] == own["text"] or (name == "mix_sources" and own["text"].startswith(r["text"]))
    left = [r["__id"] for r in rows]
    if name == "language_id":
        assert {"__id0", "__id1", "__id8"}.isdisjoint(left) and {"__id2", "__id3", "__id4", "__id5", "__id6"} <= set(left)
    if name == "exact_dedup":
        assert len(left) == len(before) - 3 and ("__id5" in left) + ("__id6" in left) == 1 and len({"__id0", "__id1", "__id8"} & set(left)) == 1
    if name == "near_dedup":
        assert {"__id2", "__id8"} <= set(left) and "__id7" not in left
    if name == "mix_sources":
        assert {"__id0", "__id1", "__id8"}.isdisjoint(left)
    assert stage(spark, awkward.limit(0), "").collect() == []


def test_all_stages_in_turn(spark, awkward):
    docs = awkward
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, "")
    found = docs.agg(F.sum("length"), F.max(F.col("offset") + F.col("length"))).first()
    assert found[0] > 100_000 and found[1] <= 4096


def test_operators_take_long_texts_and_nulls(spark, awkward):
    n = awkward.count()
    assert exact.duplicates(awkward).count() == n
    assert simhash.near_components(awkward).count() == n
    assert langid.classify(awkward).count() == n
    assert mixing.mix(awkward).agg(F.max("size"), F.count("*")).first() == (150_000, n)
    assert pii.report(awkward).count() == n
    assert sharding.assign(awkward, 1 << 20).agg(F.max("bytes"), F.count("*")).first() == (2_000_000, n)
    pieces = packing.pack_documents(awkward, tokenizer_path())
    assert pieces.where("piece = 0").count() == n and pieces.agg(F.max("length")).first()[0] <= 4096
    spans = chunks.repeated_spans(awkward).collect()
    assert {r["doc_id"] for r in spans} >= {4, 6} and 3 not in {r["doc_id"] for r in spans}


def test_spans_and_masks_keep_columns_of_any_name(spark, awkward):
    cut = chunks.without_spans(awkward, chunks.repeated_spans(awkward))
    assert cut.columns == awkward.columns and cut.count() == awkward.count()
    texts = {r["__id"]: r["text"] for r in cut.collect()}
    assert texts["__id8"] is None and texts["__id5"] == texts["__id6"] and len(texts["__id7"]) < 2000
    docs = wide(spark, [(1, "mail a@b.cd now"), (1, "mail a@b.cd now"), (None, "x@y.zz"), (3, None)])
    masked = pii.mask(docs)
    assert masked.columns == docs.columns and sorted(r["text"] or "" for r in masked.collect()) == ["", "<email>", "mail <email> now", "mail <email> now"]


def test_shards_keep_columns_of_any_name(spark, awkward, tmp_path):
    docs = awkward.where("doc_id is null or doc_id <> 5")
    sharding.write_shards(docs.drop("all"), 1 << 20, f"file://{tmp_path}/s")
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert set(back.columns) == {*docs.columns, "shard_"} - {"all"} and back.count() == docs.count()
    table = sharding.directory(sharding.assign(awkward, 1 << 20))
    rows, slots, deepest = table.agg(F.sum("shard_rows"), F.sum("slots"), F.max("depth")).first()
    assert rows == awkward.count() and (1 << deepest) * 0.9 < slots <= 1 << deepest  # entries of empty prefixes point nowhere


def test_long_pages(spark):
    rng = random.Random(1)
    big = "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(1_500_000))
    pages = spark.createDataFrame([(1, "u", big, "x"), (2, "v", big, "y"), (None, None, None, None)], "page_id long, url string, html string, payload string")
    rows = {r["page_id"]: (r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(pages).collect()}
    n = len(big.encode())
    assert rows == {1: (n, "revisit", 2), 2: (n, "response", None), None: (0, "response", None)}

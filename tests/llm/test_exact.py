from __future__ import annotations

import hashlib
import random

import pytest

from tessera.llm import exact
from tessera.llm.queries import op4_exact_dedup


def brute(rows):
    """doc_id -> (keep_id, group_size, kept, sha) of distinct doc_ids."""
    strip = str.maketrans("", "", " \t\n\x0b\x0c\r")
    groups: dict = {}
    for doc, text in rows:
        groups.setdefault((text or "").translate(strip), []).append((-len(text or ""), doc))
    out = {}
    for norm, own in groups.items():
        keep = min(own)[1]
        for _, doc in own:
            out[doc] = (keep, len(own), doc == keep, hashlib.sha256(norm.encode()).hexdigest())
    return out


def found(df):
    return {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], bytes(r["digest"]).hex()) for r in df.collect()}


def test_query(spark, smallest, documents):
    rows = op4_exact_dedup(spark, smallest).collect()
    want = brute([(r["doc_id"], r["text"]) for r in documents.collect()])
    assert {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"], r["text_sha256"]) for r in rows} == want


@pytest.mark.parametrize("counters", [2, 1000])
def test_heavy_and_light_groups(spark, make_docs, counters):
    rng = random.Random(1)
    rows = [(k, rng.choice(["hot text", "hot  text", "hot\ttext "]) if k % 3 == 0 else f"t{rng.randrange(60)}" + " " * rng.randrange(3)) for k in range(300)]
    assert found(exact.duplicates(make_docs(rows), counters)) == brute(rows)


def test_misra_gries_keeps_the_frequent():
    rng = random.Random(2)
    values = ["a"] * 400 + ["b"] * 250 + [f"x{k}" for k in range(350)]
    rng.shuffle(values)
    kept = exact.misra_gries(iter([values[:500], values[500:]]), 4)
    assert {"a", "b"} <= kept.keys() and len(kept) <= 4 and kept["a"] <= 400


def test_nulls_ties_repeats_empty(make_docs):
    docs = make_docs([(1, None), (2, ""), (3, " \n"), (4, "x"), (4, "x"), (5, "x "), (None, "x "), (6, "\xa0"), (7, "né")])
    got = sorted((r["doc_id"] or -1, r["keep_id"], r["group_size"], r["kept"]) for r in exact.duplicates(docs).collect())
    assert got == [(-1, 5, 4, False), (1, 3, 3, False), (2, 3, 3, False), (3, 3, 3, True), (4, 5, 4, False), (4, 5, 4, False), (5, 5, 4, True), (6, 6, 1, True), (7, 7, 1, True)]
    left = exact.drop_duplicates(docs)
    assert left.columns == docs.columns and sorted(r["doc_id"] for r in left.collect()) == [3, 5, 6, 7]
    assert exact.duplicates(docs.limit(0)).collect() == [] and exact.drop_duplicates(docs.limit(0)).collect() == []


def test_whole_rows_that_repeat_stay_once(make_docs):
    docs = make_docs([(1, "a"), (1, "a"), (1, "b"), (2, "a"), (3, "c")])
    assert sorted((r["doc_id"], r["text"]) for r in exact.drop_duplicates(docs).collect()) == [(1, "a"), (1, "b"), (3, "c")]

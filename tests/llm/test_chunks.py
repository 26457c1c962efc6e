from __future__ import annotations

import random

import numpy as np
import pytest

from tessera.llm import chunks
from tessera.llm.queries import op6_substring_dedup


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(2, 9))) for _ in range(n))


def test_cuts_fall_alike_around_an_insertion():
    rng = random.Random(1)
    text = words(rng, 2000).encode()
    a = chunks.cut_points(text)
    assert a[0] == 0 and (np.diff(a) > 0).all() and np.diff(a).max() <= chunks.WINDOW
    shifted = chunks.cut_points(text[:3000] + b"inserted " + text[3000:])
    far = chunks.WINDOW + chunks.GEAR
    assert set(a[a > 3000 + far] + 9) == set(shifted[shifted > 3009 + far])
    assert set(a[(a < 3000 - far)]) == set(shifted[shifted < 3000 - far])


@pytest.mark.parametrize("text", ["", "a", "é" * 30, "日本語の文" * 100, "a" * 1000, "x" * 79, "x" * 81])
def test_chunks_are_whole_characters(text):
    data = text.encode()
    cuts = chunks.cut_points(data).tolist()
    assert "".join(data[a:b].decode() for a, b in zip(cuts, [*cuts[1:], len(data)][: len(cuts)], strict=True)) == text


def brute(texts: dict[int, str]) -> dict[int, list[tuple[int, int]]]:
    """Spans by the definition of repeated chunks."""
    cut = {d: list(zip(c, [*c[1:], len(t.encode())], strict=True)) for d, t in texts.items() if (c := chunks.cut_points(t.encode()).tolist())}
    first: dict = {}
    for d in sorted(cut):
        for s, e in cut[d]:
            first.setdefault(texts[d].encode()[s:e], (d, s))
    out: dict = {}
    for d in sorted(cut):
        runs: list = []
        for s, e in cut[d]:
            if first[texts[d].encode()[s:e]] != (d, s):
                if runs and runs[-1][1] == s:
                    runs[-1] = (runs[-1][0], e)
                else:
                    runs.append((s, e))
        if kept := [r for r in runs if r[1] - r[0] >= chunks.LEAST]:
            out[d] = kept
    return out


def test_query_against_brute_force(spark, smallest, documents):
    got: dict = {}
    for r in op6_substring_dedup(spark, smallest).collect():
        got.setdefault(r["doc_id"], []).append((r["start"], r["end"]))
    assert {d: sorted(x) for d, x in got.items()} == brute({r["doc_id"]: r["text"] for r in documents.collect()})


def test_every_shared_passage_is_found_and_others_are_left(spark, make_docs):
    rng = random.Random(7)
    passages = [words(rng, 51) for _ in range(20)]
    rows = [(k, words(rng, 80) + " " + (passages[k // 2] if k < 40 else "") + " " + words(rng, 60)) for k in range(80)]
    docs = make_docs(rows)
    spans = chunks.repeated_spans(docs)
    assert {r["doc_id"]: r["first_doc_id"] for r in spans.collect()} == {k: k - 1 for k in range(1, 40, 2)}
    cleaned = chunks.without_spans(docs, spans)
    assert cleaned.columns == docs.columns
    texts = dict(rows)
    for r in cleaned.collect():
        k = r["doc_id"]
        assert (r["text"] == texts[k]) == (k >= 40 or k % 2 == 0)
        assert texts[k].startswith(r["text"][:300]) and texts[k].endswith(r["text"][-300:])


def test_repeats_inside_a_text_nulls_and_empty(make_docs):
    rng = random.Random(9)
    line = words(rng, 60) + "\n"
    docs = make_docs([(1, line * 3 + "end"), (2, None), (3, ""), (None, line * 3), (4, words(rng, 100)), (5, "ü" * 500)])
    got = {r["doc_id"] for r in chunks.repeated_spans(docs).collect()}
    assert got == {None, 1, 5}  # a text may repeat itself, character by character too; a row without an id comes last
    assert chunks.repeated_spans(docs.limit(0)).collect() == []
    same = make_docs([(1, line * 2), (1, line * 2)])
    assert {r["doc_id"] for r in chunks.repeated_spans(same).collect()} == {1}


def test_one_id_with_two_texts(make_docs):
    """A row loses only what its own text repeats, whatever other rows have its id."""
    rng = random.Random(11)
    a, x, b = words(rng, 150), words(rng, 150), words(rng, 400)
    docs = make_docs([(0, a), (1, a + " " + x), (1, b), (1, a + " " + x), (2, b[:900] + " " + words(rng, 90))])
    spans = chunks.repeated_spans(docs)
    assert sorted((r["doc_id"], r["first_doc_id"]) for r in spans.collect()) == [(1, 0), (2, 1)]
    left = sorted(r["text"] for r in chunks.without_spans(docs, spans).collect())
    cut = [t for t in left if t not in (a, b)]
    assert a in left and b in left and len(cut) == 3 and cut[0] == cut[1] or cut[1] == cut[2]
    assert sum(t.endswith(x[-300:]) and len(t) < len(x) + 300 for t in cut) == 2

from __future__ import annotations

import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm import variants
from tessera.llm.queries import op11_spelling_variants


def counted(rows: list[tuple], least: int = 7) -> dict[str, int]:
    found: Counter[str] = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{word}".encode())
            if h % 31 == 0:
                word = "".join(c for k, c in enumerate(word) if k != h % len(word))
            found[word] += len(word) >= least
    return {w: n for w, n in found.items() if n >= 2}


def grouped(n: dict[str, int]) -> dict[str, tuple]:
    """By the words that are left when a code point, or none, is taken out."""
    holes, near = defaultdict(set), defaultdict(set)
    for w in n:
        for k in range(len(w)):
            holes[w[:k] + "\0" + w[k + 1 :]].add(w)
            if (less := w[:k] + w[k + 1 :]) in n:
                near[w].add(less)
                near[less].add(w)
    for same in holes.values():
        for w in same:
            near[w] |= same - {w}
    form = {}
    for w in n:
        if near[w]:
            top = min(near[w], key=lambda x: (-n[x], x))
            if n[top] >= 10 * n[w]:
                form[w] = top
    out = {}
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out[w] = (form.get(w), root, n[w], len(near[w]), n[form[w]] if w in form else None)
    return out


def rows_of(df) -> dict:
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


def test_query_against_brute_force(spark, smallest):
    rows = [tuple(r) for r in spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "text").collect()]
    want = grouped(counted(rows))
    assert rows_of(op11_spelling_variants(spark, smallest)) == want
    assert sum(v[0] is not None for v in want.values()) >= 10 and sum(v[3] for v in want.values()) > 100


@pytest.fixture(scope="module")
def vocabulary():
    rng, n = random.Random(3), {}
    for _ in range(1500):
        word = "".join(rng.choice("abé") for _ in range(rng.randrange(1, 9)))
        n[word] = rng.choice([2, 3, 30, 300, 3000])
    return n


@pytest.mark.parametrize("hot", [variants.HOT_BUCKET, 20])
def test_dense_words_of_any_length(spark, vocabulary, hot, monkeypatch):
    monkeypatch.setattr(variants, "BLOCK", 64)
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n long")
    want = grouped(vocabulary)
    assert rows_of(variants.groups(words, hot=hot)) == want and any(v[1] != v[0] and v[0] for v in want.values())


def test_automaton_is_minimal_and_numbers_words():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.choice([5, 6]))) for _ in range(200)})
    codes = np.array(words, "<U6").view(np.uint32).reshape(len(words), 6)
    codes = np.where(codes > 0, codes - 96, 0).astype(np.uint32)
    lengths = np.array([len(w) for w in words])
    a = variants.Automaton(codes, lengths)
    rest = {w[k:] for w in words for k in range(len(w) + 1)}
    right = {frozenset(w[len(p) :] for w in words if w.startswith(p)) for w in words for p in (w[:k] for k in range(len(w) + 1))}
    assert len(a.final) == len(right) < len(rest)
    for searched in (False, True):
        if searched:
            a.table = None
        state, number = np.full(len(words), a.root), np.zeros(len(words), np.int64)
        for p in range(6):
            some = np.flatnonzero(lengths > p)
            at = a.edge(state[some], codes[some, p].astype(np.int64))
            assert (at >= 0).all()
            state[some], number[some] = a.target[at], number[some] + a.skip[at]
        assert a.final[state].all() and number.tolist() == list(range(len(words)))


def test_nulls_repeats_long_words_and_empty_tables(spark, make_docs):
    long_word = "ab" * 3000
    rows = [(1, None), (2, ""), (None, "Variant variant"), (3, "vAriant varient Àvariant"), (3, "vAriant varient Àvariant"), (4, "×tensions tensions ttensions 123tensions"), (5, f"{long_word} {long_word}c"), (6, f"{long_word} x {long_word}c"), (7, "tensionsĀtensions")]
    found = rows_of(variants.groups(variants.vocabulary(make_docs(rows))))
    assert found == grouped(counted(rows)) and found[long_word][3] == 1 and found["variant"][3] == 2
    assert not variants.groups(variants.vocabulary(make_docs([]))).collect()
    assert rows_of(variants.groups(variants.vocabulary(make_docs([(1, "abc abc abd")]), least=3, times=1, one_in=0))) == {"abc": (None, "abc", 2, 1, None), "abd": (None, "abd", 1, 1, None)}


def test_chains_of_forms(spark):
    words = spark.createDataFrame([("aaaaaaa", 1), ("aaaaaab", 10), ("aaaaabb", 100), ("aaaabbb", 1000), ("aaabbbb", 10_000), ("zzzzzzz", 5)], "word string, n long")
    found = rows_of(variants.groups(words))
    assert {w: v[1] for w, v in found.items()} == {w: "zzzzzzz" if w[0] == "z" else "aaabbbb" for w in found}

from __future__ import annotations

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import packing
from tessera.llm.queries import op1_best_fit_packing, tokenizer_path


def check(rows, limit):
    """Sequences are gapless from 0 and within the limit."""
    by: dict = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= limit
    return len(by)


@given(st.lists(st.integers(1, 100), min_size=1, max_size=200))
@settings(max_examples=60, deadline=None)
def test_best_fit_and_search_keep_all_within_limit(lengths):
    n = np.array(lengths)
    first = packing.best_fit(n, 100)
    better = packing.local_search(n, first, 100)
    for place in (first, better):
        assert np.bincount(place, weights=n).max() <= 100
    squares = [(np.bincount(p, weights=n) ** 2).sum() for p in (first, better)]
    assert squares[1] >= squares[0]
    assert len(np.unique(better)) <= len(np.unique(first))


@pytest.mark.parametrize(
    ("lengths", "place", "bins"),
    [
        ([6, 5, 5, 4], [0, 1, 0 + 2, 2], 2),  # a one-for-one exchange lets the rest move
        ([3, 3, 4, 5, 5], [0, 0, 1, 1, 2], 2),  # two-for-one or moves
        ([2, 8], [0, 1], 1),  # a plain move empties a bin
    ],
)
def test_local_search_empties_bins(lengths, place, bins):
    n = np.array(lengths)
    assert len(np.unique(packing.local_search(n, np.array(place), 10))) == bins


def test_contract_against_the_tokenizer(spark, smallest):
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(tokenizer_path())
    rows = op1_best_fit_packing(spark, smallest).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    by: dict = {}
    for r in rows:
        by.setdefault(r["doc_id"], []).append(r)
    assert by.keys() == docs.keys()
    for doc, text in docs.items():
        ids = [*tok.encode(text or "", add_special_tokens=False).ids, 1]
        own = sorted(by[doc], key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(-(-len(ids) // 4096)))
        for r in own:
            part = ids[r["start"] : r["start"] + r["length"]]
            assert r["start"] == 4096 * r["piece"] and r["length"] == len(part)
            assert r["ids_crc32"] == zlib.crc32(np.array(part, "<u4").tobytes())
    n = check(rows, 4096)
    assert n == -(-sum(r["length"] for r in rows) // 4096)


AWKWARD = ["", " ", "\n\n", "a,b", "Hello, World. Don't STOP.", "x.,", "end.", "end,\nnext", "É,é.", "é, É.", "İstanbul, ΑΣ. ΑΣ", "<|startoftext|> <|STARTOFTEXT|>,", "<|endoftext|>.",
           "a\tb,\tc", " x, y.", "1,000.5 k.", "won't, we'll.", "a, ́b", "K, Å.", "x,\x0by.", "😀, ok.", "ok,😀"]


def test_by_word_equals_whole_text():
    path = tokenizer_path()
    assert packing.encode_texts(AWKWARD, path) == packing.encode_texts(AWKWARD, path, by_word=False)


@given(st.lists(st.text(alphabet=st.sampled_from("aBé,. \n'sS1<|>ÅΣİ́\t -!"), max_size=30), min_size=1, max_size=5))
@settings(max_examples=150, deadline=None)
def test_by_word_equals_whole_text_for_any_text(texts):
    path = tokenizer_path()
    assert packing.encode_texts(texts, path) == packing.encode_texts(texts, path, by_word=False)


def test_fast_merges_equal_the_tokenizer(documents):
    encoder = packing.WordEncoder(tokenizer_path())
    assert encoder.merge is not None
    words = sorted({w for r in documents.collect() for w in encoder.words(r["text"])})
    assert encoder.encode(words) == encoder.plain(words)


@given(st.lists(st.text(alphabet=st.sampled_from("abcdefghijklmnopqrstuvwxyzßäöüéèñçøłżšıªºþð"), min_size=1, max_size=25), max_size=20))
@settings(max_examples=200, deadline=None)
def test_fast_merges_equal_the_tokenizer_for_any_word(words):
    encoder = packing._encoders.setdefault(tokenizer_path(), packing.WordEncoder(tokenizer_path()))
    assert encoder.encode(words) == encoder.plain(words)


def test_the_words_memory_turns_over(monkeypatch):
    monkeypatch.setattr(packing, "REMEMBERED", 3)
    encoder = packing.WordEncoder(tokenizer_path())
    assert not encoder
    texts = [" ".join(f"word{k}{j}" for j in range(4)) for k in range(6)]
    for t in [*texts, *texts]:
        assert encoder.encode([t]) == encoder.plain([t])


def test_nulls_repeats_long_and_empty(spark, make_docs):
    docs = make_docs([(1, None), (2, ""), (3, "word " * 9000), (3, "word " * 9000), (None, "a b")])
    rows = packing.pack_documents(docs, tokenizer_path(), limit=4096).collect()
    lengths = sorted((r["doc_id"] or -1, r["piece"], r["length"]) for r in rows)
    assert lengths == [(-1, 0, 3), (1, 0, 1), (2, 0, 1), (3, 0, 4096), (3, 0, 4096), (3, 1, 4096), (3, 1, 4096), (3, 2, 809), (3, 2, 809)]
    check(rows, 4096)
    assert packing.pack_documents(docs.limit(0), tokenizer_path()).collect() == []


def test_many_groups_cost_hardly_any_sequences(spark, smallest, documents):
    rows = packing.pack_documents(documents, tokenizer_path(), limit=4096, group=20).collect()
    best = -(-sum(r["length"] for r in rows) // 4096)
    assert check(rows, 4096) <= best * 1.1 + 1
    assert len(rows) == len({(r["doc_id"], r["piece"]) for r in rows})


def test_sequences_hold_the_ids_in_order(spark, make_docs):
    docs = make_docs([(k, "alpha beta gamma " * (k + 1)) for k in range(12)])
    pieces = packing.tokenized_pieces(docs, tokenizer_path(), limit=32)
    placed = packing.place_pieces(pieces.drop("ids"), limit=32)
    whole = {r["sequence_id"]: r["ids"] for r in packing.sequences(placed, pieces).collect()}
    ids = {(r["doc_id"], r["piece"]): r["ids"] for r in pieces.collect()}
    for r in placed.collect():
        assert bytes(whole[r["sequence_id"]][4 * r["offset"] :][: 4 * r["length"]]) == bytes(ids[r["doc_id"], r["piece"]])

from __future__ import annotations

import random

import numpy as np
import pytest
import xxhash

from tessera.llm import simhash
from tessera.llm.queries import op2_simhash_near_dedup


def slow_fingerprint(text: str, width: int = 4) -> int:
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text).replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(fps: dict[int, bytes], budget: int) -> dict[int, int]:
    ids = sorted(fps)
    n = {i: int.from_bytes(fps[i]) for i in ids}
    root = {i: i for i in ids}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(ids):
        for b in ids[:i]:
            if (n[a] ^ n[b]).bit_count() <= budget:
                ra, rb = find(a), find(b)
                root[max(ra, rb)] = min(ra, rb)
    return {i: find(i) for i in ids}


@pytest.mark.parametrize("text", ["", " \t\n", "one", "one two THREE", "a b c d", "A b c d e", "Straße ÉTÉ x\x0by z w", "a " * 300, "x y z \x1c w v"])
def test_fingerprint(text):
    assert int.from_bytes(simhash.fingerprint(text.encode())) == slow_fingerprint(text)


def test_query_against_brute_force(spark, smallest):
    rows = op2_simhash_near_dedup(spark, smallest).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{smallest}/documents.parquet").collect()}
    assert {r["doc_id"]: r["fingerprint"] for r in rows} == {k: f"{slow_fingerprint(t):016x}" for k, t in docs.items()}
    want = brute_components({r["doc_id"]: bytes.fromhex(r["fingerprint"]) for r in rows}, 4)
    assert {r["doc_id"]: r["component_id"] for r in rows} == want


def scattered(n: int, words: int, seed: int) -> dict[int, bytes]:
    """Fingerprints in clusters whose members differ in few bits, and some at random."""
    rng = random.Random(seed)
    out: dict[int, bytes] = {}
    centres = [rng.getrandbits(64 * words) for _ in range(n // 12)]
    for i in range(n):
        x = rng.choice(centres) if i % 4 else rng.getrandbits(64 * words)
        for _ in range(rng.randrange(0, 5 if words == 1 else 40)):
            x ^= 1 << rng.randrange(64 * words)
        out[i] = x.to_bytes(8 * words)
    return out


@pytest.mark.parametrize("hot", [60_000, 7])
def test_trie_join_finds_every_link_within_four_bits(spark, hot):
    fps = scattered(600, 1, 5)
    reps = {fp: i for i, fp in sorted(fps.items(), reverse=True)}
    df = spark.createDataFrame([(bytearray(fp), i) for fp, i in reps.items()], "fp binary, rep long")
    links = simhash.near_links(df, simhash.BITS64, hot)
    got = {r["node"]: r["root"] for r in simhash.components(links).collect()}
    want = brute_components({i: fp for fp, i in reps.items()}, 4)
    assert all(got.get(i, i) == root for i, root in want.items())


@pytest.mark.parametrize("hot", [60_000, 7])
def test_similar_rule_finds_nearly_all(spark, hot):
    fps = scattered(400, 4, 6)
    df = spark.createDataFrame([(bytearray(fp), i) for i, fp in fps.items()], "fp binary, rep long").dropDuplicates(["fp"])
    got = {r["node"]: r["root"] for r in simhash.components(simhash.near_links(df, simhash.SIMILAR, hot)).collect()}
    want = brute_components(fps, simhash.SIMILAR.budget)
    assert sum(got.get(i, i) == root for i, root in want.items()) >= 0.99 * len(want)
    assert all(want[i] == want[root] for i, root in got.items())


def test_one_large_group_of_near_copies(spark):
    rng = np.random.default_rng(1)
    fps = np.uint64(0x0123456789ABCDEF) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 3000).astype(np.uint64))
    fps = np.unique(fps)
    df = spark.createDataFrame([(bytearray(int(x).to_bytes(8)), i) for i, x in enumerate(fps)], "fp binary, rep long")
    links = simhash.near_links(df, simhash.BITS64, 500)
    assert links.count() < 40 * len(fps)
    roots = simhash.components(links).collect()
    assert len(roots) == len(fps) and {r["root"] for r in roots} == {0}


def test_nulls_ties_repeats_empty(spark, make_docs):
    docs = make_docs([(5, None), (4, ""), (9, "a b c d e f"), (9, "a b c d e f"), (7, "A B c d e f"), (None, "a b c d e f"), (3, "q w e r t y u i o p")])
    got = sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["component_id"]) for r in simhash.near_components(docs).collect())
    assert got == [(-1, 7), (3, 3), (4, 4), (5, 4), (7, 7), (9, 7), (9, 7)]
    kept = simhash.keep_one_each(docs)
    assert kept.columns == docs.columns and sorted(r["doc_id"] if r["doc_id"] is not None else -1 for r in kept.collect()) == [-1, 3, 4, 7]
    assert simhash.near_components(docs.limit(0)).collect() == []


def test_rows_without_an_id_link_others(spark, make_docs, monkeypatch):
    """A row without an id may be the only bridge between two documents; components of such rows only have no id."""
    rows = spark.createDataFrame([(1, 0), (None, 0xF), (2, 0xFF), (None, 0x3FF << 40), (None, 0x7FF << 40)], "doc_id long, n long")
    made = rows.selectExpr("doc_id", "unhex(lpad(hex(n), 16, '0')) as fp")
    monkeypatch.setattr(simhash, "fingerprints", lambda docs, *how: made)
    got = sorted((r["doc_id"] or 0, bytes(r["fp"])[-1], r["component_id"] or 0) for r in simhash.near_components(made).collect())
    assert got == [(0, 0, 0), (0, 0, 0), (0, 15, 1), (1, 0, 1), (2, 255, 1)]


def test_stage_catches_near_copies_and_leaves_others(spark, make_docs):
    rng = random.Random(3)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(2000)]
    rows = []
    for k in range(120):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(150, 500))]
        rows.append((k, " ".join(words)))
        if k < 60:  # a change in every 70 words or so keeps a Jaccard similarity of about 0.87
            for at in range(30, len(words), 70):
                words[at] = "changed"
            rows.append((1000 + k, " ".join(words)))
    left = {r["doc_id"] for r in simhash.keep_one_each(make_docs(rows)).select("doc_id").collect()}
    assert left >= set(range(120))
    assert len([k for k in range(60) if 1000 + k not in left]) >= 57


def jaccard(a: str, b: str) -> float:
    x, y = ({tuple(w[i : i + 5]) for i in range(len(w) - 4)} for w in (a.split(), b.split()))
    return len(x & y) / len(x | y)


def test_only_similar_documents_go(spark, make_docs):
    """Copies with changed words, most of them below a similarity of 0.8; the stage must do what all exact similarities say."""
    rng = random.Random(11)
    vocabulary = ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(3000)]
    rows, groups = [], []
    for k in range(60):
        words = [rng.choice(vocabulary) for _ in range(300)]
        copies = []
        for c in range(3):
            changed = list(words)
            for at in range(rng.randrange(5), 300, rng.choice((20, 25, 30, 60))) if c else ():
                changed[at] = rng.choice(vocabulary) + "x"
            copies.append((10 * k + c, " ".join(changed)))
        rows += copies
        groups.append(copies)
    line = " ".join(vocabulary[:40]) + " "  # repeated lines make these fingerprints alike if repeats count
    rows += [(9000 + k, line * 10 + " ".join(rng.choice(vocabulary) for _ in range(60))) for k in range(8)]
    want = {9000 + k for k in range(8)}
    for copies in groups:
        root = {i: i for i, _ in copies}
        for _ in copies:
            for i, a in copies:
                for j, b in copies:
                    if jaccard(a, b) >= 0.8:
                        root[i] = root[j] = min(root[i], root[j])
        want |= set(root.values())
    left = {r["doc_id"] for r in simhash.keep_one_each(make_docs(rows)).select("doc_id").collect()}
    assert 60 < len(want) < 180 and left == want


def test_a_doc_id_with_two_texts(spark, make_docs):
    rng = random.Random(13)
    a, b, c = (" ".join(f"{x}{rng.randrange(10**6)}" for _ in range(200)) for x in "abc")
    near = lambda t: " ".join([*t.split()[:-1], "changed"])
    rows = [(5, a), (10, near(a)), (10, b), (12, near(b)), (20, c), (20, near(c))]
    left = [(r["doc_id"], r["text"]) for r in simhash.keep_one_each(make_docs(rows)).collect()]
    assert len(left) == 3 and {(5, a), (10, b)} <= set(left) and [k for k, _ in left].count(20) == 1


def test_chunks_of_a_component_link_alike(spark, make_docs):
    rng = random.Random(12)
    base = [f"w{k}" for k in range(200)]
    rows = []
    for k in range(60):
        words = list(base)
        for at in rng.sample(range(200), 3):
            words[at] = f"x{k}"
        rows.append((k, " ".join(words)))
    docs = make_docs(rows)
    members = docs.selectExpr("doc_id as rep", "0L as root", "xxhash64(text) as mark")
    roots = [sorted(simhash.components(simhash.similar_links(docs, members, 5, members_max=n)).collect()) for n in (500, 7)]
    brute = {(a, b) for a, x in rows for b, y in rows if a < b and jaccard(x, y) >= 0.8}
    assert roots[0] == roots[1] == sorted(simhash.components(spark.createDataFrame(list(brute), "a long, b long")).collect())


def test_large_components_of_several_groups(spark, make_docs):
    """Chains and groups that only some pairs join, in components of many chunks, against all pairs."""
    rng = random.Random(14)
    rows = []
    for g in range(4):
        words = [f"g{g}w{k}" for k in range(120)]
        for k in range(25):  # a chain: each text differs a little from the one before, the ends differ much
            words = list(words)
            for at in rng.sample(range(120), 1 + (k % 3 == 0)):
                words[at] = f"g{g}x{k}"
            rows.append((100 * g + k, " ".join(words)))
    docs = make_docs(rows)
    members = docs.selectExpr("doc_id as rep", "cast(doc_id / 200 as long) as root", "xxhash64(text) as mark")
    brute = {(a, b) for a, x in rows for b, y in rows if a < b and jaccard(x, y) >= 0.8}
    want = sorted(simhash.components(spark.createDataFrame(list(brute), "a long, b long")).collect())
    for n in (500, 20, 6):
        assert sorted(simhash.components(simhash.similar_links(docs, members, 5, members_max=n)).collect()) == want


def test_recall_of_the_candidate_rule():
    """Pairs of a Jaccard similarity just above 0.8 that are candidates: within the budget, and alike in some rotation."""
    rng = np.random.default_rng(9)
    found, n = 0, 1500
    for _ in range(n):
        size = int(rng.integers(60, 800))
        common = rng.integers(0, 1 << 63, size, np.uint64)
        more = max(0, int(size * 0.245))  # 0.8 to 0.81
        x, y = (np.concatenate([common, rng.integers(0, 1 << 63, k, np.uint64)]) for k in (more // 2, more - more // 2))
        fps = np.stack([np.frombuffer(simhash.simhash(s, 4), ">u8").astype(np.uint64) for s in (x, y)])
        if np.bitwise_count(fps[0] ^ fps[1]).sum() > simhash.SIMILAR.budget:
            continue
        found += any(exact[0] == exact[1] and int(np.bitwise_count((turned[0] ^ turned[1]) >> np.uint64(64 - 8))) <= 1 for _, exact, turned, _ in simhash._rotations(fps, simhash.SIMILAR))
    assert found >= 0.97 * n


def test_components(spark):
    chain = spark.createDataFrame([(k, k + 1) for k in range(0, 40)] + [(50, 51), (51, 50), (60, 60), (None, 3)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.components(chain).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 50: 50, 51: 50}
    assert simhash.components(chain.limit(0)).collect() == []

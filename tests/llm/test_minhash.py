from __future__ import annotations

import random
import re
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tessera.llm import minhash
from tessera.llm.queries import op13_minhash_near_dedup, oracle_sql


def shingles(text: str | None, width: int = 4) -> frozenset:
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(words[k : k + width]) for k in range(max(1, len(words) - width + 1))) if words else frozenset()


def expected(rows: list[tuple]) -> list[tuple]:
    sets = [shingles(t) for _, t in rows]
    root, by = list(range(len(rows))), defaultdict(set)
    for k, s in enumerate(sets):
        for x in s:
            by[x].add(k)

    def top(k: int) -> int:
        while root[k] != k:
            k = root[k]
        return k

    for k, s in enumerate(sets):
        for j in sorted(set().union(*(by[x] for x in s))) if s else ():
            if j < k and 100 * len(s & sets[j]) >= 80 * len(s | sets[j]):
                a, b = sorted((top(k), top(j)))
                root[b] = a
    names = defaultdict(list)
    for k, (doc, _) in enumerate(rows):
        names[top(k)].append(doc)
    out = []
    for k, (doc, _) in enumerate(rows):
        ids = [x for x in names[top(k)] if x is not None]
        name = (min(ids) if ids else None) if sets[k] else doc
        out.append((doc, len(sets[k]), name, doc is not None and doc == name))
    return sorted(out, key=str)


def found(df) -> list[tuple]:
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in df.collect()), key=str)


def test_query_against_brute_force_and_sql(spark, smallest):
    import duckdb

    rows = [tuple(r) for r in spark.read.parquet(f"{smallest}/documents.parquet").select("doc_id", "text").collect()]
    got = found(op13_minhash_near_dedup(spark, smallest))
    assert got == expected(rows) and sum(not r[3] for r in got) > 5
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{smallest}/documents.parquet'")
    assert sorted(con.execute(oracle_sql()["op13_minhash_near_dedup"]).fetchall(), key=str) == got


def edited(rng: random.Random, words: list[str], changes: int) -> list[str]:
    out = list(words)
    for _ in range(changes):
        out[rng.randrange(len(out))] = f"z{rng.randrange(10**6)}"
    return out


@pytest.fixture(scope="module")
def crowded():
    """Groups of near copies of all sizes, a passage in a third of all rows, a line in many short ones, and rows at the border of 0.8."""
    rng, rows = random.Random(9), []
    text = lambda n: [f"w{rng.randrange(5000)}" for _ in range(n)]
    for size, length, changes in ((2, 30, 1), (3, 200, 8), (30, 120, 4), (150, 90, 3), (60, 500, 20), (40, 14, 1)):
        base = text(length)
        rows += [edited(rng, base, rng.randrange(changes + 1)) for _ in range(size)]
    passage = text(60)
    rows += [text(rng.randrange(3, 120)) + passage + text(rng.randrange(3, 120)) for _ in range(250)]
    line = text(12)
    rows += [line + text(rng.randrange(1, 4)) for _ in range(80)]
    border = text(203)
    rows += [border, *[border[: 200 - k] + text(3 + k) for k in range(10, 30)]]
    rows += [text(rng.randrange(1, 6)) for _ in range(60)] + [["a", "b"]] * 40
    rng.shuffle(rows)
    return [(k, " ".join(r)) for k, r in enumerate(rows)]


@pytest.mark.parametrize(("long", "cold"), [(minhash.LONG, minhash.COLD), (3, 1000)])
def test_crowded_lists(spark, crowded, long, cold):
    df = spark.createDataFrame([(*r, "x", 1) for r in crowded], "doc_id long, text string, sketch string, n int")
    assert found(minhash.near_components(df, long=long, cold=cold)) == expected(crowded)


def test_long_lists_make_no_squares(spark, crowded):
    df = spark.createDataFrame(crowded, "doc_id long, text string")
    nodes = minhash.sketches(df).where("n > 0").dropDuplicates(["set_id"]).withColumn("node", F.monotonically_increasing_id()).cache()
    pairs, n = minhash.candidates(nodes), nodes.count()
    assert pairs.count() < 80 * n and n**2 / pairs.count() > 15 and minhash.plausible(pairs, nodes).count() < 4 * n


def test_pairs_with_an_enormous_union(spark):
    """The estimate drops no pair at the border and most pairs far from it."""
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(4000)]
    near = base[:3600] + [f"v{k}" for k in range(400)]
    far = base[:2000] + [f"u{k}" for k in range(2000)]
    got = found(minhash.near_components(spark.createDataFrame([(1, " ".join(base)), (2, " ".join(near)), (3, " ".join(far))], "doc_id long, text string")))
    assert [r[2] for r in got] == [1, 1, 3]


def test_nulls_repeats_long_texts_and_empty_tables(spark, make_docs):
    rng = random.Random(1)
    words = lambda n: " ".join(f"w{rng.randrange(10**4)}" for _ in range(n))
    long_text, near = words(60_000), words(300)
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, near), (4, near.upper()), (5, near + " tail"), (None, near + " tail"), (None, None), (6, long_text), (7, long_text + " x"), (8, "one two"), (8, "One  two"), (9, "one two three"), (None, "one two three four five"), (None, "one two three four five")]
    assert found(minhash.near_components(make_docs(rows))) == expected(rows)
    assert not minhash.near_components(make_docs([])).collect()


def test_similar_sets_that_meet_in_long_lists_only(spark):
    """All sets share a header, whose values are the first that are followed, and no head of a list is like any other member."""
    from tessera.llm.simhash import shingle_set

    rng = random.Random(3)
    words = sorted((f"w{k}" for k in range(400)), key=lambda w: shingle_set(w.encode(), 1, 42).view("int64")[0])
    header, others = words[:18], words[18:168]
    sets = [header + rng.sample(others, 45) for _ in range(600)]
    twins = [s[:-3] + rng.sample([w for w in others if w not in s], 3) for s in sets[:12]]
    rows = [(k, " ".join(rng.sample(s, len(s)))) for k, s in enumerate(sets + twins)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = [(k, 63, k if k < 600 else k - 600, k < 600) for k in range(612)]
    assert sorted((r["doc_id"], r["n_shingles"], r["component_id"], r["kept"]) for r in minhash.near_components(df, width=1).collect()) == want

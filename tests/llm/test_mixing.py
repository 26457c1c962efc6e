from __future__ import annotations

import random

import pytest

from tessera.llm import mixing
from tessera.llm.queries import op8_mixing


def water(sizes: list[int], weights=(3, 1, 2), share=1.5, ceiling=2.0) -> list[float]:
    """Targets by resharing round by round."""
    w = [weights[k % 3] for k in range(len(sizes))]
    capped: set = set()
    total = share * sum(sizes)
    while True:
        left = total - sum(ceiling * sizes[k] for k in capped)
        free = [k for k in range(len(sizes)) if k not in capped]
        t = {k: left * w[k] / sum(w[j] for j in free) for k in free}
        over = [k for k in free if t[k] > ceiling * sizes[k]]
        if not over:
            return [ceiling * sizes[k] if k in capped else t[k] for k in range(len(sizes))]
        capped |= set(over)


@pytest.mark.parametrize("sizes", [[100], [10, 10, 10], [1000, 1, 1], [5, 900, 40, 0, 7, 300], [0, 0], [0, 7]])
def test_targets(spark, sizes):
    rows = spark.createDataFrame([(f"s{k:02}", n) for k, n in enumerate(sizes)], "source string, source_size long")
    got = [r["target"] for r in mixing.targets(rows).orderBy("source").collect()]
    assert got == pytest.approx(water(sizes) if any(sizes) else [0.0] * len(sizes))


def totals(df):
    out: dict = {}
    for r in df.collect():
        n, t, s = out.setdefault((r["source_size"], r["target"]), [0, 0, 0])
        out[r["source_size"], r["target"]] = [n + 1, t + r["taken"], s + r["size"]]
        assert 0 <= r["taken"] <= 2 * r["size"]
    return out


def test_query(spark, smallest, documents):
    sizes: dict = {}
    for r in documents.collect():
        sizes[r["source"]] = sizes.get(r["source"], 0) + len((r["text"] or "").split())
    names = sorted(sizes)
    want = dict(zip(names, water([sizes[n] for n in names]), strict=True))
    got = totals(op8_mixing(spark, smallest))
    assert sorted((s, pytest.approx(t)) for s, t in ((sizes[n], want[n]) for n in names)) == sorted((s, t) for s, t in got)
    for (_, target), (_, taken, _) in got.items():
        assert taken == pytest.approx(target, rel=0.003)


def seat_by_seat(weights: dict, house: int, caps: dict) -> dict:
    """Sainte-Lague, one seat after the other."""
    seats = dict.fromkeys(weights, 0)
    for _ in range(min(house, sum(c for k, c in caps.items() if weights[k] > 0))):
        free = [k for k in weights if weights[k] > 0 and seats[k] < caps[k]]
        best = min(free, key=lambda k: (-weights[k] / (2 * seats[k] + 1), k))
        seats[best] += 1
    return seats


def test_seats_against_seat_by_seat(spark):
    rng = random.Random(7)
    rows, houses, want = [], [], {}
    for g in range(40):
        m = rng.choice((1, 2, 5, 30))
        weights = {k: float(rng.choice((0, 1, 1, 7, 7, rng.randrange(1, 10**6)))) for k in range(m)}
        caps = {k: rng.choice((10**9, 10**9, rng.randrange(0, 40))) for k in range(m)}
        house = rng.choice((0, 1, 3, 50, 400))
        rows += [(g, k, weights[k], caps[k]) for k in weights]
        houses.append((g, house))
        want |= {(g, k): n for k, n in seat_by_seat(weights, house, caps).items()}
    df = spark.createDataFrame(rows, "g int, k int, weight double, cap long")
    got = {(r["g"], r["k"]): r["seats"] for r in mixing.apportion(df, "g", "k", spark.createDataFrame(houses, "g int, house long")).collect()}
    assert got == want


@pytest.mark.parametrize("ceiling", [2.0, 1.5])
def test_taken_words_against_seat_by_seat(spark, documents, ceiling):
    """Seats of sources, quotas of shards and the words of each row, by hand from the rows' seeded places."""
    rows = [r.asDict() for r in documents.select("doc_id", "source", mixing.word_count().alias("size")).collect()]
    rng = random.Random(3)
    texts = [(r["doc_id"], "w " * r["size"], None, rng.choice(["a", "a", "a", "b", "c", "d"])) for r in rows]
    docs = spark.createDataFrame([(i, t, s) for i, t, _, s in texts], "doc_id long, text string, source string")
    got = {r["doc_id"]: r for r in mixing.mix(docs, ceiling=ceiling, shard_rows=25).collect()}
    place = {r["doc_id"]: r for r in mixing._places(docs, 20).selectExpr("doc_id", "h", "size", "xxhash64(21, h) as s").collect()}
    sizes: dict = {}
    for i, _, _, s in texts:
        sizes.setdefault(s, []).append(i)
    names = sorted(sizes)
    total = {s: sum(place[i]["size"] for i in sizes[s]) for s in names}
    target = dict(zip(names, water([total[s] for s in names], ceiling=ceiling), strict=True))
    block = max(1, min(256, int(min(target.values()) / 512)))
    seats = seat_by_seat(target, int(sum(target.values()) / block + 0.5), {s: -int(-ceiling * total[s] // block) for s in names})
    for s in names:
        shards: dict = {}
        for i in sizes[s]:
            shards.setdefault(place[i]["s"] % -(-len(sizes[s]) // 25), []).append(i)
        words = {k: sum(place[i]["size"] for i in own) for k, own in shards.items()}
        quota = seat_by_seat({k: float(w) for k, w in words.items()}, seats[s], {k: int(ceiling * -(-w // block)) for k, w in words.items()})
        for k, own in shards.items():
            blocks = -(-words[k] // block)
            passes = quota[k] // blocks if blocks else 0
            rest = (quota[k] - passes * blocks) * block
            for i in sorted(own, key=lambda i: (place[i]["h"], i)):
                n = place[i]["size"]
                assert got[i]["taken"] == passes * n + max(0, min(rest, n)) and got[i]["target"] == pytest.approx(target[s])
                rest -= n


def test_partitions_do_not_matter(spark, documents):
    a = mixing.mix(documents.repartition(7)).collect()
    b = mixing.mix(documents.coalesce(1)).collect()
    assert sorted(a) == sorted(b)


def test_small_shards_and_one_long_document(make_docs):
    rng = random.Random(1)
    rows = [(k, "w " * rng.randrange(1, 60), None, "hot" if k % 3 else f"s{k % 5}") for k in range(900)] + [(9999, "long " * 30000, None, "hot")]
    for (_, target), (_, taken, _) in totals(mixing.mix(make_docs(rows), shard_rows=50)).items():
        assert taken == pytest.approx(target, rel=0.02, abs=2)


def test_nulls_ties_repeats_tiny_and_empty(make_docs):
    docs = make_docs([(1, None, None, "a"), (2, "", None, "a"), (3, "x y z", None, None), (3, "x y z", None, None), (None, "q r", None, "b"), (4, "one\ttwo\x0bthree four", None, "b"), (5, "\xa0 a", None, "c")])
    got = mixing.mix(docs).collect()
    assert len(got) == 7 and sum(r["size"] for r in got) == 3 + 3 + 2 + 4 + 2
    assert all(r["taken"] == 0 for r in got if r["size"] == 0) and all(r["taken"] <= 2 * r["size"] for r in got)
    by = totals(mixing.mix(docs))
    assert all(abs(taken - target) <= 1 for (_, target), (_, taken, _) in by.items())
    mixed = mixing.apply_mix(docs)
    assert mixed.columns == docs.columns
    assert sum(len(r["text"].replace("\t", " ").replace("\x0b", " ").split(" ")) if r["text"] else 0 for r in mixed.collect()) == pytest.approx(sum(r["taken"] for r in got), abs=2)
    assert mixing.mix(docs.limit(0)).collect() == [] and mixing.apply_mix(docs.limit(0)).collect() == []


def test_applied_words_are_those_taken(documents):
    taken = sum(r["taken"] for r in mixing.mix(documents).collect())
    rows = mixing.apply_mix(documents).select("doc_id", "text").collect()
    texts = {r["doc_id"]: r["text"] for r in documents.collect()}
    assert sum(len(r["text"].encode().split()) for r in rows) == taken
    assert all(texts[r["doc_id"]].startswith(r["text"]) for r in rows)

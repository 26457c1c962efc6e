from __future__ import annotations

import hashlib
import random

import pytest

from tessera.llm import sharding
from tessera.llm.queries import op10_sharding


def brute(rows, limit):
    """Extendible hashing by hand: (depth, shard) -> [bytes, rows], splitting one bucket at a time."""
    items = [(int(hashlib.md5((str(d) if d is not None else "null").encode()).hexdigest()[:15], 16), len((t or "").encode())) for d, t in rows]
    done: dict = {}
    todo = [(0, 0, items)] if items else []
    while todo:
        depth, prefix, own = todo.pop()
        if sum(b for _, b in own) <= limit or len({h for h, _ in own}) == 1:
            done[depth, prefix << (60 - depth)] = [sum(b for _, b in own), len(own)]
            continue
        for bit in (0, 1):
            part = [x for x in own if x[0] >> (59 - depth) & 1 == bit]
            if part:
                todo.append((depth + 1, prefix << 1 | bit, part))
    return done


def directory(df):
    out: dict = {}
    for r in df.collect():
        own = out.setdefault((r["depth"], r["shard"]), [0, 0])
        own[0] += r["bytes"]
        own[1] += 1
        assert r["shard_bytes"] is not None
        out[r["depth"], r["shard"]] = own
    return out


@pytest.mark.parametrize("limit", [1 << 40, 200_000, 20_000, 3000])
def test_against_splitting_by_hand(spark, documents, limit):
    rows = [(r["doc_id"], r["text"]) for r in documents.collect()]
    df = sharding.assign(documents, limit)
    assert directory(df) == brute(rows, limit)
    assert all(r["shard_bytes"] <= limit or r["shard_rows"] == 1 for r in df.collect())


def test_query(spark, smallest, documents):
    rows = op10_sharding(spark, smallest).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(r["doc_id"] for r in documents.collect())


def test_one_key_holds_a_third(make_docs):
    rng = random.Random(2)
    rows = [(7 if k % 3 == 0 else k, "x" * rng.randrange(200)) for k in range(400)]
    assert directory(sharding.assign(make_docs(rows), 1000)) == brute(rows, 1000)


def test_nulls_repeats_empty(make_docs, tmp_path, spark):
    rows = [(1, None), (2, "é"), (2, "é"), (None, "abc"), (None, None), (5, "x" * 100)]
    assert directory(sharding.assign(make_docs(rows), 5)) == brute(rows, 5)
    assert sharding.assign(make_docs(rows).limit(0), 5).collect() == []
    sharding.write_shards(make_docs(rows), 5, f"file://{tmp_path}/s")
    back = spark.read.parquet(f"file://{tmp_path}/s")
    assert back.count() == len(rows) and back.select("shard").distinct().count() == len(brute(rows, 5))

from __future__ import annotations

import glob
import gzip
import hashlib
import os
import random

import pytest

from tessera.llm import warc
from tessera.llm.common import fresh_path
from tessera.llm.queries import op5_warc

SCHEMA = "page_id long, url string, html string, payload string, k string, top long, chunk string"


@pytest.fixture
def make_pages(spark):
    return lambda rows: spark.createDataFrame([(*r, "a", "b", 1, "c") for r in rows], SCHEMA)


def want(rows):
    """page_id -> (bytes, digest, type, refers_to)."""
    top: dict = {}
    for page, _, html in rows:
        top[html or ""] = max(top.get(html or "", page), page)
    out = {}
    for page, _, html in rows:
        payload = (html or "").encode()
        revisit = len(payload) >= 1000 and top[html or ""] != page
        out[page] = (len(payload), hashlib.sha1(payload).hexdigest(), "revisit" if revisit else "response", top[html or ""] if revisit else None)
    return out


def got(df):
    return {r["page_id"]: (r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in df.collect()}


def test_query(spark, smallest):
    rows = [(r["page_id"], r["url"], r["html"]) for r in spark.read.parquet(f"{smallest}/pages.parquet").collect()]
    assert got(op5_warc(spark, smallest)) == want(rows)


def test_round_trip_with_copies(spark, make_pages, tmp_path):
    rng = random.Random(4)
    texts = [None, "", "short", "é" * 499 + "x", "é" * 500, "ü" * 3000, "a\r\n\r\nb" * 400]
    rows = [(k, rng.choice([None, f"http://h/{k}", "http://h/\r\nX: y"]), rng.choice(texts)) for k in range(300)]
    path = f"file://{tmp_path}/w"
    read = warc.archive_pages(make_pages(rows), path)
    assert got(read) == want(rows)
    payloads = {r["page_id"]: r["payload"] for r in read.where("record_type = 'response'").collect()}
    by = {page: (html or "").encode() for page, _, html in rows}
    assert all(bytes(p) == by[k] for k, p in payloads.items())
    for f in glob.glob(f"{tmp_path}/w/part-*"):  # the archives are plain gzip streams of WARC records
        text = gzip.open(f).read()
        assert not text or text.startswith(b"WARC/1.1\r\nWARC-Type: ")


def incompressible(n: int, seed: int) -> str:
    rng = random.Random(seed)
    return "".join(chr(rng.randrange(32, 0x2FF)) for _ in range(n))


@pytest.mark.parametrize("split", [700, 5000, 1 << 20])
def test_any_split_and_magic_inside_of_members(spark, tmp_path, split):
    """Byte ranges cut members anywhere; stored members hold the magic, whole headers and other records' bytes in their payloads."""
    inner = warc.record(77, "u", b"inner", None, False)
    payloads = [warc.MAGIC * 3 + inner, incompressible(4000, 1).encode(), b"", inner * 2 + warc.MAGIC, b"x" * 2000, warc.EMPTY_MEMBER * 4]
    members = []
    for k, p in enumerate(payloads * 4):
        plain = gzip.decompress(warc.record(k, f"u{k}", p, None, False))
        members.append(gzip.compress(plain, 0 if k % 2 == 0 else 6, mtime=k))
    os.makedirs(f"{tmp_path}/w")
    for name, own in (("a.txt", members[:11]), ("b.txt", members[11:])):
        open(f"{tmp_path}/w/{name}", "wb").write(b"".join(own) + warc.EMPTY_MEMBER)
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", str(split))
        spark.conf.set("spark.sql.files.openCostInBytes", "0")
        rows = warc.read_archives(spark, f"file://{tmp_path}/w").collect()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert sorted(r["page_id"] for r in rows) == list(range(24))
    assert all(bytes(r["payload"]) == payloads[r["page_id"] % 6] for r in rows)


def test_nulls_repeats_empty(spark, make_pages):
    big = "z" * 1500
    rows = [(None, None, big), (5, "u", big), (5, "u", big), (3, None, big), (None, "v", None)]
    found = sorted(((r["page_id"] or -1, r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.archive_pages(make_pages(rows)).collect()), key=str)
    assert found == sorted([(-1, 1500, "revisit", 5), (5, 1500, "response", None), (5, 1500, "response", None), (3, 1500, "revisit", 5), (-1, 0, "response", None)], key=str)
    assert warc.archive_pages(make_pages([]), fresh_path(spark, "none")).collect() == []

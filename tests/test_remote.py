"""The remote source over an endpoint of this machine that fails in many ways."""

from __future__ import annotations

import threading
from collections import Counter
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from tessera.sources import remote


@pytest.fixture(scope="module")
def endpoint():
    """(url, requests by key). G...3 fails once, G...5 is short once, G...7 is never found, G...8 always fails."""
    seen: Counter[str] = Counter()
    lock = threading.Lock()

    class Answer(BaseHTTPRequestHandler):
        def do_GET(self) -> None:
            key = self.path.rpartition("/")[2]
            with lock:
                seen[key] += 1
                n = seen[key]
            status = {"3": 503 if n == 1 else 200, "7": 404, "8": 500, "9": 429 if n == 1 else 200}.get(key[-1], 200)
            body = b"x" if key[-1] == "5" and n == 1 else f"document {key} é".encode()
            self.send_response(status)
            if status == 429:
                self.send_header("Retry-After", "0")
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args: object) -> None:
            pass

    server = ThreadingHTTPServer(("127.0.0.1", 0), Answer)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{server.server_port}/gene/{{key}}", seen
    server.shutdown()


@pytest.fixture
def load(spark, endpoint):
    spark.dataSource.register(remote.RemoteDocuments)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    url, seen = endpoint
    seen.clear()
    yield lambda **options: spark.read.format("remote_documents").options(url=url, pause="0.01", least_bytes="5", **options).load()
    spark.conf.unset("spark.sql.python.filterPushdown.enabled")


def test_a_range_is_read_once_with_retries(load, endpoint):
    df = load(range="1:40", key_format="G{:04d}", batch="7", attempts="3")
    assert df.rdd.getNumPartitions() == 6
    rows = {r["number"]: r for r in df.collect()}
    assert sorted(rows) == list(range(1, 41)) and rows[12]["key"] == "G0012" and rows[12]["payload"] == "document G0012 é"
    for n, r in rows.items():
        last = n % 10
        assert (r["payload"] is None) == (last in (7, 8))
        assert (r["status"], r["attempts"]) == {7: (404, 1), 8: (500, 3), 3: (200, 2), 5: (200, 2), 9: (200, 2)}.get(last, (200, 1))
        assert (r["error"] is None) == (r["payload"] is not None)
    assert endpoint[1]["G0018"] == 3 and endpoint[1]["G0017"] == 1 and endpoint[1]["G0012"] == 1


def test_filters_prune_partitions_and_calls(load, endpoint):
    df = load(range="1:1000000", key_format="G{:07d}", batch="100")
    some = df.where(F.col("key").isin("G0000010", "G0000311", "G0000312", "H0000011", "G9999999"))
    assert sorted(r["key"] for r in some.collect()) == ["G0000010", "G0000311", "G0000312"]
    assert set(endpoint[1]) == {"G0000010", "G0000311", "G0000312"} and some.rdd.getNumPartitions() == 1
    near = df.where("number >= 250 and number < 452")
    assert near.rdd.getNumPartitions() == 3
    endpoint[1].clear()
    assert near.where("payload like '%4_2%'").select("key").collect() and len(endpoint[1]) == 202  # a filter on payloads stays with Spark
    endpoint[1].clear()
    assert df.where("key = 'none'").collect() == [] and not endpoint[1]


def test_a_list_of_keys(load, endpoint):
    df = load(keys="A1, B2 A1\nC3,D/4", batch="2")
    assert sorted(r["key"] for r in df.collect()) == ["A1", "B2", "C3", "D/4"] and endpoint[1]["D%2F4"] == 1
    endpoint[1].clear()
    assert [r["payload"] for r in df.where("key = 'B2'").collect()] == ["document B2 é"] and list(endpoint[1]) == ["B2"]


def test_no_server(load, spark):
    df = spark.read.format("remote_documents").options(url="http://127.0.0.1:1/{key}", keys="a b", attempts="2", pause="0").load()
    assert [(r["payload"], r["status"], r["attempts"]) for r in df.collect()] == [(None, None, 2)] * 2


@pytest.mark.parametrize("options", [{"url": "http://x"}, {"url": "http://x/{key}"}, {"url": "http://x/{key}", "keys": "a", "range": "1:2"}, {"url": "http://x/{key}", "keys": "a", "batch": "0"}])
def test_options_that_make_no_sense(options):
    with pytest.raises(ValueError):
        remote.RemoteReader(options)

"""A remote store of documents as a Spark data source: one GET a key, keys dealt into partitions, failures asked for again.

    spark.dataSource.register(RemoteDocuments)
    spark.read.format("remote_documents").option("url", "https://host/gene/{key}").option("range", "1:20000").option("key_format", "G{:07d}").load()

Rows: key, payload (null where no good answer came), status (the last HTTP status, null without an answer), attempts,
error. Filters on ``key`` (=, IN) and on ``number`` (comparisons, of a range) are taken by the source (with
``spark.sql.python.filterPushdown.enabled``): keys that they exclude are never asked for, and partitions left without keys are not planned. An answer is
good if its status is 200 and it has ``least_bytes``; others are asked for again after a pause that doubles, or as long as the answer's
Retry-After says, up to ``attempts``; a status of 4xx but 408 and 429 is final. A task asks for one key at a time, so the number of
partitions bounds the calls at once, and a task that is run again asks only for its own keys.

A list of keys passes through the driver as an option, so it is for lists up to ``MOST_KEYS``; a range of numbers of any length
is split arithmetically; for a table of keys use ``documents.fetch_missing``, which also keeps a cache.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql.datasource import DataSource, DataSourceReader, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In, InputPartition, LessThan, LessThanOrEqual

SCHEMA = "number long, key string, payload string, status int, attempts int, error string"
MOST_KEYS = 100_000
#: Rows of an Arrow batch.
ROWS = 64


class Keys(InputPartition):
    """Some keys of a list, or the numbers ``low`` to ``high`` (exclusive)."""

    def __init__(self, keys: list[tuple[int, str]] | None = None, low: int = 0, high: int = 0) -> None:
        self.keys, self.low, self.high = keys, low, high


class RemoteDocuments(DataSource):
    """Options: url (with {key}), and keys (separated by commas or white space) or range (first:last, inclusive) with key_format; batch (keys of a
    partition, 100), attempts (4), least_bytes (1), timeout (30 seconds), pause (before the second attempt, 1 second), longest_pause (60)."""

    @classmethod
    def name(cls) -> str:
        return "remote_documents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return RemoteReader(dict(self.options))


class RemoteReader(DataSourceReader):
    def __init__(self, options: dict[str, str]) -> None:
        own = {k.lower(): v for k, v in options.items()}
        self.url, self.form = own.get("url", ""), own.get("key_format", "{}")
        if "{key}" not in self.url:
            raise ValueError("option url must hold {key}")
        self.batch, self.attempts, self.least = int(own.get("batch", 100)), int(own.get("attempts", 4)), int(own.get("least_bytes", 1))
        self.timeout, self.pause, self.longest = float(own.get("timeout", 30)), float(own.get("pause", 1)), float(own.get("longest_pause", 60))
        if self.batch < 1 or self.attempts < 1:
            raise ValueError("options batch and attempts must be positive")
        self.keys: list[tuple[int, str]] | None = None
        self.low = self.high = 0
        if ("keys" in own) == ("range" in own):
            raise ValueError("give one of the options keys and range")
        if "keys" in own:
            self.keys = list(enumerate(dict.fromkeys(own["keys"].replace(",", " ").split())))
            if len(self.keys) > MOST_KEYS:
                raise ValueError(f"more than {MOST_KEYS} keys: use a range, or documents.fetch_missing for a table of keys")
        else:
            first, _, last = own["range"].partition(":")
            self.low, self.high = int(first), int(last) + 1
        self.only: set[str] | None = None

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes what can be decided from keys and numbers; the others stay with Spark."""
        for f in filters:
            attribute, value = getattr(f, "attribute", None), getattr(f, "value", None)
            if attribute == ("key",) and isinstance(f, EqualTo | In) and (isinstance(f, In) or value is not None):
                wanted = {v for v in value if v is not None} if isinstance(f, In) else {value}
                self.only = wanted if self.only is None else self.only & wanted
            elif attribute == ("number",) and value is not None and self.keys is None and isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual | LessThan | LessThanOrEqual):
                if isinstance(f, EqualTo | GreaterThan | GreaterThanOrEqual):
                    self.low = max(self.low, value + isinstance(f, GreaterThan))
                if isinstance(f, EqualTo | LessThan | LessThanOrEqual):
                    self.high = min(self.high, value + (not isinstance(f, LessThan)))
            else:
                yield f

    def _number(self, key: str) -> int | None:
        """The number of a key of the range, found from its digits and confirmed by formatting it."""
        before, _, after = self.form.partition("{")
        rest = key[len(before) : len(key) - len(after.partition("}")[2]) or None]
        return int(rest) if rest.lstrip("-").isdigit() and self.form.format(int(rest)) == key else None

    def partitions(self) -> list[Keys]:
        if self.keys is None and self.only is None:
            return [Keys(low=a, high=min(a + self.batch, self.high)) for a in range(self.low, self.high, self.batch)] or [Keys([])]
        if self.keys is None:
            found = sorted((n, key) for key in self.only if (n := self._number(key)) is not None and self.low <= n < self.high)
        else:
            found = [(n, key) for n, key in self.keys if self.only is None or key in self.only]
        return [Keys(found[a : a + self.batch]) for a in range(0, len(found), self.batch)] or [Keys([])]

    def read(self, partition: Keys) -> Iterator[pa.RecordBatch]:
        keys = iter(partition.keys) if partition.keys is not None else ((n, self.form.format(n)) for n in range(partition.low, partition.high))
        held: list[tuple] = []
        for n, key in keys:
            held.append((n, key, *self._get(key)))
            if len(held) == ROWS:
                yield self._rows(held)
                held = []
        if held:
            yield self._rows(held)

    def _rows(self, held: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int32(), pa.int32(), pa.string())
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*held, strict=True), kinds, strict=True)], names=[x.split()[0] for x in SCHEMA.split(", ")])

    def _get(self, key: str) -> tuple[str | None, int | None, int, str | None]:
        """(payload, status, attempts, error) of a key."""
        url, status, error = self.url.replace("{key}", urllib.parse.quote(key, safe="")), None, None
        for n in range(1, self.attempts + 1):
            wait = min(self.longest, self.pause * 2 ** (n - 1))
            try:
                with urllib.request.urlopen(url, timeout=self.timeout) as answer:
                    status, body = answer.status, answer.read()
                if status == 200 and len(body) >= self.least:
                    return body.decode("utf-8", "replace"), status, n, None
                error = f"{len(body)} bytes" if status == 200 else f"status {status}"
            except urllib.error.HTTPError as e:
                status, error = e.code, f"status {e.code}"
                if 400 <= e.code < 500 and e.code not in (408, 429):
                    return None, status, n, error
                asked = e.headers.get("Retry-After", "")
                wait = min(self.longest, float(asked)) if asked.isdigit() else wait
            except OSError as e:  # no connection, a broken one, or too slow
                status, error = None, f"{type(e).__name__}: {e}"[:200]
            if n < self.attempts:
                time.sleep(wait)
        return None, status, self.attempts, error

"""WARC archives: a writer over Spark's committed text output and a splittable reader.

Writer: each record is a gzip member of its own. Members of a partition are joined into chunks, and Spark's text
writer stores the chunks with an empty gzip member as its line separator; so archives go through the commit protocol
to any store that Spark writes, and remain valid gzip streams.

Reader: Spark's text source scans byte ranges for the gzip magic (its line separator here); a task owns the
candidates that start inside its ranges and reads the last one to its end. A candidate is validated by decoding its
header. A member that does not end before the next candidate goes on behind it: the magic also occurs inside of
compressed data, about once in 16 MB. Where a range ends inside such a member, the candidates of its file are walked
once more in their order, by one task that holds a member at a time; that is about one file in thousands.

Defined results: a null payload is empty; a null page_id or url leaves its header out; an empty table gives no
archive and no rows. Rows that repeat the largest page_id of a group of equal payloads are all responses. Payloads of any
length are whole records; other columns of the pages are not archived.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.common import fresh_path, prepare, saved

MAGIC = b"\x1f\x8b\x08"
EMPTY_MEMBER = gzip.compress(b"", 6, mtime=0)
CHUNK = 4 << 20
LEAST_REVISIT = 1000
PARSED = "page_id long, url string, record_type string, refers_to long, payload_bytes long, payload_digest string, payload binary"


def record(page_id: int | None, url: str | None, payload: bytes, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC/1.1 record as a gzip member. A revisit names the response and the full payload's length and digest, without the payload."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if revisit else http + payload
    name = uuid.uuid5(uuid.NAMESPACE_URL, f"{page_id}\n{url}")
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{name}>", "WARC-Date: 2024-01-01T00:00:00Z"]
    if url is not None:
        head.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if page_id is not None:
        head.append(f"X-Page-ID: {page_id}")
    if revisit:
        head.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        if refers_to is not None:
            head.append(f"X-Refers-To-Page-ID: {refers_to}")
    head += [f"WARC-Payload-Digest: sha1:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return gzip.compress("\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n", 6, mtime=0)


def parse(data: bytes) -> dict | None:
    """The fields of an uncompressed response or revisit record; None for records of other kinds."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode("utf-8", "replace").split("\r\n")
    fields = {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
    kind = fields.get("warc-type")
    if not version.startswith("WARC/") or kind not in ("response", "revisit"):
        return None
    block = rest[: int(fields.get("content-length", len(rest)))]
    http, _, payload = block.partition(b"\r\n\r\n")
    number = lambda x: int(x) if x is not None else None
    out = {"page_id": number(fields.get("x-page-id")), "url": fields.get("warc-target-uri"), "record_type": kind, "refers_to": number(fields.get("x-refers-to-page-id"))}
    if kind == "response":
        return out | {"payload_bytes": len(payload), "payload_digest": hashlib.sha1(payload).hexdigest(), "payload": payload}
    length = [v for k, _, v in (x.partition(b":") for x in http.split(b"\r\n")) if k.strip().lower() == b"content-length"]
    digest = base64.b32decode(fields["warc-payload-digest"].partition(":")[2]).hex()
    return out | {"payload_bytes": int(length[0]), "payload_digest": digest, "payload": None}


class Member:
    """A gzip member that is fed piece by piece. state: none (no WARC member), part (it goes on) or whole."""

    def __init__(self, data: bytes) -> None:
        self.out: list[bytes] = []
        self.state = "part"
        self.inflater = zlib.decompressobj(31)
        try:
            head = zlib.decompressobj(31).decompress(data[:2048], 64)  # the header first: cheap to refuse
        except zlib.error:
            head = b"?"
        if head and not head.startswith(b"WARC/"[: len(head)]):
            self.state = "none"
        else:
            self.feed(data)

    def feed(self, data: bytes) -> None:
        try:
            self.out.append(self.inflater.decompress(data))
            self.state = "whole" if self.inflater.eof else "part"
        except zlib.error:
            self.state = "none"


def assign_revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """page_id, url, payload, refers_to, revisit: of equal payloads of ``least`` bytes or more, all but the largest page_id revisit it."""
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    key = F.when(F.octet_length("payload") >= least, F.sha2("payload", 256))
    groups = rows.select("page_id", key.alias("k")).where("k is not null").groupBy("k").agg(F.count("*").alias("n"), F.max("page_id").alias("top"))
    groups = saved(groups.where("n > 1").drop("n"), "groups")
    # short pages need no partner: they stay where they are, and no null key gathers them
    long_, short = (rows.where(cond) for cond in (F.octet_length("payload") >= least, F.octet_length("payload") < least))
    rows = long_.withColumn("k", key).join(groups, "k", "left").drop("k").unionByName(short.withColumn("top", F.lit(None).cast("long")))
    revisit = F.col("top").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("top"))
    return rows.select("page_id", "url", "payload", F.when(revisit, F.col("top")).alias("refers_to"), revisit.alias("revisit"))


def write_archives(records: DataFrame, path: str) -> str:
    """Write rows of ``assign_revisits`` as WARC archives below ``path``."""
    prepare(records.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting, size = [], 0
        for b in batches:
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                waiting.append(m := record(*row))
                size += len(m)
                if size >= CHUNK:
                    yield pa.RecordBatch.from_arrays([pa.array([b"".join(waiting)], pa.binary())], names=["chunk"])
                    waiting, size = [], 0
        if waiting:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(waiting)], pa.binary())], names=["chunk"])

    chunks = records.select("page_id", "url", "payload", "refers_to", "revisit").mapInArrow(run, "chunk binary")
    chunks.select(F.col("chunk").cast("string").alias("value")).write.option("encoding", "ISO-8859-1").option("lineSep", EMPTY_MEMBER.decode("latin-1")).text(path)
    return path


RECORD = pa.schema([("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])


def _owned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of the candidates (value, file, start) of a task's ranges, with their file; a row with only a file if a
    range ends inside a member, which therefore goes on in the next range, behind a magic inside of it."""
    schema = RECORD.append(pa.field("file", pa.string()))
    rows: list[dict] = []
    blank = dict.fromkeys(schema.names)
    held: Member | None = None
    at = None
    for b in batches:
        for value, file, start in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if (file, start) != at:
                if held:
                    rows.append(blank | {"file": at[0]})
                held, at = None, (file, start)
                if start == 0 and not value:
                    continue  # nothing is before the first magic of a file
            data = MAGIC + value
            if held:
                held.feed(data)
            if not held or held.state == "none":  # a new member; one before it that was cut short is lost
                held = Member(data)
            if held.state == "whole" and (content := b"".join(held.out)) and (found := parse(content)):
                rows.append(blank | found | {"file": file})
            if held.state != "part":
                held = None
        yield pa.RecordBatch.from_pylist(rows, schema=schema)
        rows.clear()
    if held:
        yield pa.RecordBatch.from_pylist([blank | {"file": at[0]}], schema=schema)


def _in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The records of whole files, whose candidates come in order, one file behind the other."""
    rows: list[dict] = []
    member, at = None, None
    for b in batches:
        for value, file, start in zip(*(b.column(c).to_pylist() for c in ("value", "file", "start")), strict=True):
            if file != at:
                member, at = None, file
                if start == 0 and not value:
                    continue
            data = MAGIC + value
            if member:
                member.feed(data)
            if not member or member.state == "none":
                member = Member(data)
            if member.state == "whole" and (content := b"".join(member.out)) and (found := parse(content)):
                rows.append(found)
            if member.state != "part":
                member = None
        yield pa.RecordBatch.from_pylist(rows, schema=RECORD)
        rows.clear()


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """The records below ``path``, as PARSED. Files must not have an extension that makes Spark decompress them."""
    prepare(spark)
    text = spark.read.option("encoding", "ISO-8859-1").option("lineSep", MAGIC.decode("latin-1")).text(path)
    lines = text.select(F.col("value").cast("binary"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    found = saved(lines.mapInArrow(_owned, PARSED + ", file string"), "members")
    open_ends = found.where("record_type is null").select("file").distinct()
    records = found.where("record_type is not null")
    if open_ends.isEmpty():
        return records.select(RECORD.names)
    open_ends = saved(open_ends, "open")
    whole = lines.withColumn("n", F.monotonically_increasing_id()).join(open_ends, "file", "left_semi")
    again = whole.repartition("file").sortWithinPartitions("file", "start", "n").mapInArrow(_in_order, PARSED)
    return records.join(open_ends, "file", "left_anti").select(RECORD.names).unionByName(again)


def archive_pages(pages: DataFrame, path: str | None = None, least: int = LEAST_REVISIT) -> DataFrame:
    """Write ``pages`` (page_id, url, html) as WARC archives and read them back: PARSED."""
    path = path or fresh_path(pages.sparkSession, "warc")
    return read_archives(pages.sparkSession, write_archives(assign_revisits(pages, least), path))

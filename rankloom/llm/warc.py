"""Web archives: revisit resolution by payload digest, writing and reading of WARC files.

Archives are written and read by Spark's text source, so they may lie in any store that Spark knows. A record is
text (HTML in UTF-8), lines end in LF for Spark, and readers go by Content-Length, whatever a payload holds.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from rankloom.llm.common import join_hot
from rankloom.session import materialise

_READ = "page_id long, url string, record_type string, refers_to long, payload string, payload_bytes long, payload_digest string"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def headers(pages: DataFrame) -> DataFrame:
    """page_id, payload_bytes and payload_digest of each page; a null payload is empty."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            payloads = [(h or "").encode() for h in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(map(len, payloads), pa.int64()), pa.array(map(payload_digest, payloads), pa.string())],
                ["page_id", "payload_bytes", "payload_digest"])

    return pages.select("page_id", "html").mapInArrow(run, "page_id long, payload_bytes long, payload_digest string")


def resolve(found: DataFrame, least_bytes: int = 0) -> DataFrame:
    """Add record_type and refers_to to headers.

    Of equal payloads of at least ``least_bytes`` bytes the smallest page_id is the response and the others revisit
    it. Rows that share this page_id are all responses; a null page_id is never smallest unless all are null.
    """
    same = materialise(
        found.groupBy("payload_digest").agg(F.min("page_id").alias("first_id"), F.count("*").alias("n_same")), "digests")
    joined = join_hot(found, same, ["payload_digest"], "n_same")
    again = (F.col("payload_bytes") >= least_bytes) & F.col("first_id").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first_id"))
    return joined.select(
        "page_id", "payload_bytes", "payload_digest", F.when(again, "revisit").otherwise("response").alias("record_type"),
        F.when(again, F.col("first_id")).alias("refers_to"))


def write_archives(pages: DataFrame, resolved: DataFrame, path: str, date: str) -> None:
    """Write one record per page to gzipped archives under ``path``, payloads of responses only.

    Record ids are made of page_id, so a task that runs again writes the same bytes. Line ends in a URL are dropped.
    """
    spark_pages = pages.select("page_id", "url", "html")
    kinds = resolved.groupBy("page_id", "payload_digest").agg(  # rows that repeat give one
        F.first("record_type").alias("record_type"), F.first("refers_to").alias("refers_to"))
    keyed = spark_pages.mapInArrow(_with_digest, "page_id long, url string, html string, payload_digest string")
    joined = keyed.alias("p").join(kinds.alias("k"), F.expr("p.page_id <=> k.page_id and p.payload_digest = k.payload_digest"))
    rows = joined.select("p.page_id", "p.url", "p.html", "p.payload_digest", "k.record_type", "k.refers_to")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for big in batches:
            for batch in (big.slice(k, 500) for k in range(0, big.num_rows, 500)):
                yield pa.RecordBatch.from_arrays([pa.array([record(*row, date) for row in zip(*(c.to_pylist() for c in batch.columns), strict=True)], pa.string())], ["value"])

    rows.mapInArrow(run, "value string").write.option("compression", "gzip").option("lineSep", "\n").text(path)


def _with_digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        made = pa.array([payload_digest((h or "").encode()) for h in batch.column(2).to_pylist()], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, made], ["page_id", "url", "html", "payload_digest"])


def record(page_id: int | None, url: str | None, html: str | None, digest: str, kind: str, refers_to: int | None, date: str) -> str:
    """Text of a record, but for the LF that ends it."""
    payload = html or ""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload.encode())}\r\n\r\n"
    block = http + (payload if kind == "response" else "")
    lines = [
        "WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:page:{'none' if page_id is None else page_id}:{digest}>", f"WARC-Date: {date}",
        f"WARC-Target-URI: {' '.join(url.split())}" if url is not None else None, f"WARC-Payload-Digest: sha1:{digest}",
        f"WARC-Refers-To: <urn:page:{refers_to}:{digest}>" if kind == "revisit" else None,
        "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest" if kind == "revisit" else None,
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block.encode())}",
    ]
    return "\r\n".join(x for x in lines if x is not None) + "\r\n\r\n" + block + "\r\n\r"


def parse_records(lines: Iterator[str]) -> Iterator[tuple]:
    """Records from lines without their LF; one record is held at a time."""
    for line in lines:
        if not line.startswith("WARC/"):
            continue  # the second line end after a record
        head = _fields(lines)
        left, parts = int(head["content-length"]), []
        while left >= 0:
            part = next(lines)
            parts.append(part)
            left -= len(part.encode()) + 1
        block = "\n".join(parts).removesuffix("\r")
        http, _, payload = block.partition("\r\n\r\n")
        size = next(int(x.split(":")[1]) for x in http.split("\r\n") if x.startswith("Content-Length:"))
        own = head["warc-record-id"].strip("<>").split(":")[2]
        kind, data = head["warc-type"], payload.encode()
        yield (
            None if own == "none" else int(own), head.get("warc-target-uri"), kind,
            int(head["warc-refers-to"].strip("<>").split(":")[2]) if kind == "revisit" else None,
            payload if kind == "response" else None, len(data) if kind == "response" else size,
            payload_digest(data) if kind == "response" else head["warc-payload-digest"].removeprefix("sha1:"))


def _fields(lines: Iterator[str]) -> dict[str, str]:
    fields = {}
    for line in lines:
        line = line.removesuffix("\r")
        if not line:
            return fields
        name, _, value = line.partition(":")
        fields[name.lower()] = value.strip()
    raise ValueError("archive ends within the header of a record")


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of the archives: digests and sizes are taken from the payload itself where a record has one.

    A gzipped file is read by one task from its start, record by record.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for row in parse_records(line or "" for batch in batches for line in batch.column(0).to_pylist()):
            rows.append(row)
            size += row[5]
            if len(rows) == 1000 or size > 1 << 24:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    return spark.read.option("lineSep", "\n").text(path).mapInArrow(run, _READ)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], [x.split()[0] for x in _READ.split(", ")])


def deduplicate(pages: DataFrame, path: str, least_bytes: int = 0, date: str = "2024-01-01T00:00:00Z") -> DataFrame:
    """Resolve revisits, write archives under ``path`` and return the records read back from them.

    One row per page, repeated rows too. Empty input gives an empty archive. Other columns of ``pages`` are ignored.
    """
    found = materialise(headers(pages), "headers")
    write_archives(pages, resolve(found, least_bytes), path, date)
    return read_archives(pages.sparkSession, path)

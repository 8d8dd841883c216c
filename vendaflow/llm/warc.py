"""WARC archives as tables of record chunks."""

from __future__ import annotations

import base64
import bisect
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from vendaflow.llm.common import column, saved, text_or_empty

CHUNK_BYTES = 64 * 1024
VERSION = "WARC/1.1\r\n"
BETWEEN = "\r\n\r\n" + VERSION  # what separates the records of a file for the reader
HTTP_HEAD = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PAGE = "urn:page:"


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def payload_digest(payload: bytes) -> str:
    """Digest fed chunk by chunk through a view, without another copy of the payload."""
    state, view = hashlib.sha1(), memoryview(payload)
    for at in range(0, len(payload), CHUNK_BYTES):
        state.update(view[at : at + CHUNK_BYTES])
    return base32_sha1(state.digest())


def part(payload: bytes, a: int, b: int) -> bytes:
    """Bytes a to b of HTTP_HEAD, the payload and a line end, which are never put together."""
    head = HTTP_HEAD.encode()
    c, d = (max(0, i - len(head)) for i in (a, b))
    e, f = (max(0, i - len(payload)) for i in (c, d))
    return head[a:b] + payload[c:d] + b"\r\n"[e:f]


def cuts(payload: bytes, chunk_bytes: int) -> list[int]:
    """Where to cut the block of HTTP_HEAD and a payload into chunks of at least 32 bytes.

    Cuts are between characters, and so that no chunk, with what stands before and after it
    in a record, holds what separates records.
    """
    between, version = BETWEEN.encode(), VERSION.encode()
    length, size = len(HTTP_HEAD) + len(payload), len(between)
    found = re.compile(b"(?=" + re.escape(between) + b")").finditer
    # Separators in the payload, and those that begin in the head or end in the line end.
    marks = {m.start() + len(HTTP_HEAD) + 5 for m in found(payload)}
    for a, b in ((0, len(HTTP_HEAD) + size), (max(0, length - size), length + 2)):
        marks |= {m.start() + a + 5 for m in found(part(payload, a, b))}
    marks = sorted(marks)
    ends, end = [0], 0
    while end < length:
        at = ends[-1]
        end = min(length, max(at, len(HTTP_HEAD)) + max(32, chunk_bytes))
        later = bisect.bisect_right(marks, at)
        if later < len(marks):
            end = min(end, marks[later])
        while end < length and (
            part(payload, end, end + 1)[0] & 0xC0 == 0x80
            or part(payload, end, end + size).startswith((version, b"\r\n" + version))
            or (part(payload, max(at, end - size), end) + b"\r\n").endswith(between)
        ):
            end -= 1
        ends.append(end)
    return ends


def record(fields: list[tuple[str, object]], block: str, length: int) -> str:
    """One record as a row of text; the writer adds the last line feed."""
    head = "".join(f"{k}: {v}\r\n" for k, v in fields if v is not None)
    return f"{VERSION}{head}Content-Length: {length}\r\n\r\n{block}\r\n\r"


def target(url: str | None) -> str | None:
    """A URL fit for a header line: controls and spaces as percent codes; None stays None."""
    if url is None:
        return None
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def page_records(
    page: int | None, url: str | None, html: str | None, first: int | None, chunk_bytes: int
) -> Iterator[str]:
    """The records of one page: a revisit of page `first`, or a response in segments.

    An oversized response is cut into a first segment and `continuation` records, each of
    which names the record it continues and its segment number.
    """
    payload = text_or_empty(html).encode()
    name = f"<{PAGE}{'' if page is None else page}>"
    common = [
        ("WARC-Date", "2000-01-01T00:00:00Z"),
        ("WARC-Target-URI", target(url)),
        ("WARC-Payload-Digest", f"sha1:{payload_digest(payload)}"),
        ("Payload-Length", len(payload)),
    ]
    if first is not None and first != page:
        profile = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        yield record(
            [
                ("WARC-Type", "revisit"), ("WARC-Record-ID", name), *common,
                ("WARC-Profile", profile), ("WARC-Refers-To", f"<{PAGE}{first}>"),
            ],
            "", 0,
        )
        return
    ends = cuts(payload, chunk_bytes)
    many = len(ends) > 2
    for number, (a, b) in enumerate(zip(ends, ends[1:]), 1):
        one = part(payload, a, b).decode()
        if number == 1:
            fields = [
                ("WARC-Type", "response"), ("WARC-Record-ID", name), *common,
                ("Content-Type", "application/http; msgtype=response"),
                ("WARC-Segment-Number", 1 if many else None),
            ]
        else:
            fields = [
                ("WARC-Type", "continuation"), ("WARC-Record-ID", f"{name[:-1]}#{number}>"),
                ("WARC-Date", "2000-01-01T00:00:00Z"),
                ("WARC-Segment-Origin-ID", name), ("WARC-Segment-Number", number),
                ("WARC-Segment-Total-Length", b if b == ends[-1] else None),
            ]
        yield record(fields, one, b - a)


def first_pages(pages: DataFrame, least_bytes: int) -> DataFrame:
    """(page_id, digest, first): pages whose payload a page with a smaller id has, too."""
    payload = F.coalesce("html", F.lit(""))
    rows = pages.select(
        F.col("page_id").cast("bigint"),
        F.octet_length(payload).alias("bytes"),
        F.sha1(payload.cast("binary")).alias("digest"),
    )
    rows = saved(rows.filter(F.col("bytes") >= least_bytes), "payloads")
    first = (
        rows.groupBy("digest", "bytes")
        .agg(F.min("page_id").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
        .drop("n")
    )
    return (
        rows.join(first, ["digest", "bytes"])
        .filter("page_id > first")
        .select("page_id", "digest", "first")
        .distinct()
    )


def write_archives(
    pages: DataFrame, path: str, least_bytes: int = 0, chunk_bytes: int = CHUNK_BYTES
) -> None:
    """Write a record per page to compressed archives under `path`.

    Null html counts as an empty payload. Of pages with equal payloads of at least
    `least_bytes` bytes all but those with the smallest page_id become revisits; a page with a
    null page_id is always a response. Every row of the written text is one record or
    segment, so that no task holds more than one payload at a time.
    """
    again = first_pages(pages, least_bytes)
    digest = F.sha1(F.coalesce("html", F.lit("")).cast("binary"))
    rows = pages.select(
        F.col("page_id").cast("bigint"), "url", "html", digest.alias("digest")
    ).join(again, ["page_id", "digest"], "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, size = [], 0
            names = ("page_id", "url", "html", "first")
            for page, url, html, first in zip(*[column(batch, n) for n in names]):
                for one in page_records(page, url, html, first, chunk_bytes):
                    held.append(one)
                    size += len(one)
                    if size > 16 * chunk_bytes:
                        yield pa.record_batch({"value": pa.array(held, pa.string())})
                        held, size = [], 0
            yield pa.record_batch({"value": pa.array(held, pa.string())})

    rows.mapInArrow(run, "value string").write.option("lineSep", "\n").option(
        "compression", "gzip"
    ).text(path)


def parse(row: str) -> Iterator[tuple[dict[str, str], bytes]]:
    """The records in a row between two separators; more than one if the reader missed one."""
    rest = row.encode()
    while rest.strip(b"\r\n"):
        rest = rest.removeprefix(VERSION.encode())
        head, _, rest = rest.partition(b"\r\n\r\n")
        pairs = (line.partition(": ") for line in head.decode().split("\r\n"))
        fields = {k.lower(): v for k, _, v in pairs}
        length = int(fields["content-length"])
        if len(rest) < length:
            raise ValueError("a record is shorter than its Content-Length")
        yield fields, rest[:length]
        rest = rest[length:].removeprefix(b"\r\n\r\n")


def archive_rows(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("lineSep", BETWEEN).text(path)


def read_chunks(spark: SparkSession, path: str) -> DataFrame:
    """The chunked record table: (record_id, chunk_no, record_type, chunk), a row per segment.

    A record's chunks, in order of chunk_no from 1, are its payload. Revisits have one empty chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in column(batch, "value"):
                for fields, block in parse(row):
                    kind = fields["warc-type"]
                    record_id = fields.get("warc-segment-origin-id", fields["warc-record-id"])
                    if kind == "response":
                        block = block.partition(b"\r\n\r\n")[2]
                    kind = "response" if kind == "continuation" else kind
                    number = int(fields.get("warc-segment-number", 1))
                    yield pa.record_batch(
                        {
                            "record_id": pa.array([record_id.strip("<>")]),
                            "chunk_no": pa.array([number], pa.int64()),
                            "record_type": pa.array([kind]),
                            "chunk": pa.array([block], pa.binary()),
                        }
                    )

    return archive_rows(spark, path).mapInArrow(
        run, "record_id string, chunk_no bigint, record_type string, chunk binary"
    )


class Running:
    """A record whose segments are still coming: its digest and length so far."""

    def __init__(self, fields: dict[str, str]):
        self.fields, self.sha1, self.bytes = fields, hashlib.sha1(), 0
        self.number, self.length = int(fields.get("warc-segment-number", 1)), 0
        self.total = None if "warc-segment-number" in fields else -1  # -1: not in segments
        if self.number != 1:
            raise ValueError(f"{fields['warc-record-id']} begins with segment {self.number}")

    def add(self, block: bytes) -> None:
        """The block of the first segment, which in a response starts with the HTTP head."""
        self.length += len(block)
        if self.fields["warc-type"] == "response":
            block = block.partition(b"\r\n\r\n")[2]
        self.feed(block)

    def carry_on(self, fields: dict[str, str], chunk: bytes) -> None:
        """The next segment: it has to name this record and the number that follows."""
        name, number = fields["warc-segment-origin-id"], int(fields["warc-segment-number"])
        if name != self.fields["warc-record-id"] or number != self.number + 1 or self.total is not None:
            raise ValueError(f"segment {number} of {name} does not follow its record")
        total = fields.get("warc-segment-total-length")
        self.number, self.total = number, None if total is None else int(total)
        self.length += len(chunk)
        self.feed(chunk)

    def feed(self, chunk: bytes) -> None:
        self.sha1.update(chunk)
        self.bytes += len(chunk)

    def row(self) -> tuple:
        """(page_id, payload_bytes, payload_digest, record_type, refers_to), checked."""
        page = self.fields["warc-record-id"].strip("<>").removeprefix(PAGE)
        declared = self.fields["warc-payload-digest"].removeprefix("sha1:")
        refers = self.fields.get("warc-refers-to")
        if self.total not in (-1, self.length):
            raise ValueError(f"the segments of {page} do not have their total length")
        if refers is None:
            found = base32_sha1(self.sha1.digest())
            if found != declared:
                raise ValueError(f"the payload of {page} does not have its digest")
            size = self.bytes
        else:
            found, size = declared, int(self.fields["payload-length"])
        return (
            int(page) if page else None, size, found, self.fields["warc-type"],
            int(refers.strip("<>").removeprefix(PAGE)) if refers else None,
        )


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to.

    Segments of a record follow each other in a file, and a compressed file is read by one
    task from start to end, so that a running digest is all that is kept of a payload. A
    digest that differs from the record's header is an error, and so is a segment whose origin,
    number or total length is not that of the record it follows.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        going: Running | None = None

        def rows(records: Iterator) -> Iterator[tuple]:
            nonlocal going
            for fields, block in records:
                if fields["warc-type"] == "continuation":
                    if going is None:
                        raise ValueError("a file begins with a continuation")
                    going.carry_on(fields, block)
                    continue
                if going:
                    yield going.row()
                going = Running(fields)
                going.add(block)

        for batch in batches:
            found = [r for row in column(batch, "value") for r in rows(parse(row))]
            if found:
                yield _batch(found)
        if going:
            yield _batch([going.row()])

    return archive_rows(spark, path).mapInArrow(
        run,
        "page_id bigint, payload_bytes bigint, payload_digest string, record_type string,"
        " refers_to bigint",
    )


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64()]
    return pa.record_batch(
        {n: pa.array(c, k) for n, c, k in zip(names, zip(*rows), kinds)}
    )


RECORDS_SQL = r"""
WITH payloads AS (
    SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes,
        sha1(coalesce(html, '')) AS hex
    FROM pages
), firsts AS (
    SELECT hex, payload_bytes, min(page_id) AS first FROM payloads GROUP BY ALL
)
SELECT page_id, payload_bytes,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
        CAST((CAST('0x' || substr(hex, 5 * (i // 4) + 1, 5) AS BIGINT) >> (15 - 5 * (i % 4))) & 31
            AS INTEGER) + 1, 1)), '') AS payload_digest,
    CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
    CASE WHEN page_id <> first THEN first END AS refers_to
FROM payloads JOIN firsts USING (hex, payload_bytes)
"""

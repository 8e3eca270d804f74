"""WARC archives of web captures: written, read back and assembled into transactions.

Each capture is three records of one file: the response (or a revisit of an equal payload), the
request and a metadata record; the last two name the first in WARC-Concurrent-To.  Archives are
plain gzip text files whose record separator is Spark's line separator, so Spark's own writer
commits them.  The reader takes the pieces between version lines in file order; a payload that
holds a version line is put together again by its Content-Length, as gzip files are not split.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

VERSION = "WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_BATCH = 4 << 20

RECORD = "record_id string, type string, concurrent_to string, refers_to string, target string, digest string, fields map<string,string>, http_length long, payload binary"
_RECORD = pa.schema(
    [(x, pa.string()) for x in ("record_id", "type", "concurrent_to", "refers_to", "target", "digest")]
    + [("fields", pa.map_(pa.string(), pa.string())), ("http_length", pa.int64()), ("payload", pa.binary())]
)


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _line(text) -> str:
    """A header value: one line, without the characters that would end it."""
    return " ".join(str("" if text is None else text).split())


def record_id(page_id, url, payload_digest: str, kind: str) -> str:
    name = f"{page_id}\n{url}\n{payload_digest}\n{kind}"
    return f"<urn:uuid:{uuid.UUID(bytes=hashlib.sha256(name.encode()).digest()[:16])}>"


def _record(kind: str, own_id: str, url: str, headers: list[tuple[str, str]], block: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Record-ID", own_id), ("WARC-Date", DATE), ("WARC-Target-URI", url), *headers, ("Content-Length", str(len(block)))]
    return (VERSION + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n").encode() + block


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pages = [x.as_py() for x in batch.column("payload")]
        yield pa.RecordBatch.from_arrays(
            [*(batch.column(x) for x in ("page_id", "url")), pa.array([digest(x) for x in pages], pa.string()), pa.array([len(x) for x in pages], pa.int64()), batch.column("payload")],
            names=["page_id", "url", "digest", "size", "payload"],
        )


def _captures(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each page's records, without the blank lines after each."""
    for batch in batches:
        out = []
        for r in batch.to_pylist():
            url, own = _line(r["url"]), record_id(r["page_id"], r["url"], r["digest"], "capture")
            original = not r["revisit"]
            http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {r['size']}\r\n\r\n".encode()
            headers = [("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{r['digest']}")]
            if not original:
                first = record_id(r["first_id"], r["first_url"], r["digest"], "capture")
                headers += [("WARC-Profile", PROFILE), ("WARC-Refers-To", first), ("WARC-Refers-To-Target-URI", _line(r["first_url"])), ("WARC-Refers-To-Date", DATE)]
            out.append(_record("response" if original else "revisit", own, url, headers, http + (r["payload"] if original else b"")))
            path, host = "/" + "/".join(url.split("/")[3:]), (url.split("/") + ["", "", ""])[2]
            ask = f"GET {path} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
            link = ("WARC-Concurrent-To", own)
            out.append(_record("request", record_id(r["page_id"], r["url"], r["digest"], "request"), url, [("Content-Type", "application/http; msgtype=request"), link], ask))
            notes = "" if r["page_id"] is None else f"page-id: {_line(r['page_id'])}\r\n"
            if not original:
                notes += f"first-page-id: {_line(r['first_id'])}\r\n"
            out.append(_record("metadata", record_id(r["page_id"], r["url"], r["digest"], "metadata"), url, [("Content-Type", "application/warc-fields"), link], notes.encode()))
        for s in range(0, len(out), 256):
            yield pa.RecordBatch.from_arrays([pa.array(out[s : s + 256], pa.binary())], names=["record"])


def write_warc(pages: DataFrame, path: str, min_revisit_bytes: int = 0) -> None:
    """Archives of ``pages (page_id, url, html)`` under ``path``, one gzip file for each task.

    A null html is an empty payload, a null url or id stays empty.  Of pages with equal payloads of
    at least ``min_revisit_bytes``, the one of the least page id is a response and the rest revisit
    it; rows that share this id are all responses; pages of null id come last in that order.
    """
    kind = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.mapInArrow(_digests, f"page_id {kind}, url string, digest string, size long, payload binary")
    order = F.struct(F.col("page_id").isNull().alias("none"), "page_id", "url")
    firsts = rows.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("copies")).where("copies > 1")
    rows = rows.join(firsts.select("digest", "first"), "digest", "left")
    later = ~F.col("page_id").eqNullSafe(F.col("first.page_id")) & (F.col("size") >= min_revisit_bytes)
    rows = rows.select(
        "page_id", "url", "digest", "size", "payload", F.coalesce(F.col("first").isNotNull() & later, F.lit(False)).alias("revisit"),
        F.col("first.page_id").alias("first_id"), F.col("first.url").alias("first_url"),
    )
    records = rows.mapInArrow(_captures, "record binary").select(F.col("record").cast("string"))
    records.write.option("lineSep", "\r\n\r\n").option("compression", "gzip").text(path)


def _fields(lines: list[bytes]) -> dict[str, str]:
    out: dict[str, str] = {}
    for line in lines:
        name, colon, value = line.decode("utf-8", "replace").partition(":")
        if colon:
            out[name.strip().lower()] = value.strip()
    return out


def _parsed(piece: bytes) -> dict | None:
    """A record from the text after its version line; None if more must follow."""
    head, gap, block = piece.partition(b"\r\n\r\n")
    if not gap:
        return None
    fields = _fields(head.split(b"\r\n"))
    size = int(fields.get("content-length", 0))
    if len(block) < size:
        return None
    block = block[:size]
    kind, http_length = fields.get("warc-type", ""), None
    payload = block
    if fields.get("content-type", "").startswith("application/http"):
        http, _, payload = block.partition(b"\r\n\r\n")
        length = _fields(http.split(b"\r\n")[1:]).get("content-length", "")
        http_length = int(length) if length.isdigit() else None
    if kind == "metadata" or fields.get("content-type") == "application/warc-fields":
        fields |= _fields(block.split(b"\r\n"))
    return {
        "record_id": fields.get("warc-record-id"), "type": kind, "concurrent_to": fields.get("warc-concurrent-to"), "refers_to": fields.get("warc-refers-to"),
        "target": fields.get("warc-target-uri"), "digest": fields.get("warc-payload-digest", "").removeprefix("sha1:") or None, "fields": list(fields.items()), "http_length": http_length, "payload": payload,
    }


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def flush(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, schema=_RECORD)

    rows, held, file, size = [], None, None, 0
    for batch in batches:
        for name, piece in zip(batch.column("file").to_pylist(), batch.column("piece").to_pylist(), strict=True):
            if name != file and held is not None:
                raise ValueError(f"{file}: the last record is cut off")
            file = name
            if held is None and not piece.strip():
                continue
            held = piece if held is None else held + VERSION.encode() + piece
            record = _parsed(held)
            if record is not None:
                rows.append(record)
                size += len(held) + 500
                held = None
            if size >= _BATCH:
                yield flush(rows)
                rows, size = [], 0
    if held is not None:
        raise ValueError(f"{file}: the last record is cut off")
    if rows:
        yield flush(rows)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """One row for each record of the gzip archives under ``path``, see ``RECORD``.

    HTTP records give their body as ``payload`` and the Content-Length of their HTTP header as
    ``http_length``.  A record cut off at a file's end raises.
    """
    lines = spark.read.option("lineSep", VERSION).text(path)
    return lines.select(F.col("_metadata.file_path").alias("file"), F.col("value").cast("binary").alias("piece")).mapInArrow(_pieces, RECORD)


def transactions(records: DataFrame) -> DataFrame:
    """One nested row for each capture: its response or revisit with the request and metadata
    records that are concurrent to it.

    A capture without request or metadata has null there; of several concurrent records of a kind
    the one of least id is taken; requests and metadata of no capture are left out.  Captures
    repeated under one id stay as many rows.
    """

    def linked(kind: str):
        part = records.where(F.col("type") == kind).where("concurrent_to is not null")
        return part.groupBy(F.col("concurrent_to").alias("record_id")).agg(F.min_by(F.struct("record_id", "target", "fields", "payload"), F.struct("record_id")).alias(kind))

    captures = records.where(F.col("type").isin("response", "revisit"))
    return captures.join(linked("request"), "record_id", "left").join(linked("metadata"), "record_id", "left")

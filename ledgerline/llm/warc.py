"""WARC archives: writing captures, reading records, and assembling transactions.

A capture is written as three records: the request, the response (or a revisit
of the response with the same payload) and a metadata record.  Request and
metadata name the response in WARC-Concurrent-To.  Each record is a gzip
member of its own.  Files are committed by Spark's text writer, which passes
bytes through; its record separator is an empty gzip member, so a file is a
plain sequence of members.

Reading cuts each file into members, checks Content-Length, and returns one
row per record.  Assembly groups records by the identifier that they share
through concurrent-to and emits one nested row per capture.

Defined cases: a null payload is empty; a null url is left out; control
characters in a url are percent-encoded; rows that repeat a page id and its
payload are one capture each, all of them responses (or all revisits of the
same page); null page ids are kept, and any page with an id is preferred as the
response; an empty table gives archives without records; other columns are
not read.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import slices
from ledgerline.llm.common import col, staged

CRLF = b"\r\n"
SEGMENT_BYTES = 2 << 20      # compressed bytes handed to the writer at once
SEGMENTS_PER_FILE = 8
REVISIT_BROADCAST_ROWS = 100_000
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


def members(data: bytes, step: int = 1 << 16) -> Iterator[bytes]:
    """Contents of the gzip members, fed in steps so that what follows a member is not copied whole."""
    view, at = memoryview(data), 0
    while at < len(view):
        z, out = zlib.decompressobj(31), []
        while not z.eof:
            piece = view[at:at + step]
            if not piece:
                raise ValueError("the archive is cut short")
            out.append(z.decompress(piece))
            at += len(piece) - len(z.unused_data)
        yield b"".join(out)


def record_id(kind: str, page_id, digest: str) -> str:
    h = hashlib.md5(f"{kind}\n{page_id}\n{digest}".encode()).hexdigest()
    return f"<urn:uuid:{h[:8]}-{h[8:12]}-{h[12:16]}-{h[16:20]}-{h[20:]}>"


def warc_record(headers: list[tuple[str, str | None]], block: bytes) -> bytes:
    lines = [f"{k}: {v}" for k, v in headers if v is not None]
    return b"WARC/1.1\r\n" + "\r\n".join([*lines, f"Content-Length: {len(block)}"]).encode() + CRLF + CRLF + block + CRLF + CRLF


def clean_url(url: str | None) -> str | None:
    return None if url is None else re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url)


def capture(page_id, url: str | None, payload: bytes, refers_to_page, revisit: bool, date: str) -> list[bytes]:
    """The three records of a capture."""
    digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    url, main = clean_url(url), record_id("response", page_id, digest)
    host, path = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)(.*)", url or "", re.S).groups()
    common = [("WARC-Date", date), ("WARC-Target-URI", url)]
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    if revisit:
        first = record_id("response", refers_to_page, digest)
        headers = [("WARC-Type", "revisit"), ("WARC-Refers-To", first), ("WARC-Profile", PROFILE)]
        block = http
    else:
        headers, block = [("WARC-Type", "response")], http + payload
    request = f"GET {path or '/'} HTTP/1.1\r\nHost: {host}\r\n\r\n".encode()
    fields = "" if page_id is None else f"page-id: {page_id}\r\n"
    return [
        warc_record([("WARC-Type", "request"), ("WARC-Record-ID", record_id("request", page_id, digest)), *common,
                     ("WARC-Concurrent-To", main), ("Content-Type", "application/http; msgtype=request")], request),
        warc_record([*headers, ("WARC-Record-ID", main), *common, ("WARC-Payload-Digest", f"sha1:{digest}"),
                     ("Content-Type", "application/http; msgtype=response")], block),
        warc_record([("WARC-Type", "metadata"), ("WARC-Record-ID", record_id("metadata", page_id, digest)), *common,
                     ("WARC-Concurrent-To", main), ("Content-Type", "application/warc-fields")], fields.encode()),
    ]


def revisits(pages: DataFrame, min_payload_bytes: int = 0) -> DataFrame:
    """(id, sha, first): rows whose payload equals that of a smaller id.

    Equal payloads are counted before the exchange, so a payload that many
    pages share costs one row per task; only repeated payloads are joined back,
    where adaptive execution splits a hot one.
    """
    keys = pages.select("id", F.sha1("payload").alias("sha"), F.octet_length("payload").alias("size")) \
        .where(F.col("size") >= min_payload_bytes)
    repeated = keys.groupBy("sha", "size").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    return keys.join(repeated, ["sha", "size"]).where(~F.col("id").eqNullSafe(F.col("first"))).select("id", "sha", "first")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html",
                   min_payload_bytes: int = 0, date: str = "1970-01-01T00:00:00Z") -> None:
    """Write every row as a capture.  Of equal payloads of at least ``min_payload_bytes`` bytes the smallest id is
    the response and the others revisit it."""
    spark = pages.sparkSession
    src = pages.select(col(id_col).cast("bigint").alias("id"), col(url_col).cast("string").alias("url"),
                       F.coalesce(col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"))
    again = staged(revisits(src, min_payload_bytes).distinct(), "revisits")[0]
    if again.count() <= REVISIT_BROADCAST_ROWS:  # counted; beyond that both sides are shuffled
        again = F.broadcast(again)
    full = src.withColumn("sha", F.sha1("payload")).alias("p").join(
        again.alias("r"), F.col("p.id").eqNullSafe(F.col("r.id")) & (F.col("p.sha") == F.col("r.sha")), "left")
    full = full.select("p.id", "p.url", "p.payload", F.col("r.first").alias("first"), F.col("r.sha").isNotNull().alias("revisit"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, size = [], 0
        for batch in batches:
            rest = [batch.column(i).to_pylist() for i in (0, 1, 3, 4)]
            for at, rows in slices(batch.column(2)):
                for k, payload in enumerate(rows, at):
                    page_id, url, first, revisit = (c[k] for c in rest)
                    out += map(member, capture(page_id, url, payload, first, revisit, date))
                    size += len(out[-1]) + len(out[-2]) + len(out[-3])
                    if size >= SEGMENT_BYTES:
                        yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["segment"])
                        out, size = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array([b"".join(out)], pa.binary())], ["segment"])

    full.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value")).write \
        .option("compression", "none").option("encoding", "ISO-8859-1").option("lineSep", member(b"").decode("latin-1")) \
        .option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)


RECORD_SCHEMA = T.StructType([
    T.StructField("record_id", T.StringType()), T.StructField("record_type", T.StringType()),
    T.StructField("concurrent_to", T.StringType()), T.StructField("refers_to", T.StringType()),
    T.StructField("url", T.StringType()), T.StructField("fields", T.StringType()),
    T.StructField("payload", T.BinaryType()), T.StructField("payload_bytes", T.LongType()),
    T.StructField("payload_digest", T.StringType())])


def header_fields(text: str) -> dict[str, str]:
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in text.split("\r\n") if line)}


def parse_record(data: bytes) -> tuple:
    """One record as a row of :data:`RECORD_SCHEMA`."""
    head, _, rest = data.partition(CRLF + CRLF)
    version, _, head = head.partition(CRLF)
    if not version.startswith(b"WARC/"):
        raise ValueError("not a WARC record")
    h = header_fields(head.decode())
    block = rest[:int(h["content-length"])]
    if len(block) != int(h["content-length"]):
        raise ValueError(f"record {h.get('warc-record-id')} is cut short")
    kind, fields, payload, size, digest = h["warc-type"], None, None, None, None
    if kind in ("response", "revisit"):
        http, _, body = block.partition(CRLF + CRLF)
        if kind == "response":
            payload, size = body, len(body)
            digest = base64.b32encode(hashlib.sha1(body).digest()).decode()
            if h.get("warc-payload-digest", "sha1:" + digest) != "sha1:" + digest:
                raise ValueError(f"record {h.get('warc-record-id')} has another digest than its payload")
        else:
            size = int(header_fields(http.partition(CRLF)[2].decode())["content-length"])
            digest = h["warc-payload-digest"].removeprefix("sha1:")
    elif kind == "request":
        fields = block.decode("utf-8", "replace")
    elif kind == "metadata":
        fields = block.decode()
    return (h["warc-record-id"], kind, h.get("warc-concurrent-to"), h.get("warc-refers-to"), h.get("warc-target-uri"),
            fields, payload, size, digest)


def parsed(data: bytes, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for part in members(data):
        if part:
            rows.append(parse_record(part))
            size += len(part)
        if size >= limit:
            yield pa.RecordBatch.from_pylist([dict(zip(RECORD_SCHEMA.names, r)) for r in rows], ARROW_SCHEMA)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist([dict(zip(RECORD_SCHEMA.names, r)) for r in rows], ARROW_SCHEMA)


ARROW_SCHEMA = pa.schema([(f.name, {"string": pa.string(), "binary": pa.binary(), "bigint": pa.int64()}[f.dataType.simpleString()])
                          for f in RECORD_SCHEMA])


def read_records(spark: SparkSession, path: str) -> DataFrame:
    """One row per WARC record of the files in a folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                yield from parsed(content.as_py())
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content") \
        .mapInArrow(run, RECORD_SCHEMA)


def assemble(records: DataFrame) -> DataFrame:
    """One nested row per capture: ``transaction_id``, ``url`` and the structs ``response`` (record_id, record_type,
    refers_to, payload_bytes, payload_digest, payload), ``request`` and ``metadata`` (record_id, fields).

    A capture without a request or metadata record has null there.  Copies of
    a capture keep their number.
    """
    main = F.col("record_type").isin("response", "revisit")
    light = F.struct("record_id", "fields")
    whole = F.struct("record_id", "record_type", "refers_to", "payload_bytes", "payload_digest", "payload")
    txn = records.withColumn("transaction_id", F.when(main, F.col("record_id")).otherwise(F.col("concurrent_to")))
    return txn.groupBy("transaction_id").agg(
        F.count(F.when(main, 1)).alias("copies"),
        F.min(F.when(main, F.col("url"))).alias("url"),
        F.min(F.when(main, whole)).alias("response"),
        F.min(F.when(F.col("record_type") == "request", light)).alias("request"),
        F.min(F.when(F.col("record_type") == "metadata", light)).alias("metadata"),
    ).where("copies > 0").withColumn("copies", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).drop("copies")


def page_id_of(metadata_fields):
    return F.nullif(F.regexp_extract(metadata_fields, "(?m)^page-id: (-?[0-9]+)", 1), F.lit("")).cast("bigint")


def captures(spark: SparkSession, path: str) -> DataFrame:
    """Per capture of the archives: page_id, payload_bytes, payload_digest, record_type, refers_to (a page id)."""
    rows, _ = staged(assemble(read_records(spark, path)).select(
        "transaction_id", page_id_of(F.col("metadata.fields")).alias("page_id"), "response.payload_bytes",
        "response.payload_digest", "response.record_type", F.col("response.refers_to").alias("refers_id")), "captures")
    named = rows.where("record_type = 'response'").groupBy(F.col("transaction_id").alias("refers_id")) \
        .agg(F.min("page_id").alias("refers_to"))
    return rows.join(named, "refers_id", "left").select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")

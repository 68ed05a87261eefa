import base64
import gzip
import hashlib
import os

import pytest

from ledgerline.llm import warc as W
from ledgerline.session import scratch_path

ROWS = [(5, "http://a.example/x y?q", "same"), (3, "https://b.example", "same"), (9, None, "same"), (4, "u", "WARC/1.1\r\n\r\nContent-Length: 3\r\n"),
        (6, "u", ""), (7, "u", None), (8, "http://c\r\nX: y", "é😀" * 50_000), (8, "http://c", "é😀" * 50_000), (None, "n", "same"), (10, "u", "\x1f\x8b")]
SCHEMA = "page_id bigint, url string, html string"


def expected(rows, least=0):
    data = [(p, (h or "").encode()) for p, _, h in rows]
    out = []
    for p, b in data:
        first = min((q for q, c in data if c == b and q is not None), default=None)
        response = len(b) < least or p == first
        out.append((p, len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(), "response" if response else "revisit", None if response else first))
    return sorted(out, key=str)


@pytest.mark.parametrize("least", [0, 1])
def test_round_trip(spark, least):
    pages = spark.createDataFrame(ROWS, SCHEMA).selectExpr("*", "'c' as sha", "1 as payload", "2 as id")
    path = scratch_path(spark, "warc-test")
    W.write_archives(pages, path, min_payload_bytes=least)
    assert sorted(map(tuple, W.captures(spark, path).collect()), key=str) == expected(ROWS, least)


def test_nested_rows_and_plain_gzip(spark):
    path = scratch_path(spark, "warc-test")
    W.write_archives(spark.createDataFrame(ROWS[:2], SCHEMA).coalesce(1), path)
    rows = {r.response.record_type: r for r in W.assemble(W.read_records(spark, path)).collect()}
    assert bytes(rows["response"].response.payload) == b"same" and rows["revisit"].response.payload is None
    assert rows["revisit"].response.refers_to == rows["response"].transaction_id
    assert rows["revisit"].request.fields.startswith("GET /x%20y?q HTTP/1.1")
    folder = path.removeprefix("file:")
    name = next(f for f in os.listdir(folder) if f.startswith("part-") and os.path.getsize(f"{folder}/{f}"))
    assert gzip.open(f"{folder}/{name}").read().count(b"WARC/1.1\r\n") == 6  # any gzip reader takes the file


def test_empty_table_and_cut_files(spark):
    path = scratch_path(spark, "warc-test")
    W.write_archives(spark.createDataFrame([], SCHEMA), path)
    assert W.captures(spark, path).count() == 0
    whole = W.member(b"x" * 1000) + W.member(b"")
    assert list(W.members(whole, 7)) == [b"x" * 1000, b""]
    with pytest.raises(ValueError, match="cut short"):
        list(W.members(whole[:10]))

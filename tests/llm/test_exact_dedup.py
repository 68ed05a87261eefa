import hashlib
import random

import pytest
from helpers import EDGE_ROWS, edge_docs, empty_docs

from ledgerline.llm import exact_dedup


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups = {}
    for i, text in rows:
        groups.setdefault(lowered(text), []).append(i)
    out = []
    for text, ids in groups.items():
        keep = max(ids, key=lambda i: (i is not None, i or 0))
        sha = hashlib.sha256(text.encode()).hexdigest()
        out += [(i, keep, len(ids), sha) for i in ids]
    return sorted(out, key=str)


def got(df):
    rows = df.collect()
    kept = {}
    for r in rows:
        if r.kept:
            kept[r.text_sha256] = kept.get(r.text_sha256, 0) + 1
            assert r.doc_id == r.keep_id
    assert set(kept) == {r.text_sha256 for r in rows} and set(kept.values()) <= {1}  # one row of a group stays
    return sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in rows), key=str)


# few hash bits make unequal texts collide; small buckets split, and those of one hash chain
@pytest.mark.parametrize("bits, capacity", [(64, 1 << 14), (64, 3), (5, 4), (1, 2)])
def test_against_brute_force(spark, bits, capacity):
    rng = random.Random(bits)
    rows = [(i, rng.choice(["Aé", "aÉ", "x", "", None, "İI"]) if rng.random() < 0.4 else f"T{rng.randrange(150)} Üb") for i in range(400)]
    rows += [(i, "HOT copy") for i in range(400, 600)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert got(exact_dedup.dedup(docs, bits=bits, capacity=capacity)) == brute(rows)


def test_edge_rows(spark):
    docs = edge_docs(spark, clash=("h", "sha", "row", "chain", "bucket"))
    assert got(exact_dedup.dedup(docs)) == brute(EDGE_ROWS)
    assert exact_dedup.dedup(empty_docs(spark)).collect() == []


def test_buckets_fit_and_cover(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(500)], "doc_id bigint, text string")
    _, index, _ = exact_dedup.build_index(docs, capacity=8)
    rows = index.collect()
    per = {}
    for r in rows:
        per.setdefault((r.bucket, r.depth), []).append(r.h & (2**64 - 1))
    assert len(rows) == 500 and max(map(len, per.values())) <= 8 and len({d for _, d in per}) > 1
    for (bucket, depth), hashes in per.items():
        assert {h >> (64 - depth) for h in hashes} == {((bucket + 2**63) & (2**64 - 1)) >> (64 - depth)}


def test_overfull_bucket_of_one_hash_chains(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(40)], "doc_id bigint, text string")
    _, index, _ = exact_dedup.build_index(docs, capacity=3, bits=2)
    rows = index.collect()
    assert len(rows) == 40 and {r.depth for r in rows} == {64} and max(r.chain for r in rows) > 3


def test_lookup(spark):
    docs = spark.createDataFrame([(1, "One"), (2, "one"), (3, "two")], "doc_id bigint, text string")
    _, index, _ = exact_dedup.build_index(docs)
    new = spark.createDataFrame([("ONE",), ("three",)], "text string")
    assert [tuple(r) for r in exact_dedup.lookup(index, new).collect()] == [("ONE", 2, 2)]

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from helpers import EDGE_ROWS, edge_docs, empty_docs

from ledgerline.llm import max_sketch

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top=10):
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        found = []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // total
            score = sum(c * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m))
                        for t, c in Counter(terms(text)).items() if t in b)
            if score > 0 and i is not None:
                found.append((-score, i))
        out += [(item, k + 1, i, -s) for k, (s, i) in enumerate(sorted(found)[:top])]
    return sorted(out, key=str)


def ranked(spark, docs, items, **options):
    index = max_sketch.build_index(spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3))
    got = max_sketch.search(index, spark.createDataFrame(items, "item_id bigint, text string"), **options)
    return sorted((tuple(r) for r in got.collect()), key=str)


def sample(rng, n, words, vocabulary):
    return [(i, " ".join(f"W{int(rng.paretovariate(0.6)) % vocabulary}" for _ in range(rng.randrange(words)))) for i in range(n)]


@pytest.mark.parametrize("vocabulary, lot_terms", [(60, 1 << 17), (5000, 1 << 17), (400, 40)])
def test_against_brute_force(spark, vocabulary, lot_terms):
    rng = random.Random(vocabulary)
    docs, items = sample(rng, 300, 120, vocabulary), sample(rng, 25, 30, vocabulary)
    docs += [(1000 + i, docs[7][1]) for i in range(30)]  # ties across the tenth place
    items += [(3, items[5][1] + " again_more w1.W1"), (99, None), (98, "... --")]
    assert ranked(spark, docs, items, lot_terms=lot_terms) == brute(docs, items)


def test_edge_rows(spark):
    items = [(1, "word5x5 and THE other9"), (2, "日本 é"), (None, "lorem ipsum"), (4, None), (5, "")]
    assert ranked(spark, EDGE_ROWS, items) == brute(EDGE_ROWS, items)
    index = max_sketch.build_index(edge_docs(spark, clash=("n", "terms", "rank", "item")))
    clash = spark.createDataFrame([(1, "one", "x")], "item_id bigint, text string, score string")
    assert [(r.item_id, r["rank"], r.doc_id) for r in max_sketch.search(index, clash).collect()] == [(1, 1, 6)]
    none = max_sketch.build_index(empty_docs(spark))
    assert max_sketch.search(none, clash).collect() == []
    assert max_sketch.search(index, clash.limit(0)).collect() == []


def test_bounds_hold_and_prune():
    import pyarrow as pa

    rng = random.Random(4)
    texts = [" ".join(f"w{int(rng.paretovariate(0.7)) % 3000}" for _ in range(200)) for _ in range(600)]
    texts[10] += " needle1 needle2 needle3" * 3
    n, t, c, held, places, peaks, cells = max_sketch.folded(texts)
    batch = pa.RecordBatch.from_arrays([
        pa.array(range(600), pa.int64()), pa.array(n, pa.int64()), max_sketch.binaries(t, held), max_sketch.binaries(c, held),
        max_sketch.binaries(places, cells), max_sketch.binaries(peaks, cells)], max_sketch.INDEX.names)

    class Row:
        def __init__(self, text):
            _, a, b, *_ = max_sketch.folded([text])
            self.item_id, self.terms, self.counts = 1, a.tobytes(), b.tobytes()

    lot = max_sketch.Lot([Row(" ".join(texts[k].split()[:40]) + " needle1") for k in (3, 40, 500)], 0)
    lot.weigh(np.bincount(np.searchsorted(lot.vocabulary, t[np.isin(t, lot.vocabulary)]), minlength=len(lot.vocabulary)), 600)
    search = max_sketch.Search(lot, 600, int(n.sum()))
    seen = []
    exact = search.exact
    search.descend = lambda bounds, lo, ids, keys, impact: seen.append((bounds.copy(), keys, impact))
    search.add(batch)
    lo = 0
    for bounds, keys, impact in seen:
        doc, query = (x.ravel() for x in np.indices(bounds.shape))
        assert (bounds.ravel() >= exact(doc, query, keys, impact)).all()
        lo += len(bounds)
    assert lo == 600
    search = max_sketch.Search(lot, 600, int(n.sum()))
    search.add(batch)
    assert search.scored < search.pairs / 2  # the bounds leave most documents out

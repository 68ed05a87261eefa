import random
import re

import numpy as np
import pytest
from helpers import edge_docs, empty_docs

from ledgerline.llm import ngram_join as J
from ledgerline.llm.components import components


def shingles(text):
    w = re.findall("[^\x20\x09-\x0D]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(rows, least=75):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= least * len(sets[i] | sets[j]):
                root[find(i)] = find(j)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            smallest[find(i)] = min(smallest.get(find(i), d), d)
    return sorted(((d, len(s), smallest.get(find(i)) if s else d) for i, ((d, _), s) in enumerate(zip(rows, sets))), key=str)


def corpus(seed):
    """Groups of near copies with single and chained edits, shared passages, short texts and common lines."""
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choices("abcde", k=3))
    passage = [word() for _ in range(40)]
    line = [word() for _ in range(8)]
    texts = []
    for _ in range(8):
        base = [word() for _ in range(rnd.choice([6, 20, 60, 150]))]
        if rnd.random() < 0.5:
            base[3:3] = passage
        for _ in range(rnd.choice([1, 2, 25])):
            t = list(base)
            for _ in range(rnd.choice([0, 0, 1, 2, 5])):
                t[rnd.randrange(len(t))] = word()
            if rnd.random() < 0.3:
                base = t  # the next copies drift on
            texts.append(" ".join(t) + ("\n" + " ".join(line) if rnd.random() < 0.3 else ""))
    texts += [" ".join(line)] * 3 + ["One two", "one TWO", "", None, "É a b c d e", "é a b c d e"]
    rows = list(enumerate(texts))
    rnd.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_match_brute_force(spark, seed):
    rows = corpus(seed)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    assert sorted(map(tuple, J.join_components(df).collect()), key=str) == brute(rows)


def test_frequent_ngrams_and_many_blocks(spark, monkeypatch):
    """Frequent n-grams last in the order, and groups cut into many blocks."""
    rows = corpus(7)
    base = " ".join(f"w{i}" for i in range(120))
    rows += [(1000 + i, base.replace(f"w{7 * i % 120} ", f"v{i} ")) for i in range(90)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(1)
    hot = J.profile(df, 5).where("gram is not null and n >= 64").count()
    assert hot > 50
    assert sorted(map(tuple, J.join_components(df).collect()), key=str) == brute(rows)
    monkeypatch.setattr(J, "BLOCK_GRAMS", 300)
    monkeypatch.setattr(J, "PART_GRAMS", 500)
    monkeypatch.setattr(J, "BUCKET_GRAMS", 200)
    assert sorted(map(tuple, J.join_components(df).collect()), key=str) == brute(rows)


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark, clash=["cls", "n", "gram"])
    got = sorted(map(tuple, J.join_components(docs).collect()), key=str)
    assert got == brute([(r.doc_id, r.text) for r in docs.collect()])
    assert J.join_components(empty_docs(spark)).count() == 0


def test_shingle_sets_count_distinct_shingles():
    texts = ["a b c d e f", "A  B\tc\nd\x0be\x0cf", "a b c d", "", None, "x " * 50, "\x85 \xa0 e f g h"]
    sets = J.shingle_sets(texts)
    assert [len(s) for s in sets] == [len(shingles(t)) for t in texts]
    assert (sets[0] == sets[1]).all() and all((np.diff(s.astype(object)) > 0).all() for s in sets)


def test_components_of_chains_and_stars(spark):
    rnd = random.Random(4)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(5, 5)] + [(rnd.randrange(300, 400), rnd.randrange(300, 400)) for _ in range(60)]
    rnd.shuffle(links)
    got = dict(map(tuple, components(spark.createDataFrame(links, "a bigint, b bigint")).collect()))
    root = {x: x for e in links for x in e}
    while True:
        before = dict(root)
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
        if root == before:
            break
    assert got == root
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_a_block_of_long_near_copies_stays_in_memory():
    """131 queries of 2,000 n-grams against 500 classes: links are right, and few hits are expanded at once."""
    import tracemalloc

    rng = np.random.default_rng(3)
    base = np.sort(rng.integers(0, 2**63, 2000).astype(np.uint64))
    sets = []
    for k in range(631):
        own = base.copy()
        own[rng.choice(2000, (k % 9) * 60, replace=False)] = rng.integers(0, 2**63, (k % 9) * 60)
        sets.append(np.unique(own))
    rows = {"query": [k < 131 for k in range(631)], "cls": list(range(631)), "comp": list(range(631)), "n": [len(x) for x in sets],
            "fragment": [0] * 631, "grams": [x.view(np.int64) for x in sets]}
    tracemalloc.start()
    a, b = J.compared_block(rows, 75)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 200 << 20

    def parts(links):
        root = list(range(631))

        def find(i):
            while root[i] != i:
                i = root[i]
            return i

        for i, j in links:
            root[find(i)] = find(j)
        return [find(i) for i in range(631)]

    similar = []
    for i in range(131):
        for j in range(131, 631):
            o = len(np.intersect1d(sets[i], sets[j], assume_unique=True))
            if 100 * o >= 75 * (len(sets[i]) + len(sets[j]) - o):
                similar.append((i, j))
    want, got = parts(similar), parts(zip(a.tolist(), b.tolist()))
    assert len(set(zip(want, got))) == len(set(want)) == len(set(got)) > 1
    assert len(a) == 631 - len(set(want))  # no circles


def test_bucket_bits_identify_ngrams():
    grams = np.array([2**63 + 5, 2**63 + 5 + 2**40, 17, 2**64 - 1], np.uint64)
    for bits in (0, 3, 15, 16, 24, 30):
        buckets = 1 << bits
        for bucket in np.unique(J.leading(grams, buckets)).tolist():
            own = grams[J.leading(grams, buckets) == bucket]
            seg = {"keys": np.array([9], "<i8").tobytes(), "sizes": np.array([4], "<i4").tobytes(),
                   "low": (own & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes(), "high": (own >> np.uint64(32)).astype("<u2").tobytes(),
                   "owner": np.zeros(len(own), "<u2").tobytes()}
            got = J.unpack(seg, bucket, buckets)[2]
            assert len(np.unique(got)) == len(own) and (bits < 16 or (got == own).all())
    assert J.bucket_count(0) == J.bucket_count(J.BUCKET_GRAMS) == 1 and J.bucket_count(5 * J.BUCKET_GRAMS) == 8


def test_buckets_that_travel_together_share_class_keys(spark):
    rnd = random.Random(6)
    texts = [" ".join("".join(rnd.choices("abcdefgh", k=3)) for _ in range(rnd.choice([1, 30, 300]))) for _ in range(40)]
    sets = {J.fingerprints(g)[0]: g for g in J.shingle_sets(texts)}
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").coalesce(1)
    hot = np.sort(next(g for g in sets.values() if len(g) > 250))[:3]
    for buckets in (1, 2, 4, 64):
        together, bits = min(J.TOGETHER, buckets), buckets.bit_length() - 1
        rows = [r.asDict() for r in J.segments(df, 5, hot, buckets).collect()]
        assert sum(len(r["keys"]) // 8 for r in rows if r["load"] >= 0) <= len(sets) * buckets // together
        got = []
        for r in rows:
            for place in range(together if r["load"] >= 0 else 1):
                bucket = r["load"] * together + place if r["load"] >= 0 else r["load"]
                keys, sizes, grams = J.unpack(J.bucket_segment(r, place), bucket, buckets)
                got += zip(keys.tolist(), sizes.tolist(), grams.tolist(), [bucket < 0] * len(keys))
        low = min(J.LOW_BITS, 64 - bits)
        want = [(k, len(g), (int(x) >> 64 - bits << low if bits else 0) | int(x) & 2**low - 1, x in hot) for k, g in sets.items() for x in g]
        assert sorted(got) == sorted(want)


def test_small_numbers_are_packed_narrowly():
    for top, width in ((0, 1), (255, 1), (256, 2), (65536, 4), (2**32 - 1, 4)):
        x = np.array([0, 1, top, 3, top], np.int64)
        assert len(J.narrow(x)) == 5 * width and J.widened(J.narrow(x), 5).tolist() == x.tolist()
    assert J.widened(J.narrow(np.zeros(0, np.int64)), 0).tolist() == []
    for n in (0, 1, 4, 7):
        x = np.arange(n) % 4
        assert len(J.quarters(x)) == -(-n // 4) and J.from_quarters(J.quarters(x), n).tolist() == x.tolist()

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from helpers import EDGE_ROWS, edge_docs, empty_docs

from ledgerline.llm import repeats as R


def brute(rows, length):
    texts = [(t or "").encode() for _, t in rows]
    seen = Counter(t[i:i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (d, _), t in zip(rows, texts):
        cov = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i:i + length]] > 1:
                cov[i:i + length] = b"\1" * length
        runs = sum(1 for i in range(len(t)) if cov[i] and (i == 0 or not cov[i - 1]))
        out.append((d, len(t), sum(cov), runs, hashlib.sha256(bytes(b for b, x in zip(t, cov) if not x)).hexdigest()))
    return sorted(out, key=str)


def found(df):
    return sorted(((*tuple(r)[:4], hashlib.sha256(bytes(r.kept)).hexdigest()) for r in df.collect()), key=str)


def corpus(seed, alphabet):
    rnd = random.Random(seed)
    pool = ["".join(rnd.choices(alphabet, k=rnd.randint(1, 160))) for _ in range(12)]
    rows = []
    for i in range(120):
        rows.append((i, "".join(
            rnd.choice(pool)[rnd.randint(0, 20):rnd.randint(20, 160)] if rnd.random() < 0.6 else "".join(rnd.choices("xyz", k=rnd.randint(0, 60)))
            for _ in range(rnd.randint(0, 7)))))
    return rows + [(900, None), (901, ""), (902, "a" * 300), (903, "ab" * 200), (3, rows[3][1]), (None, rows[5][1])]


@pytest.mark.parametrize("limit", [20_000, 1])
@pytest.mark.parametrize("alphabet", ["abc d", "ab\0é", "a"])
def test_matches_brute_force(spark, alphabet, limit):
    rows = corpus(5, alphabet)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    assert found(R.dedup(df, length=40, gram=8, group_limit=limit)) == brute(rows, 40)


def test_edge_rows_and_empty_table(spark):
    docs = edge_docs(spark, clash=["text_key", "gram", "kept", "s"])
    # of the long text of one repeated line, every window occurs twice
    assert found(R.dedup(docs)) == brute_long(EDGE_ROWS)
    assert R.dedup(empty_docs(spark)).count() == 0


def brute_long(rows):
    """As ``brute`` with length 400, by hashes of windows."""
    texts = [(t or "").encode() for _, t in rows]
    hashes = [[hash(t[i:i + 400]) for i in range(len(t) - 399)] for t in texts]
    seen = Counter(h for x in hashes for h in x)
    out = []
    for (d, _), t, x in zip(rows, texts, hashes):
        diff = np.zeros(len(t) + 1, int)
        at = np.array([i for i, h in enumerate(x) if seen[h] > 1], int)
        np.add.at(diff, at, 1)
        np.add.at(diff, at + 400, -1)
        cov = np.cumsum(diff)[:-1] > 0
        runs = int((np.diff(cov.astype(int), prepend=0) == 1).sum())
        out.append((d, len(t), int(cov.sum()), runs, hashlib.sha256(np.frombuffer(t, np.uint8)[~cov].tobytes()).hexdigest()))
    return sorted(out, key=str)


def test_refined_order_sorts_and_gives_common_prefixes():
    rnd = random.Random(1)
    strings = ["".join(rnd.choices("ab\0", k=rnd.randint(0, 30))).encode() for _ in range(300)]
    group = np.array([rnd.randrange(5) for _ in strings])
    order, common = R.refined_order(group, *R.matrix(strings, 32))
    keys = [(group[i], strings[i].ljust(32, b"\0"), len(strings[i])) for i in order]
    assert keys == sorted(keys)
    for a, b, c in zip(order, order[1:], common[1:]):
        x, y = strings[a], strings[b]
        want = next((k for k in range(min(len(x), len(y))) if x[k] != y[k]), min(len(x), len(y)))
        assert c == (want if group[a] == group[b] else -1)


def test_every_window_has_its_anchor():
    rnd = random.Random(3)
    texts = ["".join(rnd.choices("ab", k=n)).encode() for n in (0, 39, 40, 41, 500)] + [b"z" * 100]
    text, gram, context, place, lo, hi = R.anchors(texts, 40, 8)
    covered = sorted((int(t), i) for t, a, b in zip(text, lo, hi) for i in range(a, b + 1))
    assert covered == [(k, i) for k, t in enumerate(texts) for i in range(len(t) - 39)]
    assert all(b <= p <= a + 32 for p, a, b in zip(place, lo, hi))


def test_anchors_do_not_depend_on_the_texts_beside():
    rnd = random.Random(4)
    own = "".join(rnd.choices("abc", k=600)).encode()
    others = ["".join(rnd.choices("abc", k=n)).encode() for n in (5_000, 200_000)]
    alone = np.stack(R.anchors([own], 40, 8)[1:])
    for beside in ([others[0]], others):
        text, *rest = R.anchors([*beside, own], 40, 8)
        assert (np.stack(rest)[:, text == len(beside)] == alone).all()


def test_planted_passages_are_cut_from_400_bytes_on(spark):
    # passages of 52 words and more, each in two documents that share nothing else: bytes decide, not words
    rnd = random.Random(6)
    words = lambda n: " ".join("".join(rnd.choices("abcdefgh", k=6)) for _ in range(n))
    rows, want = [], []
    for size in (370, 399, 400, 401, 700):
        passage = words(size // 7 + 1)[:size].strip().ljust(size, "x")
        assert len(passage) == size and len(passage.split()) >= 52
        for side in "01":
            rows.append((len(rows), words(40) + side + passage + side + words(40)))
            want.append((size if size >= 400 else 0, int(size >= 400)))
    got = found(R.dedup(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)))
    assert got == brute(rows, 400)
    assert [g[2:4] for g in got] == want

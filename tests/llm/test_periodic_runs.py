import hashlib
import random
import zlib

import pytest
from helpers import EDGE_ROWS, LONG, edge_docs, empty_docs

from ledgerline.llm import periodic_runs


def brute(words, least=24, periods=3):
    """Maximal stretches of equal words at every distance; those that a lesser period explains go."""
    n, out = len(words), []
    for q in range(1, n // periods + 1):
        i = 0
        while i < n - q:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j < n - q and words[j] == words[j + q]:
                j += 1
            length = j - i + q
            if length >= max(least, periods * q) and not any(all(words[x] == words[x + r] for x in range(i, i + length - r)) for r in range(1, q)):
                out.append((i, length, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def collapsed(words, found):
    gone = {k for s, length, q in found for k in range(s + q, s + length)}
    return " ".join(w for k, w in enumerate(words) if k not in gone)


def split(text):
    return [w for w in "".join(" " if c in "\t\n\x0b\x0c\r" else c for c in text or "").split(" ") if w]


def rigged(rng):
    words = [f"w{rng.randrange(rng.choice([2, 3, 50]))}" for _ in range(rng.randrange(90))]
    for _ in range(rng.randrange(4)):
        unit = words[-rng.randrange(1, 12):] or ["u"]
        words += unit * rng.randrange(2, 9) + unit[:rng.randrange(len(unit))]
    return words


@pytest.mark.parametrize("least, periods", [(24, 3), (6, 2), (4, 3), (1, 2), (40, 5)])
def test_runs_against_brute_force(least, periods):
    rng = random.Random(least)
    for _ in range(150):
        words = rigged(rng)
        text = " ".join(words).encode()
        spans, n = periodic_runs.stretches([b"", text, text], least, periods)
        assert spans[0] == [] and spans[1] == spans[2] and n.tolist() == [0, len(words), len(words)]
        found, kept = periodic_runs.collapse(text, spans[1], least, periods)
        want = brute(words, least, periods)
        assert found == want and kept.decode() == collapsed(words, want)
        ids = {}
        assert periodic_runs.runs_of([ids.setdefault(w, len(ids) + 1) for w in words], least, periods) == (want if len(words) >= least else [])


def test_fibonacci_words():
    a, b = ["x"], ["x", "y"]
    while len(b) < 300:
        a, b = b, b + a
    text = " ".join(b).encode()
    for least, periods in [(24, 3), (5, 2)]:
        spans, _ = periodic_runs.stretches([text], least, periods)
        assert periodic_runs.collapse(text, spans[0], least, periods)[0] == brute(b, least, periods)


def altered(doc_id, text):
    words = split(text)
    h = zlib.crc32(str(doc_id).encode())
    g, n = h // 10, len(words)
    if doc_id is None or h % 10 or not n:
        return words
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]


def row(doc_id, text):
    words = altered(doc_id, text)
    found = brute(words)
    best = None
    for r in found:
        if best is None or r[1] * best[2] > best[1] * r[2]:
            best = r
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return (doc_id, len(found), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
            sha("".join(f"{s},{k},{q}\n" for s, k, q in found)), sha(collapsed(words, found)))


def test_query_rows_against_brute_force(spark):
    rng = random.Random(9)
    rows = [(i, " ".join(rigged(rng)).replace(" ", rng.choice([" ", "\n", " \t"]))) for i in range(300)]
    assert sum(zlib.crc32(str(i).encode()) % 10 == 0 for i, _ in rows) > 15
    rows += [r for r in EDGE_ROWS if r[1] != LONG]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = periodic_runs.digest(periodic_runs.find_runs(periodic_runs.with_periods(docs)))
    assert sorted(map(tuple, got.collect()), key=str) == sorted((row(*r) for r in rows), key=str)


def test_edge_rows(spark):
    found = periodic_runs.find_runs(edge_docs(spark, clash=("runs", "n_words", "collapsed", "start"))).collect()
    assert len(found) == len(EDGE_ROWS)
    long = next(r for r in found if r.doc_id == 7)
    n = len(LONG.split())
    assert [tuple(r) for r in long.runs] == [(0, n, 5)] and long.n_words == n and long.collapsed == "lorem ipsum dolor sit amet"
    assert all(r.collapsed == "" for r in found if r.doc_id in (3, 4, 5))
    none = periodic_runs.with_periods(empty_docs(spark))
    assert periodic_runs.digest(periodic_runs.find_runs(none)).collect() == []

"""Periodic runs of words, by suffix trees and longest common extensions.

A run is a stretch of consecutive words with smallest period q, at least
``MIN_LENGTH`` words and ``MIN_PERIODS`` periods long, that no neighbouring word
extends.  A stretch of words gets two suffix trees by Ukkonen's construction,
of itself and of its reversal.  A tree's Euler tour visits the leaves in suffix
order; the least string depth between two leaves is the depth of their lowest
common ancestor, so a sparse table over it answers longest common extensions in
constant time.  Every run has a Lyndon root that is the longest Lyndon word at
its place, in the order of words or in the reversed one; suffix ranks give these
words, one for each place and order.  Each is extended in both directions, and
what is long enough is a run.

Words that cannot lie in a run are set aside before: in a run every window of a
few words recurs at the distance of the period.  Windows are told apart by
hash, which can only let too many words pass; the trees compare words.

Tasks work on their own documents, nothing is shuffled.  Memory is bounded by
the longest stretch of recurring words in one document.

Defined cases: null and empty texts have no words, no runs and an empty
collapsed text; null ids pass through; repeated rows are treated one by one; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import slices
from ledgerline.llm.common import col, let
from ledgerline.llm.textwords import hash_words, mix, runs as places, space_table

MIN_LENGTH = 24
MIN_PERIODS = 3

RUN = T.StructType([T.StructField(c, T.LongType()) for c in ("start", "length", "period")])
RESULT = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n_words", T.LongType()),
                       T.StructField("runs", T.ArrayType(RUN)), T.StructField("collapsed", T.StringType())])


class SuffixTree:
    """Ukkonen's suffix tree of positive numbers, closed by a 0 that is less than all."""

    def __init__(self, numbers: list[int]):
        self.text = text = [*numbers, 0]
        self.size = n = len(text)
        start, end, link, kids = [0], [0], [0], [{}]
        node = edge = length = rest = 0
        for i, c in enumerate(text):
            rest += 1
            split = 0
            while rest:
                if not length:
                    edge = i
                below = kids[node]
                first = text[edge]
                child = below.get(first)
                if child is None:
                    below[first] = len(start)
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    if split:
                        link[split] = node
                        split = 0
                else:
                    along = end[child] - start[child]
                    if length >= along:
                        edge += along
                        length -= along
                        node = child
                        continue
                    if text[start[child] + length] == c:
                        length += 1
                        if split:
                            link[split] = node
                        break
                    new = len(start)
                    at = start[child]
                    start[child] = at + length
                    below[first] = new
                    start.append(at), end.append(at + length), link.append(0), kids.append({text[at + length]: child, c: new + 1})
                    start.append(i), end.append(n), link.append(0), kids.append(None)
                    if split:
                        link[split] = new
                    split = new
                rest -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = i - rest + 1
        self.start, self.end, self.kids = start, end, kids

    def tour(self, reverse: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Suffixes in the order of the Euler tour, and the depth of the lowest common ancestor with the one before.

        ``reverse`` turns the order of the numbers around, but for the closing 0.
        """
        start, end, kids = self.start, self.end, self.kids
        leaves, depths, todo = [], [], [(0, 0, 0)]
        while todo:
            node, depth, shared = todo.pop()
            below = kids[node]
            if below is None:
                leaves.append(start[node] - depth)
                depths.append(shared)
                continue
            depth += end[node] - start[node]
            order = sorted(below, reverse=not reverse)  # the last one pushed is visited first
            if reverse and order[0] == 0:
                order.append(order.pop(0))
            last = below[order.pop()]
            todo += [(below[c], depth, depth) for c in order]
            todo.append((last, depth, shared))
        return np.array(leaves), np.array(depths)


class Extension:
    """Longest common extensions of pairs of places, in constant time each."""

    def __init__(self, numbers: list[int]):
        self.tree = SuffixTree(numbers)
        leaves, depths = self.tree.tour()
        self.rank = np.empty(len(leaves), np.int64)
        self.rank[leaves] = np.arange(len(leaves))
        self.levels = [depths.astype(np.int32)]
        while 2 << len(self.levels) - 1 <= len(depths):
            last, half = self.levels[-1], 1 << len(self.levels) - 1
            self.levels.append(np.minimum(last[:-half], last[half:]))
        self.log = np.zeros(len(depths) + 1, np.int64)
        for k in range(1, len(self.levels)):
            self.log[1 << k:] = k

    def lengths(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Words that agree from ``a`` and ``b`` on; the places of a pair differ."""
        x, y = self.rank[a], self.rank[b]
        lo, hi = np.minimum(x, y) + 1, np.maximum(x, y) + 1
        out = np.empty(len(a), np.int64)
        level = self.log[hi - lo]
        for k in np.unique(level).tolist():
            at = np.flatnonzero(level == k)
            out[at] = np.minimum(self.levels[k][lo[at]], self.levels[k][hi[at] - (1 << k)])
        return out


def longest_lyndon(rank: list[int]) -> np.ndarray:
    """Length of the longest Lyndon word at each place: up to the next lesser suffix."""
    n = len(rank) - 1  # the closing 0 is the least
    following = [0] * (n + 1)
    for i in range(n - 1, -1, -1):
        own, j = rank[i], i + 1
        while rank[j] > own:
            j = following[j]
        following[i] = j
    return np.array(following[:n]) - np.arange(n)


def runs_of(numbers: list[int], least: int = MIN_LENGTH, periods: int = MIN_PERIODS) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run, by start and period."""
    n = len(numbers)
    if n < least:
        return []
    ahead, back = Extension(numbers), Extension(numbers[::-1])
    turned = np.empty(n + 1, np.int64)
    turned[ahead.tree.tour(reverse=True)[0]] = np.arange(n + 1)
    found = []
    for rank in (ahead.rank, turned):
        period = longest_lyndon(rank.tolist())
        i = np.flatnonzero(periods * period <= n)
        p = period[i]
        stop = i + p + ahead.lengths(i, i + p)  # a place at the end has the closing 0, which agrees with nothing
        start = i - back.lengths(n - i, n - i - p)
        length = stop - start
        good = (length >= least) & (length >= periods * p)
        found.append(np.stack([start[good], length[good], p[good]], axis=1))
    return [tuple(r) for r in np.unique(np.concatenate(found), axis=0).tolist()]


def stretches(texts: list[bytes], least: int, periods: int) -> tuple[list[list[tuple[int, int]]], np.ndarray]:
    """Per text the stretches (first word, end) that hold all its runs; and its number of words."""
    h, n = hash_words(texts, space_table(lower=False))
    width = max(1, least * (periods - 2) // periods)  # a run is at least two periods and a window long
    owner, place = np.repeat(np.arange(len(n)), n), places(n)
    none = [[] for _ in texts]
    start = np.flatnonzero(place + width <= np.repeat(n, n))
    if not len(start):
        return none, n
    key = mix(owner[start].astype(np.uint64) + np.uint64(1))
    for k in range(width):
        key = mix(key + h[start + k])
    order = np.argsort(key, kind="stable")
    same = key[order][1:] == key[order][:-1]
    gap = np.where(same, np.diff(start[order]), np.int64(1) << 60)
    near = np.empty(len(start), np.int64)
    near[order] = np.minimum(np.concatenate([[1 << 60], gap]), np.concatenate([gap, [1 << 60]]))
    while True:
        # neighbours in a stretch are neighbours in one text
        keep = near < 1 << 60
        start, near = start[keep], near[keep]
        if not len(start):
            return none, n
        first = np.flatnonzero(np.concatenate([[True], (np.diff(start) != 1) | (np.diff(owner[start]) != 0)]))
        size = np.diff(np.append(first, len(start)))
        cover = np.repeat(size + width - 1, size)
        bad = (cover < least) | (periods * near > cover)
        if not bad.any():
            break
        near = np.where(bad, np.int64(1) << 60, near)
    for a, k in zip(first.tolist(), size.tolist()):
        at = int(place[start[a]])
        none[owner[start[a]]].append((at, at + k + width - 1))
    return none, n


def collapse(text: bytes, spans: list[tuple[int, int]], least: int, periods: int) -> tuple[list[tuple[int, int, int]], bytes]:
    """A text's runs, and its words without those in a run after the run's first period."""
    words = text.split()  # of bytes: at U+0009 to U+000D and spaces
    found = []
    for a, b in spans:
        ids: dict[bytes, int] = {}
        numbers = [ids.setdefault(w, len(ids) + 1) for w in words[a:b]]
        found += [(a + s, k, p) for s, k, p in runs_of(numbers, least, periods)]
    found.sort(key=lambda r: (r[0], r[2]))
    if found:
        keep = np.ones(len(words), bool)
        for s, k, p in found:
            keep[s + p:s + k] = False
        words = [words[i] for i in np.flatnonzero(keep).tolist()]
    return found, b" ".join(words)


def find_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = MIN_LENGTH,
              periods: int = MIN_PERIODS) -> DataFrame:
    """``id_col``, ``n_words``, ``runs`` (start, length, period, by start and period) and the ``collapsed`` text of every row."""
    kinds = pa.list_(pa.struct([(f.name, pa.int64()) for f in RUN]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1), 2 << 20):
                texts = [t or b"" for t in texts]
                spans, n = stretches(texts, least, periods)
                found, kept = zip(*[collapse(t, s, least, periods) for t, s in zip(texts, spans)])
                rows = [[dict(zip(RUN.names, r)) for r in f] for f in found]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), pa.array(rows, kinds),
                    pa.array(kept, pa.binary()).cast(pa.string())], RESULT.names)

    src = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").cast("binary").alias("text"))
    out = src.mapInArrow(run, RESULT)
    return out.select(F.col("doc_id").alias(id_col), "n_words", "runs", "collapsed")


def with_periods(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with the texts of a tenth of the ids made periodic from some word on, as the id's CRC-32 says."""
    mark = F.crc32(col(id_col).cast("string").cast("binary"))
    words = F.filter(F.split(col(text_col), "[ \\t-\\r]+"), lambda w: w != "")

    def repeated(w: Column) -> Column:
        n, g = F.size(w).cast("bigint"), F.floor(mark / 10)
        a = F.pmod(g, n)
        p = 1 + F.floor((n - a) / (3 + F.pmod(g, F.lit(8))))
        from_word = lambda v: F.transform(F.sequence(F.lit(0).cast("bigint"), n - 1), lambda i: F.get(
            w, F.when(i < v["a"], i).otherwise(v["a"] + F.pmod(i - v["a"], v["p"])).cast("int")))
        return F.when(n > 0, let(F.struct(a.alias("a"), p.alias("p")), lambda v: F.concat_ws(" ", from_word(v)))).otherwise(F.lit(""))

    changed = F.when((F.pmod(mark, F.lit(10)) == 0) & col(text_col).isNotNull(), let(words, repeated)).otherwise(col(text_col))
    return docs.select(col(id_col).alias(id_col), changed.alias(text_col))


def digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Per row the number of runs, the run of most periods, and digests of all runs and of the collapsed text."""
    line = lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n"))
    more = lambda best, r: best.isNull() | (r["length"] * best["period"] > best["length"] * r["period"])
    top = F.aggregate("runs", F.lit(None).cast(RUN), lambda best, r: F.when(more(best, r), r).otherwise(best))
    out = found.withColumn("top", top)
    return out.select(
        id_col, F.size("runs").cast("bigint").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(F.lit(1000) * F.col("top.length") / F.col("top.period")).cast("bigint").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"))

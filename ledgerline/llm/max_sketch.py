"""Ranked lexical search by hashed max-sketches.

*Index.*  Each document's distinct terms and their occurrences are folded into
a sketch: a term's hash names one of ``COORDINATES`` coordinates, which holds
the greatest number of occurrences folded into it.  For a fixed document length
a term's impact grows with its occurrences, so a coordinate's impact is at least
that of every term in it.  The index (sketch and terms) is a table on the
shared folder, written by one scan of the texts.

*Search.*  Queries are taken in lots of bounded size, broadcast as term weights.
A task multiplies a block of sketches with the weights of all queries of the
lot at once: an upper bound of every document's score for every query.  Then,
per query, documents are scored exactly in descending order of their bounds,
until no bound reaches the query's threshold, the score of its tenth document
so far.  A task hands on its ten best a query; they meet in two steps.

A score sums, over the query's terms with repeats, ``w * impact`` in 64-bit
integers, with ``w = floor(1000 ln((2N+2) / (2df+1)))``, impact
``(10**9 tf) div (1000 tf + 8m)`` and ``m = 25 + (75 n N) div L``.  Bounds are
products in doubles, rounded up by more than their error.  Terms are told apart
by 64-bit hash.

Defined cases: null and empty texts have no term, are not counted in N and
match nothing; a query without terms has no rows; documents without an id count
in N, L and df but are never listed; repeated rows are documents of their own;
rows that repeat a query id are queries of their own; equal scores stand by
ascending id; empty tables give an empty result; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import binaries, slices
from ledgerline.llm.common import col, staged
from ledgerline.llm.textwords import hash_words, runs

COORDINATES = 1 << 10
TOP = 10
LOT_TERMS = 1 << 17   # query terms, on average, that are broadcast at once
DOC_BLOCK = 512       # documents whose bounds are taken at once
QUERY_BLOCK = 512     # and queries
TASKS_MERGED = 256    # tasks whose best documents meet in the first step

INDEX = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                      T.StructField("terms", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                      T.StructField("places", T.BinaryType()), T.StructField("peaks", T.BinaryType())])


def term_table() -> np.ndarray:
    """Byte map for terms: ASCII letters in lower case, digits, and every byte of other code points; 0 separates."""
    t = np.zeros(256, np.uint8)
    for b in [*range(48, 58), *range(97, 123), *range(128, 256)]:
        t[b] = b
    t[65:91] = t[97:123]
    return t


def numbers(column: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(numbers of all values in a row, how many each value has) of a binary column."""
    sizes = np.array([len(x.as_buffer()) for x in column], np.int64) // np.dtype(kind).itemsize
    return np.frombuffer(b"".join(x.as_buffer() for x in column), kind), sizes


def folded(texts: list[str | None]) -> tuple[np.ndarray, ...]:
    """Per text its number of terms; distinct terms (ordered by hash), occurrences and numbers of them; the same of the sketch."""
    h, n = hash_words([(t or "").encode("utf-8", "surrogatepass") for t in texts], term_table())
    owner = np.repeat(np.arange(len(n)), n)
    order = np.lexsort((h, owner))
    h = h[order]  # owners were in order already
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (owner[1:] != owner[:-1])])) if len(h) else np.zeros(0, np.int64)
    terms, counts, owner = h[first], np.diff(np.append(first, len(h))).astype(np.uint32), owner[first]
    place = (terms >> np.uint64(64 - COORDINATES.bit_length() + 1)).astype(np.uint16)
    lead = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])])) if len(terms) else first
    peaks = np.maximum.reduceat(counts, lead) if len(lead) else counts
    per = lambda x: np.bincount(x, minlength=len(n))
    return n, terms, counts, per(owner), place[lead], peaks, per(owner[lead])


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The sketch index of all documents, on the shared folder."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, texts in slices(batch.column(1), 2 << 20):
                n, terms, counts, held, places, peaks, cells = folded(texts)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(texts)), pa.array(n, pa.int64()), binaries(terms, held), binaries(counts, held),
                    binaries(places, cells), binaries(peaks, cells)], INDEX.names)

    src = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").alias("text"))
    return staged(src.mapInArrow(run, INDEX), "sketch-index")[0]


class Lot:
    """Queries with their term weights."""

    def __init__(self, items: list, key: int):
        """``items``: rows (item_id, terms, counts); ``key`` numbers the lot."""
        self.ids = [r.item_id for r in items]
        self.keys = (key << 32) + np.arange(len(items), dtype=np.int64)
        terms = [np.frombuffer(r.terms, "<u8") for r in items]
        self.sizes = np.array([len(t) for t in terms], np.int64)
        self.vocabulary, self.term = np.unique(np.concatenate(terms), return_inverse=True)
        self.times = np.concatenate([np.frombuffer(r.counts, "<u4") for r in items]).astype(np.int64)

    def weigh(self, df: np.ndarray, n: int) -> None:
        w = np.array([math.floor(1000 * math.log((2 * n + 2) / (2 * x + 1))) for x in df.tolist()], np.int64)
        self.weight = w[self.term] * self.times
        self.start = np.cumsum(self.sizes) - self.sizes

    def matrix(self, lo: int, hi: int) -> np.ndarray:
        """Weights of the queries from ``lo`` up to ``hi``, summed by coordinate."""
        a, b = self.start[lo], self.start[hi - 1] + self.sizes[hi - 1]
        place = (self.vocabulary[self.term[a:b]] >> np.uint64(64 - COORDINATES.bit_length() + 1)).astype(np.int64)
        query = np.repeat(np.arange(hi - lo), self.sizes[lo:hi])
        out = np.bincount(place * (hi - lo) + query, weights=self.weight[a:b], minlength=COORDINATES * (hi - lo))
        return out.reshape(COORDINATES, hi - lo)


class Search:
    """A task's best documents for every query of a lot."""

    def __init__(self, lot: Lot, n_docs: int, n_terms: int, top: int = TOP):
        self.lot, self.n_docs, self.n_terms, self.top = lot, n_docs, n_terms, top
        self.query, self.score, self.doc = (np.zeros(0, np.int64) for _ in range(3))
        self.threshold = np.ones(len(lot.ids), np.int64)  # scores of 0 are no matches
        self.scored = self.pairs = 0
        self.matrices: dict[int, np.ndarray] = {}

    def impacts(self, tf: np.ndarray, m: np.ndarray) -> np.ndarray:
        tf = tf.astype(np.int64)
        return 1_000_000_000 * tf // (1000 * tf + 8 * m)

    def add(self, batch: pa.RecordBatch) -> None:
        named = np.flatnonzero(np.array(batch.column(0).is_valid()) & (batch.column(1).to_numpy() > 0))
        batch = batch.take(pa.array(named))
        for at in range(0, batch.num_rows, DOC_BLOCK):
            self.add_block(batch.slice(at, DOC_BLOCK))

    def add_block(self, block: pa.RecordBatch) -> None:
        ids, n = block.column(0).to_numpy(), block.column(1).to_numpy()
        m = 25 + 75 * n * self.n_docs // self.n_terms
        place, cells = numbers(block.column(4), "<u2")
        owner = np.repeat(np.arange(len(ids)), cells)
        sketch = np.zeros((len(ids), COORDINATES))
        sketch[owner, place] = self.impacts(numbers(block.column(5), "<u4")[0], m[owner])
        # the terms that some query has, ordered by document and term
        terms, held = numbers(block.column(2), "<u8")
        vocabulary = self.lot.vocabulary
        at = np.minimum(np.searchsorted(vocabulary, terms), len(vocabulary) - 1)
        known = np.flatnonzero(vocabulary[at] == terms)
        owner = np.repeat(np.arange(len(ids)), held)[known]
        keys = owner * len(vocabulary) + at[known]
        impact = self.impacts(numbers(block.column(3), "<u4")[0][known], m[owner])
        for lo in range(0, len(self.lot.ids), QUERY_BLOCK):
            hi = min(lo + QUERY_BLOCK, len(self.lot.ids))
            if lo not in self.matrices:
                if len(self.matrices) >= 4:
                    self.matrices.clear()
                self.matrices[lo] = self.lot.matrix(lo, hi)
            bounds = sketch @ self.matrices[lo]
            bounds += bounds * 2.0**-40
            self.descend(bounds, lo, ids, keys, impact)

    def descend(self, bounds: np.ndarray, lo: int, ids: np.ndarray, keys: np.ndarray, impact: np.ndarray) -> None:
        """Score documents in descending order of their bounds, some for every query at a step, down to the thresholds."""
        step, n = self.top, bounds.shape[1]
        self.pairs += int((bounds > 0).sum())
        while True:
            doc, query = np.nonzero(bounds >= self.threshold[lo:lo + n])
            if not len(doc):
                return
            order = np.lexsort((-bounds[doc, query], query))
            doc, query = doc[order], query[order]
            place = runs(np.bincount(query, minlength=n))
            doc, query = doc[place < step], query[place < step]
            self.keep(query + lo, self.exact(doc, query + lo, keys, impact), ids[doc])
            bounds[doc, query] = -1
            step *= 4

    def exact(self, doc: np.ndarray, query: np.ndarray, keys: np.ndarray, impact: np.ndarray) -> np.ndarray:
        lot = self.lot
        out = np.zeros(len(doc), np.int64)
        if not len(keys):
            return out
        at = max(1, (1 << 20) // int(lot.sizes.max()))
        for k in range(0, len(doc), at):  # so many pairs that their terms stay in bounds
            d, q = doc[k:k + at], query[k:k + at]
            size = lot.sizes[q]
            term = np.repeat(lot.start[q], size) + runs(size)
            wanted = np.repeat(d, size) * len(lot.vocabulary) + lot.term[term]
            found = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            part = np.where(keys[found] == wanted, impact[found] * lot.weight[term], 0)
            out[k:k + at] = np.add.reduceat(part, np.cumsum(size) - size)
        self.scored += len(doc)
        return out

    def keep(self, query: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        more = score >= self.threshold[query]
        self.query, self.score, self.doc = (np.concatenate(x) for x in (
            (self.query, query[more]), (self.score, score[more]), (self.doc, doc[more])))
        order = np.lexsort((self.doc, -self.score, self.query))
        query = self.query[order]
        n = np.bincount(query, minlength=len(self.threshold))
        best = order[runs(n) < self.top]
        self.query, self.score, self.doc = self.query[best], self.score[best], self.doc[best]
        full = np.flatnonzero(n >= self.top)
        self.threshold[full] = self.score[(np.cumsum(np.minimum(n, self.top)) - 1)[full]]

    def rows(self) -> pa.RecordBatch:
        ids = pa.array(self.lot.ids, pa.int64())
        return pa.RecordBatch.from_arrays([
            pa.array(self.lot.keys[self.query]), ids.take(pa.array(self.query)), pa.array(self.doc), pa.array(self.score)], HITS.names)


HITS = T.StructType([T.StructField("item", T.LongType()), T.StructField("item_id", T.LongType()),
                     T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())])
FOUND = T.StructType([T.StructField("term", T.LongType()), T.StructField("n", T.LongType())])


def holders(index: DataFrame, lot: Lot) -> np.ndarray:
    """Number of documents that hold each term of the lot's vocabulary."""
    vocabulary = index.sparkSession.sparkContext.broadcast(lot.vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(vocabulary.value), np.int64)
        for batch in batches:
            terms, _ = numbers(batch.column(0), "<u8")
            at = np.minimum(np.searchsorted(vocabulary.value, terms), len(n) - 1)
            n += np.bincount(at[vocabulary.value[at] == terms], minlength=len(n))
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], FOUND.names)

    df = np.zeros(len(lot.vocabulary), np.int64)
    for r in index.select("terms").mapInArrow(run, FOUND).groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[r.term] = r.n
    return df


def best(index: DataFrame, lot: Lot, n_docs: int, n_terms: int, top: int) -> DataFrame:
    """(item, item_id, doc_id, score): every task's best documents of the lot's queries."""
    shared = index.sparkSession.sparkContext.broadcast(lot)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = Search(shared.value, n_docs, n_terms, top)
        for batch in batches:
            search.add(batch)
        yield search.rows()

    return index.mapInArrow(run, HITS)


def search(index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", top: int = TOP,
           lot_terms: int = LOT_TERMS) -> DataFrame:
    """``item_col``, rank, doc_id and score of the ``top`` best documents of an index for each row of ``items``."""
    spark = index.sparkSession
    queries = build_index(items, item_col, text_col).where("n > 0").withColumnRenamed("doc_id", "item_id")
    size = F.sum(F.octet_length("terms")) / 8
    total = queries.agg(size.alias("n")).first().n or 0
    n_docs, n_terms = index.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    lots = math.ceil(total / lot_terms) if n_docs else 0
    out = spark.createDataFrame([], HITS)
    for k in range(lots):
        rows = queries.where(F.pmod(F.xxhash64("item_id", "terms"), F.lit(lots)) == k).select("item_id", "terms", "counts").collect()
        if rows:
            lot = Lot(rows, k)
            lot.weigh(holders(index, lot), n_docs)
            out = out.unionByName(best(index, lot, n_docs, n_terms, top))
    order = [F.col("score").desc(), F.col("doc_id")]
    near = Window.partitionBy("item", "tasks").orderBy(*order)
    first = out.withColumn("tasks", F.floor(F.spark_partition_id() / TASKS_MERGED)) \
        .withColumn("rank", F.row_number().over(near)).where(F.col("rank") <= top).drop("tasks", "rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select(F.col("item_id").alias(item_col), "rank", "doc_id", "score")

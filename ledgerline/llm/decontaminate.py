"""Benchmark decontamination by a BM25 index of the test items.

The items are the indexed side; every passage of every training text is a
query.  A text's passages are windows of ``STEP + PART`` words, every ``STEP``
words, so any part of an item (at most ``PART`` words) lies whole in one.

Weights are BM25 impacts divided by the item's own total, so 1 is the score of
an item against itself and one threshold holds for all.  Retrieval is
document-at-a-time pruning with block maxima, done for many passages at once:

1. per passage, terms in order of falling list length are set aside while the
   sum of their largest weights stays under a share of the threshold, so an
   item that is to reach it must get the rest from the other terms;
2. only those terms' lists are read, first as maxima of blocks of items: a
   block whose sum, with what was set aside, stays under the threshold is
   skipped;
3. items of the remaining blocks get the same bound, and what is left its full
   score.

No item above the threshold is missed.  Items of more than ``PART`` words are
indexed as parts of that length, every ``PART_STEP`` words, so a copied stretch
of ``PART`` words holds most of one.  Retrieved pairs are then verified by the
overlap of word n-grams with the item's question (its text up to the last
sentence) and answer (the last sentence), or with the whole item, or with the
part that was retrieved: a copy counts whichever sentence it lies in.

Statistics (number of parts, their mean length, parts that hold a term) are of
all items, also where the items are too many for one broadcast index and are
searched lot by lot; so scores and pairs do not depend on the lots.

Defined cases: null and empty texts have no passages; items without words are
never found; equal items are found each; repeated rows are done one by one; a
null id passes through; empty tables give an empty result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import slices
from ledgerline.llm.common import col, staged, unstage
from ledgerline.llm.textwords import alnum_table, hash_words

PART = 64            # words of an indexed part of an item, at most
PART_STEP = 16       # words from one part of a long item to the next
STEP = 128           # words from one passage to the next
THRESHOLD = 0.6      # of the item's own score
K1, B = 0.9, 0.4
ASIDE = 0.5          # share of the threshold that the terms set aside may reach; below 1, any value is right
BLOCK_ITEMS = 8      # indexed parts to a block
GRAM = 3             # words of an n-gram in verification
QUESTION_OVERLAP, ANSWER_OVERLAP, QUESTION_ALONE = 0.6, 0.5, 0.8
WHOLE_OVERLAP = 0.6  # of the whole item's n-grams, or of the part's
SLICE = 1 << 20                # characters of the texts that are searched at once
INDEX_ITEMS = 20_000           # items of one broadcast index, at most; more are searched index by index
INDEX_CHARS = 32_000_000       # and their text
WORD = re.compile("[0-9A-Za-z_\u0080-\U0010ffff]+")  # as textwords.alnum_table


def words_of(text: str | None) -> list[str]:
    return WORD.findall((text or "").lower())


def grams(words: list[str]) -> set[tuple[str, ...]]:
    n = min(GRAM, len(words))
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if n else set()


def parts_of(words: list[str]) -> list[list[str]]:
    """The parts of an item that are indexed: all of it, or stretches of ``PART`` words, the last one at its end."""
    last = max(0, len(words) - PART)
    return [words[a:a + PART] for a in [*range(0, last, PART_STEP), last]] if words else []


def share(part: list[str], words: list[str]) -> float:
    """Share of the n-grams of ``part`` among those of ``words``."""
    own, n = grams(part), min(GRAM, len(part))
    return len(own & set(zip(*(words[i:] for i in range(n))))) / len(own) if own else 1.0


class Item:
    def __init__(self, item_id, text: str):
        self.item_id, self.words = item_id, words_of(text)
        sentences = [s for s in re.split(r"(?<=[.!?])\s+", text or "") if WORD.search(s)]
        self.answer = words_of(sentences[-1]) if len(sentences) > 1 else []
        self.question = self.words[:len(self.words) - len(self.answer)]

    def overlaps(self, words: list[str]) -> tuple[float, float]:
        """Shares of the question's and the answer's n-grams among those of ``words``."""
        return share(self.question, words), share(self.answer, words)


@dataclass
class Statistics:
    """Of all items' parts: their number, mean length, and how many hold a term."""

    parts: int
    mean: float
    df: dict[str, int]


class Index:
    """Inverted lists of the parts of items, by term in order of falling list length."""

    def __init__(self, rows: list[tuple[object, str]], statistics: Statistics | None = None):
        self.items = [i for i in (Item(*r) for r in rows) if i.words]
        parts = [(k, w) for k, i in enumerate(self.items) for w in parts_of(i.words)]
        self.part_item, self.part_words = np.array([k for k, _ in parts], np.int64), [w for _, w in parts]
        counts = [Counter(w) for _, w in parts]
        own = statistics or Statistics(len(parts), sum(len(w) for _, w in parts) / max(len(parts), 1), Counter(t for c in counts for t in c))
        df, n_parts, mean = {t: own.df[t] for c in counts for t in c}, own.parts, own.mean
        self.terms = {t: i for i, (t, _) in enumerate(sorted(df.items(), key=lambda x: (-x[1], x[0])))}
        self.weights: list[dict[int, float]] = []
        for (_, words), c in zip(parts, counts):
            norm = K1 * (1 - B + B * len(words) / mean)
            w = {self.terms[t]: np.log1p((n_parts - df[t] + 0.5) / (df[t] + 0.5)) * n * (K1 + 1) / (n + norm)
                 for t, n in c.items()}
            total = sum(w.values())
            self.weights.append({t: x / total for t, x in w.items()})
        self.largest = np.zeros(len(self.terms))
        lists, maxima = defaultdict(list), defaultdict(dict)
        for p, w in enumerate(self.weights):
            for t, x in w.items():
                lists[t].append((p, x))
                b = maxima[t]
                b[p // BLOCK_ITEMS] = max(b.get(p // BLOCK_ITEMS, 0.0), x)
                self.largest[t] = max(self.largest[t], x)
        spelled = sorted(self.terms, key=self.terms.get)
        h = hash_words([t.encode() for t in spelled], alnum_table())[0]
        order = np.argsort(h)
        self.hashes, self.hash_term = h[order], order
        self.by_part = self.packed(lists)
        self.by_block = self.packed({t: list(b.items()) for t, b in maxima.items()})

    def packed(self, lists) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        ends = np.cumsum([0, *(len(lists[t]) for t in range(len(self.terms)))])
        flat = [x for t in range(len(self.terms)) for x in lists[t]]
        return ends, np.array([p for p, _ in flat], np.int64), np.array([w for _, w in flat])


    def terms_of(self, texts: list[str | None]) -> list[np.ndarray]:
        """Term numbers of each text's words, -1 for words that no item has."""
        h, n = hash_words([(t or "").lower().encode("utf-8", "surrogatepass") for t in texts], alnum_table())
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        term = np.where(self.hashes[at] == h, self.hash_term[at], -1) if len(self.hashes) else np.full(len(h), -1)
        return np.split(term, np.cumsum(n)[:-1])


def sums(lists, passage: np.ndarray, term: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted keys ``passage * width + target`` of the terms' lists, and the weights' sums."""
    ends, targets, weights = lists
    n = ends[term + 1] - ends[term]
    at = np.repeat(ends[term] - np.cumsum(n) + n, n) + np.arange(n.sum())
    key = np.repeat(passage, n) * width + targets[at]
    order = np.argsort(key, kind="stable")
    key, w = key[order], weights[at][order]
    first = np.flatnonzero(np.diff(key, prepend=-1))
    return key[first], np.add.reduceat(w, first) if len(first) else w


def retrieve(index: Index, docs: list[np.ndarray], threshold: float = THRESHOLD) -> list[tuple[int, int, int, float]]:
    """(text, passage, part, score) for every passage and part that reach the threshold.

    ``docs`` has the term numbers of each text's words, -1 for words that no item has.
    """
    counts = [max(1, -(-len(d) // STEP)) for d in docs]
    base = np.cumsum([0, *counts])
    v = len(index.terms)
    keys = []
    for k, d in enumerate(docs):
        pos = np.flatnonzero(d >= 0)
        if len(pos):
            own, t = base[k] + pos // STEP, d[pos]
            keys.append(own * v + t)
            tail = (pos % STEP < PART) & (pos >= STEP)  # the end of the passage before
            keys.append((own[tail] - 1) * v + t[tail])
    if not keys:
        return []
    key = np.unique(np.concatenate(keys))
    passage, term = key // v, key % v
    w = index.largest[term]
    total = np.cumsum(w)
    first = np.flatnonzero(np.diff(passage, prepend=-1))
    before = np.repeat(total[first] - w[first], np.diff(np.append(first, len(key))))
    aside = total - before < ASIDE * threshold
    left = np.zeros(base[-1])
    np.add.at(left, passage[aside], w[aside])
    rare_p, rare_t = passage[~aside], term[~aside]
    if not len(rare_p):
        return []
    blocks = len(index.part_item) // BLOCK_ITEMS + 1
    bkey, bsum = sums(index.by_block, rare_p, rare_t, blocks)
    live = bkey[bsum + left[bkey // blocks] >= threshold - 1e-9]
    if not len(live):
        return []
    in_play = np.isin(rare_p, np.unique(live // blocks))
    pkey, psum = sums(index.by_part, rare_p[in_play], rare_t[in_play], len(index.part_item))
    p, part = pkey // len(index.part_item), pkey % len(index.part_item)
    ok = (psum + left[p] >= threshold - 1e-9) & np.isin(p * blocks + part // BLOCK_ITEMS, live)
    out = []
    for at, part in zip(p[ok].tolist(), part[ok].tolist()):
        lo, hi = np.searchsorted(passage, [at, at + 1])
        own = index.weights[part]
        score = sum(own.get(t, 0.0) for t in term[lo:hi].tolist())
        if score >= threshold - 1e-9:
            k = int(np.searchsorted(base, at, side="right")) - 1
            out.append((k, int(at - base[k]), part, score))
    return out


def search(index: Index, texts: list[str | None]) -> dict[tuple[int, int], tuple[float, float, float]]:
    """Verified pairs (text, item) with their best score and overlaps."""
    if not texts or not index.items:
        return {}
    found: dict[tuple[int, int], tuple[float, float, float]] = {}
    words: dict[int, list[str]] = {}
    for k, passage, part, score in retrieve(index, index.terms_of(texts)):
        if k not in words:
            words[k] = words_of(texts[k])
        item_no = int(index.part_item[part])
        item = index.items[item_no]
        lo = passage * STEP - len(item.words)
        near = words[k][max(0, lo):passage * STEP + STEP + PART + len(item.words)]
        question, answer = item.overlaps(near)
        if question >= QUESTION_OVERLAP and (answer >= ANSWER_OVERLAP or question >= QUESTION_ALONE) \
                or share(item.words, near) >= WHOLE_OVERLAP or share(index.part_words[part], near) >= WHOLE_OVERLAP:
            old = found.get((k, item_no))
            if old is None or score > old[0]:
                found[k, item_no] = (score, question, answer)
    return found


PART_TERMS = T.StructType([T.StructField("lot", T.IntegerType()), T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])


def part_terms(lots: DataFrame) -> DataFrame:
    """Terms of all items' parts and the number of parts that hold them, by lot; the null term counts parts, and the empty
    one their words."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: Counter = Counter()
            for lot, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for words in parts_of(words_of(text)):
                    found.update((lot, t) for t in {*words, None})
                    found[lot, ""] += len(words)
            cols = list(zip(*((lot, t, n) for (lot, t), n in found.items()))) or [[]] * 3
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, (pa.int32(), pa.string(), pa.int64()))], PART_TERMS.names)

    return lots.select("lot", "text").mapInArrow(run, PART_TERMS).groupBy("lot", "term").agg(F.sum("n").alias("n"))


def indexes(items: DataFrame, id_col: str, text_col: str) -> Iterator[Index]:
    """Indexes of about ``INDEX_ITEMS`` items and ``INDEX_CHARS`` characters, built from collected rows of that size and
    the statistics of all items; of these, those of a lot's terms reach the driver."""
    src = items.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    n, chars = src.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.length("text")), F.lit(0))).first()
    lots = max(1, -(-n // INDEX_ITEMS), -(-chars // INDEX_CHARS))
    placed = src.withColumn("lot", F.pmod(F.xxhash64("id", "text"), F.lit(lots)).cast("int"))
    order = lambda r: (r.id is not None, r.id)
    if lots == 1:
        yield Index([(r.id, r.text) for r in sorted(src.collect(), key=order)])
        return
    terms, path = staged(part_terms(placed), "item-terms")
    totals = terms.where("term is null or term = ''").groupBy("term").agg(F.sum("n").alias("n"))
    total = {r.term: r.n for r in totals.collect()}
    df = terms.where("term <> ''").groupBy("term").agg(F.sum("n").alias("n"))
    for k in range(lots):
        own = terms.where(F.col("lot") == k).select("term")
        known = {r.term: r.n for r in df.join(own, "term", "left_semi").collect()}
        statistics = Statistics(total.get(None, 0), total.get("", 0) / max(total.get(None, 0), 1), known)
        yield Index([(r.id, r.text) for r in sorted(placed.where(F.col("lot") == k).select("id", "text").collect(), key=order)], statistics)
    unstage(items.sparkSession, path)


def contaminated_pairs(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                       item_id_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(``id_col``, ``item_id_col``, score, question_overlap, answer_overlap) of every text that holds a test item."""
    spark = docs.sparkSession
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    schema = T.StructType([
        T.StructField(id_col, src.schema["id"].dataType), T.StructField(item_id_col, items.schema[item_id_col].dataType),
        T.StructField("score", T.DoubleType()), T.StructField("question_overlap", T.DoubleType()),
        T.StructField("answer_overlap", T.DoubleType())])
    names = schema.names
    out = None
    for index in indexes(items, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = shared.value
            for batch in batches:
                ids = batch.column(0)
                for at, rows in slices(batch.column(1), SLICE):
                    found = search(index, rows)
                    if found:
                        yield pa.RecordBatch.from_arrays([
                            ids.take(pa.array([at + k for k, _ in found])),
                            pa.array([index.items[i].item_id for _, i in found]),
                            *(pa.array(x, pa.float64()) for x in zip(*found.values()))], names)
        part = src.mapInArrow(run, schema)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id_col: str = "item_id",
                  item_text_col: str = "text") -> DataFrame:
    """Rows of ``docs``, with their own columns, that hold no test item: the same search, done as a filter so that
    nothing is joined back."""
    spark = docs.sparkSession
    place = docs.columns.index(text_col)
    out = docs
    for index in indexes(items, item_id_col, item_text_col):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at, rows in slices(batch.column(place), SLICE):
                    hit = {k for k, _ in search(shared.value, rows)}
                    yield batch.take(pa.array([at + k for k in range(len(rows)) if k not in hit], pa.int64()))
        out = out.mapInArrow(run, out.schema)
    return out

"""Removal of long repeated byte strings, by merging sorted suffixes with interleave refinement.

The suffix order is sparse: of every ``LENGTH``-byte string one anchor, the
least 32-bit hash of its ``GRAM``-byte strings (the first of equal ones), is
kept, so equal strings have their anchors at equal places, whatever other texts
a task looks at with them.  An anchor stands for a run of
windows and for the text these cover, its context.

1. Every task gives the anchors of its texts.  Anchors whose whole context
   occurs twice are repeated in full; these are told equal by a 64-bit hash of
   the context and one of the gram, not by their bytes.
2. What is left, and only where an anchor's gram meets different contexts, is
   compared byte by byte: the contexts that shards of the input bring to a bucket
   are merged by refining their interleave.  It starts as the order by gram;
   each step reads the next 8 bytes of those suffixes that are not told apart
   yet and reorders within their blocks, so a step sorts no suffix that is
   settled.  The step at which neighbours part gives their common prefix.  The
   same is done for the reversed texts before the anchors.
3. Windows at the same place before an anchor are equal when both sides agree
   far enough: the two orders cut by common prefix give repeated intervals.

A gram with more than ``GROUP_LIMIT`` contexts is not brought together: its
windows are counted by 64-bit hash, pre-aggregated, and joined back.

Matches never cross texts; strings are judged on the input.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose nothing;
repeated rows are texts of their own, so they repeat each other; null ids pass
through; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import slices
from ledgerline.llm.common import col, staged, unstage
from ledgerline.llm.textwords import mix, powers

LENGTH = 400
GRAM = 32
GROUP_LIMIT = 20_000
PLACE_BITS = 32  # an Arrow batch of texts holds at most 2 GB
SLICE = 1 << 20  # bytes that a task looks at together, or one longer text


def running(data: np.ndarray) -> np.ndarray:
    """Sums of byte * base**place before each place."""
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data) + 1)[0][:len(data)], out=total[1:])
    return total


def string_hashes(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    return mix((total[end] - total[start]) * powers(len(total))[1][start] + (end - start).astype(np.uint64))


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each run of ``width`` values."""
    n = len(x) - width + 1
    pad = -len(x) % width
    blocks = np.concatenate([x, np.full(pad, x.max(), x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[:n], ahead[width - 1:width - 1 + n])


def anchors(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, gram hash, context hash, place, first and last window start) of every anchor, places within the text."""
    data = np.frombuffer(b"".join(texts), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    ends = np.cumsum(sizes)
    begin = ends - sizes
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none, none
    total = running(data)
    at = np.arange(len(data) - gram + 1)
    h = string_hashes(total, at, at + gram)
    # hash above, place below: the first of equal hashes is the least
    bits = np.uint64(PLACE_BITS)
    packed = (h >> bits) << bits | at.astype(np.uint64)
    least = sliding_least(packed, length - gram + 1)
    text_of = np.repeat(np.arange(len(texts)), sizes)[:len(least)]
    window = np.arange(len(least))
    ok = window + length <= ends[text_of]
    window, text_of = window[ok], text_of[ok]
    if not len(window):
        return none, none, none, none, none, none
    place = (least[window] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (text_of[1:] != text_of[:-1])]))
    lo, hi, place, text_of = window[first], window[np.append(first[1:], len(window)) - 1], place[first], text_of[first]
    context = mix(string_hashes(total, lo, hi + length) + (place - lo).astype(np.uint64))
    base = begin[text_of]
    return text_of, h[place].view(np.int64), context.view(np.int64), place - base, lo - base, hi - base


def lots(texts: list[str | None], limit: int = SLICE) -> Iterator[tuple[int, list[bytes]]]:
    """Runs of texts of about ``limit`` bytes, as UTF-8, with the number of the first."""
    out, size, at = [], 0, 0
    for k, t in enumerate(texts):
        out.append((t or "").encode("utf-8", "surrogatepass"))
        size += len(out[-1])
        if size >= limit:
            yield at, out
            out, size, at = [], 0, k + 1
    if out:
        yield at, out


ANCHOR = T.StructType([T.StructField(c, T.LongType()) for c in ("gram", "context", "text_key", "place", "lo", "hi")])
CUT = T.StructType([*ANCHOR.fields, T.StructField("copies", T.LongType()), T.StructField("before", T.BinaryType()),
                    T.StructField("after", T.BinaryType())])
INTERVAL = T.StructType([T.StructField(c, T.LongType()) for c in ("text_key", "s", "e")])


def all_anchors(src: DataFrame, length: int, gram: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(batch.column(0))
            for at, rows in slices(batch.column(1), SLICE):
                for more, texts in lots(rows):
                    text, g, c, place, lo, hi = anchors(texts, length, gram)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(x, pa.int64()) for x in (g, c, keys[at + more + text], place, lo, hi)], ANCHOR.names)
    return src.mapInArrow(run, ANCHOR)


def cut_contexts(wanted: DataFrame, src: DataFrame, length: int) -> DataFrame:
    """Rows of ``wanted`` with the bytes before and from their anchor, cut from the texts of ``src``."""
    per_text = wanted.groupBy("text_key").agg(F.collect_list(F.struct("gram", "context", "place", "lo", "hi", "copies")).alias("w"))
    one = src.dropDuplicates(["text_key"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for key, text, w in zip(*(c.to_pylist() for c in batch.columns)):
                data = (text or "").encode("utf-8", "surrogatepass")
                for a in range(0, len(w), 4096):
                    rows = [(x["gram"], x["context"], key, x["place"], x["lo"], x["hi"], x["copies"],
                             data[x["lo"]:x["place"]], data[x["place"]:x["hi"] + length]) for x in w[a:a + 4096]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.binary() if n in ("before", "after") else pa.int64()) for n, c in zip(CUT.names, zip(*rows))], CUT.names)

    return one.join(per_text, "text_key").select("text_key", "text", "w").mapInArrow(run, CUT)


def matrix(strings: list[bytes], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Strings as rows of big-endian 64-bit symbols, padded, and their lengths."""
    width += -width % 8
    data = np.frombuffer(b"".join(s.ljust(width, b"\0") for s in strings), ">u8").reshape(len(strings), -1)
    return data.astype(np.uint64), np.fromiter(map(len, strings), np.int64, len(strings))


def refined_order(group: np.ndarray, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Order of strings within their groups, and each one's common prefix, in bytes, with the string before it.

    The interleave of the groups' strings is refined symbol by symbol.  Only
    blocks of strings that agree so far take part in a step; stable sorting
    keeps shorter strings before those that they are a prefix of.
    """
    n, steps = symbols.shape
    order = np.lexsort((lengths, group))
    common = np.full(n, 8 * steps)
    new_block = np.concatenate([[True], group[order][1:] != group[order][:-1]])
    common[new_block] = -1
    for j in range(steps):
        block = np.cumsum(new_block)
        live = np.flatnonzero(np.bincount(block)[block] > 1)
        if not len(live):
            break
        sym = symbols[order[live], j]
        by = np.lexsort((sym, block[live]))  # stable
        order[live] = order[live][by]
        sym = sym[by]
        differ = np.concatenate([[False], (sym[1:] != sym[:-1]) & (block[live][1:] == block[live][:-1])])
        x = sym[np.flatnonzero(differ)] ^ sym[np.flatnonzero(differ) - 1]
        equal_bytes = np.zeros(len(x), np.int64)
        for b in range(1, 8):
            equal_bytes += x >> np.uint64(64 - 8 * b) == 0
        common[live[differ]] = 8 * j + equal_bytes
        new_block[live[differ]] = True
    pair = np.minimum(lengths[order], np.concatenate([[0], lengths[order][:-1]]))
    return order, np.where(common < 0, -1, np.minimum(common, pair))


def classes_at(order: np.ndarray, common: np.ndarray, depth: int) -> np.ndarray:
    """Number of the class of each string: equal numbers share their first ``depth`` bytes."""
    out = np.empty(len(order), np.int64)
    out[order] = np.cumsum(common < depth)
    return out


def repeated_intervals(rows: dict[str, list], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text_key, s, e): stretches whose every window occurs elsewhere, for contexts that occur once as a whole."""
    g = np.array(rows["gram"], np.int64)
    keys, place, lo, hi, copies = (np.array(rows[c], np.int64) for c in ("text_key", "place", "lo", "hi", "copies"))
    after, after_n = matrix(rows["after"], length)
    before, before_n = matrix([b[::-1] for b in rows["before"]], length - gram)
    right, left = refined_order(g, after, after_n), refined_order(g, before, before_n)
    n, widest = len(g), length - gram
    covered = np.zeros((n, widest + 3), bool)  # by bytes of the window before the anchor, one empty column at each end
    for o in range(widest + 1):
        here = np.flatnonzero((place - o >= lo) & (place - o <= hi))
        if len(here) < 2:
            continue
        key = classes_at(*left, o)[here] * (n + 1) + classes_at(*right, length - o)[here]
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        twice = np.concatenate([[False], same]) | np.concatenate([same, [False]])
        covered[here[by[twice]], o + 1] = True
    covered[copies > 1] = False  # known to be repeated as a whole
    edge = np.diff(covered.astype(np.int8), axis=1)
    row, first = np.nonzero(edge == 1)
    _, last = np.nonzero(edge == -1)
    return keys[row], place[row] - (last - 1), place[row] - first + length


def by_refinement(cut: DataFrame, length: int, gram: int, buckets: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches([b.select(CUT.names) for b in batches])
        out = repeated_intervals(table.to_pydict(), length, gram)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], INTERVAL.names)
    return cut.withColumn("bucket", F.pmod(F.xxhash64("gram"), F.lit(buckets))).groupBy("bucket").applyInArrow(run, INTERVAL)


def by_counting(cut: DataFrame, length: int) -> DataFrame:
    """The same intervals for grams with very many contexts: windows counted by hash."""
    window = T.StructType([T.StructField(c, T.LongType()) for c in ("window", "text_key", "s", "copies")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                data = np.frombuffer(r["before"] + r["after"], np.uint8)
                at = np.arange(len(data) - length + 1)
                h = string_hashes(running(data), at, at + length).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(np.full(len(h), r["text_key"])), pa.array(r["lo"] + at),
                                                  pa.array(np.full(len(h), r["copies"]))], window.names)

    rows, path = staged(cut.mapInArrow(run, window), "windows")
    often = rows.groupBy("window").agg(F.sum("copies").alias("n")).where("n > 1").select("window")
    return rows.where("copies = 1").join(often, "window").select("text_key", "s", (F.col("s") + length).alias("e"))


def removed(data: bytes, cuts: list[tuple[int, int]]) -> tuple[int, int, bytes]:
    """(bytes removed, maximal runs, bytes kept) for overlapping intervals."""
    spans: list[list[int]] = []
    for s, e in sorted(cuts):
        if spans and s <= spans[-1][1]:
            spans[-1][1] = max(e, spans[-1][1])
        else:
            spans.append([s, e])
    kept, at = [], 0
    for s, e in spans:
        kept.append(data[at:s])
        at = e
    kept.append(data[at:])
    return sum(e - s for s, e in spans), len(spans), b"".join(kept)


def dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, gram: int = GRAM,
          group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Per text: ``id_col``, ``n_bytes``, ``n_removed``, ``n_spans`` and ``kept`` (the bytes that stay)."""
    spark = docs.sparkSession
    src = docs.select(col(id_col).alias("id"), col(text_col).cast("string").alias("text"))
    src = src.withColumn("text_key", F.xxhash64("id", "text"))
    every, every_path = staged(all_anchors(src.select("text_key", "text"), length, gram), "anchors")
    contexts = every.groupBy("gram", "context").agg(F.count(F.lit(1)).alias("copies"),
                                                    F.min(F.struct("text_key", "place", "lo", "hi")).alias("at"))
    contexts, contexts_path = staged(contexts.select("gram", "context", "copies", "at.*"), "contexts")
    whole = every.join(contexts.where("copies > 1").select("gram", "context"), ["gram", "context"]) \
        .select("text_key", F.col("lo").alias("s"), (F.col("hi") + length).alias("e"))
    mixed = contexts.groupBy("gram").agg(F.count(F.lit(1)).alias("n"), F.max(F.when(F.col("copies") == 1, 1)).alias("open")) \
        .where("n > 1 and open = 1").select("gram", "n")
    cut = cut_contexts(contexts.join(mixed, "gram").select(*ANCHOR.names, "copies"), src.select("text_key", "text"), length)
    cut, cut_path = staged(cut, "cut-contexts")
    buckets = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    hot = mixed.where(F.col("n") > group_limit).select("gram")
    found = whole.unionByName(by_refinement(cut.join(hot, "gram", "left_anti"), length, gram, buckets))
    if not hot.isEmpty():
        found = found.unionByName(by_counting(cut.join(hot, "gram", "left_semi"), length))
    per_text, _ = staged(found.groupBy("text_key").agg(F.collect_set(F.struct("s", "e")).alias("cuts")), "intervals")
    unstage(spark, every_path, contexts_path, cut_path)
    out = T.StructType([T.StructField(id_col, src.schema["id"].dataType), T.StructField("n_bytes", T.LongType()),
                        T.StructField("n_removed", T.LongType()), T.StructField("n_spans", T.LongType()),
                        T.StructField("kept", T.BinaryType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cuts = batch.column(2)
            for at, rows in slices(batch.column(1)):
                texts = [(t or "").encode("utf-8", "surrogatepass") for t in rows]
                own = cuts.slice(at, len(rows)).to_pylist()
                done = [removed(t, [(c["s"], c["e"]) for c in x or ()]) for t, x in zip(texts, own)]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(at, len(rows)), pa.array(map(len, texts), pa.int64()),
                    pa.array([d[0] for d in done], pa.int64()), pa.array([d[1] for d in done], pa.int64()),
                    pa.array([d[2] for d in done], pa.binary())], out.names)

    return src.join(per_text, "text_key", "left").select("id", "text", "cuts").mapInArrow(run, out)

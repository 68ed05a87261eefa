"""N-gram Jaccard join by vertical partitioning.

Texts become sets of word shingles; texts of equal sets are one class, and
classes whose sets have a Jaccard similarity of at least ``LEAST`` / 100 are
linked.  N-grams have one global order, by the number of classes that have
them, then by value.  It is cut two ways:

- *counting*: ranges of values are buckets, and a few neighbouring ones a load,
  so a class's set travels as one segment per load, and each bucket of it counts
  its n-grams on its own.  Only
  n-grams of two classes or more go on: a class that cannot reach the
  similarity with those alone is done.
- *joining*: of each class only the first n-grams in the global order (those
  that a similar class cannot all lack) look for partners.  For every candidate
  pair, the overlap of each fragment of the order is counted separately and
  summed per pair.

Groups of many similar classes are not expanded into all pairs.  Members are
first compared to one leader, and links are closed into components.  Then only
n-grams whose classes are still apart count; the classes outside the largest
component of such a group are compared with all of the group, in blocks of
bounded size that give links, not pairs.  Every pair that shares such an n-gram
is then linked, connected or refuted, so the components are exact.

Very frequent n-grams are found before anything is shuffled, by task, and
pre-aggregated; at most ``HOT_LIMIT`` of them can reach the threshold that is
used, and their list is broadcast.  They stand last in the order and travel with
their class, not to a bucket.

Sets are compared by 64-bit hashes of n-grams and of whole sets; two unequal
sets of equal hash are detected and raise an error.

Defined cases: null and empty texts have an empty set and link with nothing;
texts with fewer words than a shingle have one shingle of all words; repeated
rows are copies; a null id counts as a member but never names a component; an
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
from ledgerline.llm.common import col, staged, unstage
from ledgerline.llm.components import components
from ledgerline.llm.textwords import hash_words, mix, runs, space_table

SHINGLE = 5
LEAST = 75                 # similarity in hundredths
FRAGMENTS = 8              # parts of the order whose overlaps are counted separately
FLUSH = 1 << 20            # n-grams that a task cuts into bucket segments at once
HOT_SHARE = 0.02           # share of a task's classes from which an n-gram counts as frequent there
HOT_LIMIT = 1_000_000
BLOCK_GRAMS = 1 << 18      # n-grams of the queries that a task of the last comparison holds
PART_GRAMS = 1 << 20       # and of the classes that they meet there
LOW_BITS = 48              # bits of an n-gram's hash that travel to its bucket
BUCKET_GRAMS = 1 << 20     # n-grams of a bucket, on average; buckets are powers of two in number
TOGETHER = 4               # neighbouring buckets that travel as one load, at most; they are counted one after another
HITS = 1 << 21             # places where n-grams of two sides of a block agree that are expanded at once
CELLS = 1 << 20            # pairs of a block whose overlaps are counted at once
HOT_DF = np.uint32(2**32 - 1)


def shingle_sets(texts: list[str | None], words: int = SHINGLE) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text."""
    h, n = hash_words([(t or "").encode("utf-8", "surrogatepass") for t in texts], space_table(lower=True))
    padded = np.concatenate([h, np.zeros(words, np.uint64)])
    place = runs(n)
    left = np.repeat(n, n) - place  # words from here to the text's end
    total = np.zeros(len(h), np.uint64)
    for k in range(words):
        part = mix(padded[k:len(h) + k] + np.uint64(0xD1B54A32D192ED03 * (k + 1) % 2**64))
        total += np.where(left > k, part, np.uint64(0))
    keep = (left >= words) | (place == 0)
    grams = mix(total + np.minimum(left, words).astype(np.uint64))
    ends = np.cumsum(n)
    return [np.unique(grams[e - k:e][keep[e - k:e]]) for e, k in zip(ends.tolist(), n.tolist())]


def fingerprints(grams: np.ndarray) -> tuple[int, int]:
    """Two 64-bit hashes of a set, as signed integers."""
    size = np.uint64(len(grams))
    a = mix(np.array([mix(grams).sum(dtype=np.uint64) + size]))
    b = mix(np.array([mix(grams ^ np.uint64(0xA0761D6478BD642F)).sum(dtype=np.uint64) ^ size]))
    return int(a.view(np.int64)[0]), int(b.view(np.int64)[0])


class Sets:
    """Distinct sets gathered by a task until they are handed on."""

    def __init__(self):
        self.clear()

    def clear(self):
        self.keys: dict[int, int] = {}
        self.parts: list[np.ndarray] = []
        self.size = 0

    def add(self, key: int, grams: np.ndarray) -> None:
        if key not in self.keys:
            self.keys[key] = len(self.parts)
            self.parts.append(grams)
            self.size += len(grams)

    def frequent(self) -> tuple[np.ndarray, np.ndarray]:
        """N-grams, and their counts, that a share of the gathered sets has."""
        least = max(8, HOT_SHARE * len(self.parts))
        if len(self.parts) < least:
            return np.zeros(0, np.uint64), np.zeros(0, np.int64)
        grams = np.sort(np.concatenate(self.parts))
        first = np.flatnonzero(np.concatenate([[True], grams[1:] != grams[:-1]]))
        n = np.diff(np.append(first, len(grams)))
        return grams[first][n >= least], n[n >= least]


PROFILE = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("mark_a", T.LongType()),
                        T.StructField("mark_b", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("cls", T.LongType()), T.StructField("second", T.LongType()),
                        T.StructField("gram", T.LongType())])


def profile(src: DataFrame, words: int) -> DataFrame:
    """Rows of texts (doc_id, marks, n, cls, second) and of frequent n-grams (gram, with the count in n)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered = Sets()

        def hot() -> pa.RecordBatch:
            grams, n = gathered.frequent()
            gathered.clear()
            none = pa.nulls(len(n), pa.int64())
            return pa.RecordBatch.from_arrays([none, none, none, pa.array(n, pa.int64()), none, none, pa.array(grams.view(np.int64))], PROFILE.names)

        for batch in batches:
            for at, rows in slices(batch.column(1), 1 << 20):
                out = []
                for grams in shingle_sets(rows, words):
                    a, b = fingerprints(grams) if len(grams) else (None, None)
                    out.append((len(grams), a, b))
                    if len(grams):
                        gathered.add(a, grams)
                n, a, b = zip(*out)
                yield pa.RecordBatch.from_arrays([
                    *(batch.column(c).slice(at, len(rows)) for c in (0, 2, 3)), pa.array(n, pa.int64()), pa.array(a, pa.int64()),
                    pa.array(b, pa.int64()), pa.nulls(len(n), pa.int64())], PROFILE.names)
                if gathered.size >= FLUSH:
                    yield hot()
        yield hot()

    marks = [F.col(c) if c in src.columns else F.lit(None).cast("bigint").alias(c) for c in ("mark_a", "mark_b")]
    return src.select("doc_id", "text", *marks).mapInArrow(run, PROFILE)


SEGMENT = T.StructType([T.StructField("load", T.IntegerType()), T.StructField("keys", T.BinaryType()),
                        T.StructField("sizes", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                        T.StructField("low", T.BinaryType()), T.StructField("high", T.BinaryType()),
                        T.StructField("place", T.BinaryType())])


def narrow(values: np.ndarray) -> bytes:
    """Numbers from 0 to 2**32 - 1, in the least bytes each that hold the largest."""
    top = int(values.max()) if len(values) else 0
    return values.astype("<u1" if top < 1 << 8 else "<u2" if top < 1 << 16 else "<u4").tobytes()


def widened(data: bytes, n: int) -> np.ndarray:
    """The ``n`` numbers that :func:`narrow` has packed."""
    return np.frombuffer(data, f"<u{len(data) // n}" if n else "<u1")


def quarters(values: np.ndarray) -> bytes:
    """Numbers from 0 to 3, four to a byte."""
    four = np.concatenate([values, np.zeros(-len(values) % 4, values.dtype)]).astype(np.uint8).reshape(-1, 4)
    return (four << np.array([0, 2, 4, 6], np.uint8)).sum(axis=1, dtype=np.uint8).tobytes()


def from_quarters(data: bytes, n: int) -> np.ndarray:
    four = np.frombuffer(data, np.uint8)[:, None] >> np.array([0, 2, 4, 6], np.uint8) & np.uint8(3)
    return four.ravel()[:n]


def segments(src: DataFrame, words: int, hot: np.ndarray, buckets: int) -> DataFrame:
    """Each task's sets, cut into segments of a load: class keys, set sizes and numbers of n-grams, and per n-gram its
    low bits and the place of its bucket in the load.

    A class's key stands once in a segment, so buckets that travel together
    share it.  Frequent n-grams go to the class's own bucket, which travels
    alone; these are numbered from -1 down.
    """
    together = min(TOGETHER, buckets)
    shared = src.sparkSession.sparkContext.broadcast(np.sort(hot))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, gathered = shared.value, Sets()

        def rows() -> Iterator[pa.RecordBatch]:
            if not gathered.parts:
                return
            keys = np.fromiter(gathered.keys, np.int64, len(gathered.keys))
            sizes = np.fromiter(map(len, gathered.parts), np.int64, len(gathered.parts))
            grams, owner = np.concatenate(gathered.parts), np.repeat(np.arange(len(keys)), sizes)
            gathered.clear()
            bucket = leading(grams, buckets)
            load, place = bucket // together, bucket % together
            if len(frequent):
                at = np.minimum(np.searchsorted(frequent, grams), len(frequent) - 1)
                is_hot = frequent[at] == grams
                load[is_hot] = -1 - class_bucket(keys[owner[is_hot]], buckets)
            order = np.argsort(load, kind="stable")
            load, grams, owner, place = load[order], grams[order], owner[order], place[order]
            first = np.flatnonzero(np.diff(load, prepend=load[0] - 1))
            for a, b in zip(first.tolist(), [*first[1:].tolist(), len(load)]):
                used, n = np.unique(owner[a:b], return_counts=True)  # a class's n-grams stand together
                g = grams[a:b]
                yield pa.RecordBatch.from_arrays([
                    pa.array([load[a]], pa.int32()), pa.array([keys[used].tobytes()]), pa.array([narrow(sizes[used])]),
                    pa.array([narrow(n)]), pa.array([(g & np.uint64(0xFFFFFFFF)).astype("<u4").tobytes()]),
                    pa.array([(g >> np.uint64(32)).astype("<u2" if load[a] >= 0 else "<u4").tobytes()]),
                    pa.array([quarters(place[a:b])])], SEGMENT.names)

        for batch in batches:
            for _, texts in slices(batch.column(1), 1 << 20):
                for grams in shingle_sets(texts, words):
                    if len(grams):
                        gathered.add(fingerprints(grams)[0], grams)
                if gathered.size >= FLUSH:
                    yield from rows()
        yield from rows()

    return src.mapInArrow(run, SEGMENT)


def leading(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket of each hash: its leading bits, of a power of two of buckets."""
    bits = buckets.bit_length() - 1
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)


def class_bucket(keys: np.ndarray, buckets: int) -> np.ndarray:
    return leading(keys.view(np.uint64), buckets)


def bucket_count(grams: int) -> int:
    """Buckets for so many n-grams in all: a fixed number of them in each, however many there are."""
    return 1 << min(30, max(0, (max(1, grams) - 1) // BUCKET_GRAMS).bit_length())


SHARED = T.StructType([T.StructField("part", T.IntegerType()), T.StructField("keys", T.BinaryType()),
                       T.StructField("sizes", T.BinaryType()), T.StructField("counts", T.BinaryType()),
                       T.StructField("grams", T.BinaryType()), T.StructField("df", T.BinaryType())])


def unpack(segment: dict, bucket: int, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(class keys, set sizes, n-grams) of a segment, one entry per n-gram.  An n-gram's low bits and its bucket identify it;
    with 16 bits of buckets or more, that is the whole hash."""
    keys, sizes = np.frombuffer(segment["keys"], "<i8"), np.frombuffer(segment["sizes"], "<i4")
    low = np.frombuffer(segment["low"], "<u4").astype(np.uint64)
    high = np.frombuffer(segment["high"], "<u2" if bucket >= 0 else "<u4").astype(np.uint64)
    owner = np.frombuffer(segment["owner"], "<u4" if len(keys) > 65536 else "<u2")
    bits = buckets.bit_length() - 1
    own_bucket = np.uint64(bucket) if bucket >= 0 else (high << np.uint64(32)) >> np.uint64(64 - bits) if bits else np.uint64(0)
    low_bits = min(LOW_BITS, 64 - bits)
    low = ((high & np.uint64(0xFFFF)) << np.uint64(32) | low) & np.uint64(2**low_bits - 1)
    grams = own_bucket << np.uint64(low_bits) | low
    return keys[owner], sizes[owner], grams


def bucket_segment(row: dict, place: int) -> dict:
    """The segment of one bucket of a load's row, or of a class's own bucket."""
    alone = row["load"] < 0
    n = len(row["keys"]) // 8
    owner = np.repeat(np.arange(n), widened(row["counts"], n))
    low, high = np.frombuffer(row["low"], "<u4"), np.frombuffer(row["high"], "<u4" if alone else "<u2")
    if not alone:
        at = np.flatnonzero(from_quarters(row["place"], len(low)) == place)
        low, high, owner = low[at], high[at], owner[at]
    return {"keys": row["keys"], "sizes": widened(row["sizes"], n).astype("<i4"), "low": low, "high": high,
            "owner": owner.astype("<u4" if n > 65536 else "<u2")}


def counted_bucket(load_rows: list[dict], place: int, buckets: int) -> tuple[np.ndarray, ...]:
    """(class keys, set sizes, n-grams, number of classes) of one bucket's n-grams of two classes or more."""
    load = load_rows[0]["load"]
    bucket = load * min(TOGETHER, buckets) + place if load >= 0 else load
    keys, sizes, grams = (np.concatenate(x) for x in zip(*(unpack(bucket_segment(r, place), bucket, buckets) for r in load_rows)))
    order = np.lexsort((keys, grams))
    keys, sizes, grams = keys[order], sizes[order], grams[order]
    once = np.ones(len(grams), bool)
    once[1:] = (grams[1:] != grams[:-1]) | (keys[1:] != keys[:-1])
    keys, sizes, grams = keys[once], sizes[once], grams[once]
    if load < 0:
        return keys, sizes, grams, np.full(len(grams), HOT_DF, np.uint32)
    new = np.ones(len(grams), bool)
    new[1:] = grams[1:] != grams[:-1]
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(grams)))
    df = np.repeat(n, n).astype(np.uint32)
    keep = df > 1
    return keys[keep], sizes[keep], grams[keep], df[keep]


def count_load(load_rows: list[dict], buckets: int) -> Iterator[tuple]:
    """Of the buckets of one load: n-grams of two classes or more with their number, by the bucket of the class.

    One bucket is unpacked and counted at a time; what is shared is handed on
    together until it is as much as a bucket."""
    held: list[tuple[np.ndarray, ...]] = []
    for place in range(min(TOGETHER, buckets) if load_rows[0]["load"] >= 0 else 1):
        held.append(counted_bucket(load_rows, place, buckets))
        if sum(len(x[0]) for x in held) >= BUCKET_GRAMS:
            yield from by_class(held, buckets)
            held = []
    if held:
        yield from by_class(held, buckets)


def by_class(held: list[tuple[np.ndarray, ...]], buckets: int) -> Iterator[tuple]:
    """Rows of ``SHARED``."""
    keys, sizes, grams, df = (np.concatenate(x) for x in zip(*held))
    order = np.argsort(keys.view(np.uint64), kind="stable")
    keys, sizes, grams, df = keys[order], sizes[order], grams[order], df[order]
    part = class_bucket(keys, buckets)
    first = np.flatnonzero(np.diff(part, prepend=-1))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(part)]):
        own = np.flatnonzero(np.concatenate([[True], keys[a + 1:b] != keys[a:b - 1]]))
        yield (int(part[a]), keys[a:b][own].tobytes(), narrow(sizes[a:b][own]),
               narrow(np.diff(np.append(own, b - a))), grams[a:b].tobytes(), narrow(df[a:b]))


CLASSES = T.StructType([T.StructField("cls", T.LongType()), T.StructField("n", T.LongType()),
                        T.StructField("fragment", T.IntegerType()), T.StructField("grams", T.ArrayType(T.LongType())),
                        T.StructField("prefix", T.ArrayType(T.LongType()))])


def class_rows(parts: list[dict], least: int) -> Iterator[tuple]:
    """Of one class bucket: per class that can still reach the similarity, its fragments, the first with the prefix."""
    keys, sizes = [], []
    for r in parts:
        own = np.frombuffer(r["keys"], "<i8")
        n = widened(r["counts"], len(own))
        keys.append(np.repeat(own, n))
        sizes.append(np.repeat(widened(r["sizes"], len(own)).astype(np.int64), n))
    keys, sizes = np.concatenate(keys), np.concatenate(sizes)
    grams = np.concatenate([np.frombuffer(r["grams"], "<u8") for r in parts])
    df = np.concatenate([widened(r["df"], len(r["grams"]) // 8).astype(np.uint32) for r in parts])
    order = np.lexsort((grams, df, keys))
    keys, sizes, grams, df = keys[order], sizes[order], grams[order], df[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    for a, b in zip(first.tolist(), [*first[1:].tolist(), len(keys)]):
        n = int(sizes[a])
        needed = -(-least * n // 100)
        if b - a < needed:
            continue
        own = grams[a:b]
        prefix = own[:b - a - needed + 1].view(np.int64)
        own = np.sort(own)
        fragment = fragment_of(own)
        for f in np.unique(fragment).tolist():
            yield int(keys[a]), n, f, own[fragment == f].view(np.int64), prefix
            prefix = None


def fragment_of(grams: np.ndarray) -> np.ndarray:
    """Fragment of the order: n-grams by a range of their low bits, which are spread evenly."""
    return (grams >> np.uint64(LOW_BITS - 16) & np.uint64(0xFFFF)).astype(np.int64) * FRAGMENTS >> 16


def by_rows(fn, schema: T.StructType, limit: int = 1 << 22):
    """A grouped Arrow function from one over row dictionaries that yields tuples; a group is one bucket."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = [{c: x.as_buffer() if pa.types.is_binary(x.type) else x.as_py() for c, x in zip(b.schema.names, values)}
                for b in batches for values in zip(*b.columns)]
        out, size = [], 0
        for row in fn(rows):
            out.append(row)
            size += sum(x.nbytes if isinstance(x, np.ndarray) else len(x) if isinstance(x, bytes) else 8 for x in row)
            if size >= limit:
                yield to_batch(out, schema)
                out, size = [], 0
        yield to_batch(out, schema)
    return run


def to_batch(rows: list[tuple], schema: T.StructType) -> pa.RecordBatch:
    kinds = {"int": pa.int32(), "bigint": pa.int64(), "binary": pa.binary(), "array<bigint>": pa.list_(pa.int64())}
    cols = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(list(c), kinds[f.dataType.simpleString()]) for c, f in zip(cols, schema)], schema.names)


def verified(pairs: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    """Of pairs (a, b), those whose similarity is reached: overlaps counted per fragment, summed per pair."""
    seg = classes.select("cls", "n", "fragment", "grams")
    left = seg.select(F.col("cls").alias("a"), F.col("n").alias("na"), "fragment", F.col("grams").alias("ga"))
    right = seg.select(F.col("cls").alias("b"), F.col("n").alias("nb"), "fragment", F.col("grams").alias("gb"))
    partial = pairs.select("a", "b").join(left, "a").join(right, ["b", "fragment"]) \
        .select("a", "b", "na", "nb", F.size(F.array_intersect("ga", "gb")).cast("bigint").alias("o"))
    both = partial.groupBy("a", "b", "na", "nb").agg(F.sum("o").alias("o"))
    return both.where(F.lit(100) * F.col("o") >= F.lit(least) * (F.col("na") + F.col("nb") - F.col("o"))).select("a", "b")


def with_components(entries: DataFrame, comp: DataFrame | None) -> DataFrame:
    if comp is None:
        return entries.withColumn("comp", F.col("cls"))
    return entries.join(comp.select(F.col("node").alias("cls"), "component"), "cls", "left") \
        .select("gram", "cls", "n", F.coalesce("component", "cls").alias("comp"))


def open_entries(entries: DataFrame) -> DataFrame:
    """Entries of the n-grams whose classes are not all connected, each with the n-gram's leader (its least class)."""
    leaders = entries.groupBy("gram").agg(
        F.min("comp").alias("low"), F.max("comp").alias("top"),
        F.min(F.struct(F.col("cls").alias("lead"), F.col("n").alias("n_lead"))).alias("l")).where("low < top")
    return entries.join(leaders.select("gram", "l.lead", "l.n_lead"), "gram")


def blocks_to_compare(entries: DataFrame) -> DataFrame:
    """(cls, comp, part of its group to be compared in, side): who meets whom in the last comparison.

    Classes that share open n-grams, also through others, are a group.  Its
    classes outside the group's largest component are the queries; they meet
    all classes of the group, in blocks of queries and parts of the group of
    bounded size.
    """
    members = entries.groupBy("cls").agg(F.min("n").alias("n"), F.min("comp").alias("comp"))
    groups = components(entries.select(F.col("cls").alias("a"), F.col("lead").alias("b")))
    members = members.join(groups.select(F.col("node").alias("cls"), F.col("component").alias("grp")), "cls")
    per_comp = members.groupBy("grp", "comp").agg(F.count(F.lit(1)).alias("c"), F.sum("n").alias("n"))
    plan = per_comp.groupBy("grp").agg(F.max(F.struct("c", "n", "comp")).alias("main"), F.sum("n").alias("n"))
    plan = plan.select("grp", F.col("main.comp").alias("main"), F.ceil((F.col("n") - F.col("main.n")) / BLOCK_GRAMS).cast("int").alias("blocks"),
                       F.ceil(F.col("n") / PART_GRAMS).cast("int").alias("parts")).where("blocks > 0")
    placed = members.join(plan, "grp")
    spread = lambda n: F.pmod(F.xxhash64("cls", "grp"), n).cast("int")
    queries = placed.where("comp <> main").select(
        "cls", "comp", "grp", spread(F.col("blocks")).alias("block"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"),
        F.lit(True).alias("query"))
    others = placed.select(
        "cls", "comp", "grp", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"), spread(F.col("parts")).alias("part"),
        F.lit(False).alias("query"))
    return queries.unionByName(others)


LINKS = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def compared_block(rows: dict[str, list], least: int) -> tuple[np.ndarray, np.ndarray]:
    """Links between components that the similar classes of one block make: overlaps of each fragment, summed per
    pair.  Of links that close a circle within the block one is left out."""
    side, cls, comp, size, fragment = (np.array(rows[c]) for c in ("query", "cls", "comp", "n", "fragment"))
    found: list[np.ndarray] = []

    def gathered(at: np.ndarray):
        keys, first, owner = np.unique(cls[at], return_index=True, return_inverse=True)
        return keys, comp[at][first], size[at][first], owner

    x_at, y_at = np.flatnonzero(side), np.flatnonzero(~side)
    x_keys, x_comp, x_n, x_owner = gathered(x_at)
    index = {}
    for f in np.unique(fragment[x_at]).tolist():
        own = np.flatnonzero(fragment[x_at] == f)
        grams = np.concatenate([rows["grams"][x_at[i]] for i in own])
        owner = np.repeat(x_owner[own], [len(rows["grams"][x_at[i]]) for i in own])
        order = np.argsort(grams)
        index[f] = grams[order], owner[order]
    y_keys = np.unique(cls[y_at])
    step = max(1, CELLS // len(x_keys))
    by_class = y_at[np.argsort(cls[y_at], kind="stable")]
    bounds = np.searchsorted(cls[by_class], y_keys[::step])
    for lo, hi in zip(bounds.tolist(), [*bounds[1:].tolist(), len(by_class)]):
        at = by_class[lo:hi]
        keys, comps, n, owner = gathered(at)
        overlap = np.zeros(len(x_keys) * len(keys), np.int32)
        for f, (grams, of) in index.items():
            own = np.flatnonzero(fragment[at] == f)
            if not len(own):
                continue
            g = np.concatenate([rows["grams"][at[i]] for i in own])
            o = np.repeat(owner[own], [len(rows["grams"][at[i]]) for i in own])
            left = np.searchsorted(grams, g)
            hits = np.searchsorted(grams, g, side="right") - left
            met = np.flatnonzero(hits)  # an n-gram meets at most the queries of the block
            left, hits, o = left[met], hits[met], o[met]
            total = np.cumsum(hits)
            cuts = np.searchsorted(total, np.arange(HITS, int(total[-1]) if len(total) else 0, HITS)).tolist()
            for a, b in zip([0, *cuts], [*cuts, len(hits)]):
                if a == b:
                    continue
                h = hits[a:b]
                pos = np.repeat(left[a:b] - np.cumsum(h) + h, h) + np.arange(h.sum())
                cell = of[pos] * len(keys) + np.repeat(o[a:b], h)
                cell, times = np.unique(cell, return_counts=True)
                overlap[cell] += times.astype(np.int32)
        overlap = overlap.reshape(len(x_keys), len(keys)).astype(np.int64)
        ok = (100 * overlap >= least * (x_n[:, None] + n[None, :] - overlap)) & (x_comp[:, None] != comps[None, :])
        i, j = np.nonzero(ok)
        found.append(np.unique(np.stack([x_comp[i], comps[j]]), axis=1))
    root: dict[int, int] = {}

    def top(c: int) -> int:
        while root.get(c, c) != c:
            root[c] = root.get(root[c], root[c])
            c = root[c]
        return c

    out = []
    for a, b in np.concatenate(found, axis=1).T.tolist():
        if top(a) != top(b):
            root[top(b)] = top(a)
            out.append((a, b))
    links = np.array(out, np.int64).reshape(-1, 2)
    return links[:, 0], links[:, 1]


def compared_blocks(tasks: DataFrame, classes: DataFrame, least: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(list(batches))
        rows = {c: table[c].to_pylist() for c in ("query", "cls", "comp", "n", "fragment")}
        grams = table["grams"].combine_chunks()
        ends, flat = grams.offsets.to_numpy(), grams.values.to_numpy()
        rows["grams"] = [flat[a:b] for a, b in zip(ends, ends[1:])]
        a, b = compared_block(rows, least) if any(rows["query"]) and not all(rows["query"]) else ([], [])
        yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], LINKS.names)
    return tasks.join(classes.select("cls", "n", "fragment", "grams"), "cls") \
        .groupBy("grp", "block", "part").applyInArrow(run, LINKS).distinct()


def similar_components(classes: DataFrame, least: int) -> DataFrame | None:
    """(node, component) of linked classes, or None if there are none."""
    spark = classes.sparkSession
    entries, entries_path = staged(classes.where("prefix is not null").select(F.explode("prefix").alias("gram"), "cls", "n"), "prefixes")
    paths = [entries_path]

    def kept(df: DataFrame, name: str) -> DataFrame:
        out, path = staged(df, name)
        paths.append(path)
        return out

    # first round: every class with the leader that it shares most n-grams with
    near = F.lit(100) * F.least("n", "n_lead") >= F.lit(least) * F.greatest("n", "n_lead")
    pairs = open_entries(with_components(entries, None)).where("cls <> lead").where(near) \
        .groupBy("cls", "lead").agg(F.count(F.lit(1)).alias("c")) \
        .groupBy("cls").agg(F.max_by("lead", F.struct("c", "lead")).alias("lead")) \
        .select(F.least("cls", "lead").alias("a"), F.greatest("cls", "lead").alias("b")).distinct()
    links = kept(verified(pairs, classes, least), "similar")
    comp = None if links.isEmpty() else kept(components(links), "components")
    # second round: what is still apart and shares an n-gram, exhaustively
    rest = kept(open_entries(with_components(entries, comp)), "open")
    if not rest.isEmpty():
        more = kept(compared_blocks(kept(blocks_to_compare(rest), "blocks"), classes, least), "similar")
        if not more.isEmpty():
            links = links.unionByName(more)
            comp = components(links)
    out = None if comp is None else staged(comp, "components")[0]
    unstage(spark, *paths)
    return out


def join_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                    least: int = LEAST) -> DataFrame:
    """``id_col``, ``n_shingles`` and ``component_id``, the smallest id reachable by links, for every text."""
    return join_groups(docs, id_col, text_col, words, least).select(F.col("doc_id").alias(id_col), "n_shingles", "component_id")


def join_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = SHINGLE,
                least: int = LEAST, marks: tuple[Column, Column] | None = None) -> DataFrame:
    """The same (as ``doc_id``), with two ``marks`` of the row and the ``grp`` that it belongs to, of linked texts: null
    without words.  A group of rows without ids has no ``component_id``, but is a group like any other."""
    none = F.lit(None).cast("bigint")
    mark_a, mark_b = marks or (none, none)
    src = docs.select(col(id_col).cast("bigint").alias("doc_id"), col(text_col).cast("string").alias("text"),
                      mark_a.alias("mark_a"), mark_b.alias("mark_b"))
    spark = docs.sparkSession
    prof, prof_path = staged(profile(src, words), "shingle-profile")
    texts = prof.where("gram is null")
    classes = texts.where("n > 0").groupBy("cls").agg(
        F.min("doc_id").alias("rep"), F.min("n").alias("n"), F.max("n").alias("n_top"),
        F.min("second").alias("second"), F.max("second").alias("second_top"))
    total = classes.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0)),
                        F.count(F.when((F.col("n") != F.col("n_top")) | (F.col("second") != F.col("second_top")), 1))).first()
    if total[2]:
        raise ValueError(f"{total[2]} hashes stand for unequal sets")
    # at most HOT_LIMIT n-grams can reach this count
    enough = max(64, HOT_SHARE * total[0] / 2, total[1] / HOT_LIMIT)
    hot = prof.where("gram is not null").groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") >= enough).select("gram")
    hot = np.array([r.gram for r in hot.collect()], np.int64).view(np.uint64)
    buckets = bucket_count(total[1])
    counted = segments(src, words, hot, buckets).groupBy("load").applyInArrow(
        by_rows(lambda rows: count_load(rows, buckets), SHARED), SHARED)
    held, held_path = staged(counted.groupBy("part").applyInArrow(
        by_rows(lambda rows: class_rows(rows, least), CLASSES), CLASSES), "shingle-classes")
    comp = similar_components(held, least)
    unstage(spark, held_path)
    named = classes.select("cls", "rep", F.col("cls").alias("grp"))
    if comp is not None:
        linked = classes.select("cls", "rep").join(comp.withColumnRenamed("node", "cls"), "cls")
        least_id = linked.groupBy("component").agg(F.min("rep").alias("least_id"))
        moved = linked.join(least_id, "component").select("cls", "least_id", "component")
        named = named.join(moved, "cls", "left") \
            .select("cls", F.coalesce("least_id", "rep").alias("rep"), F.coalesce("component", "grp").alias("grp"))
    return texts.join(named, "cls", "left").select(
        "doc_id", "mark_a", "mark_b", F.col("n").alias("n_shingles"), F.coalesce("rep", "doc_id").alias("component_id"), "grp")

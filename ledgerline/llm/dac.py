"""Token-id files of directly addressable codes.

A file holds segments.  In a segment the ids of its documents stand one after
another, each id split into chunks of 8 bits.  Level 0 has the lowest chunk of
every id; a continuation bitmap marks the ids with more chunks, whose next
chunk stands in level 1, and so on.  The place of an id's chunk in the next
level is the number of set bits before it, which a rank directory (set bits
before every 512th bit) gives without reading the level, so any token is read
alone, without decoding a block.

Segments are written by Spark's text writer, one segment per record (bytes are
passed through as they are), and committed with the job, so lost executors
leave nothing half-written.  They are read with ``binaryFile``; files are kept
to a few segments each.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.llm.bpe import END, BatchEncoder, Vocabulary, laid_out, slices
from ledgerline.llm.common import col

MAGIC = b"DACTOK1\n"
WORD = 512                   # bits between two entries of a rank directory
SEGMENT_TOKENS = 1 << 20     # a segment ends with the document that reaches this
SEGMENTS_PER_FILE = 8
SLICE = 8 << 20              # length of the texts that are encoded together
WORDS = 400_000              # words whose ids a worker keeps
WORD_IDS = 1 << 23           # and ids of them
HEADER = struct.Struct("<8sqqqqq")  # magic, bytes after this header, shard, number in the shard, documents, tokens


def pack_levels(ids: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, continuation bitmap, rank directory) of each level."""
    levels, rest = [], ids.astype("<u4")
    while len(rest) or not levels:
        more = rest > 0xFF
        bits = np.packbits(more, bitorder="little")
        starts = np.add.reduceat(more, np.arange(0, len(more), WORD), dtype=np.int64) if len(more) else np.zeros(0, np.int64)
        rank = (np.cumsum(starts) - starts).astype("<u4")
        levels.append(((rest & 0xFF).astype(np.uint8), bits, rank))
        rest = rest[more] >> 8
    return levels


def pack_segment(shard: int, number: int, doc_ids: list[int | None], counts: list[int], ids: np.ndarray) -> bytes:
    body = [np.array([0 if d is None else d for d in doc_ids], "<i8").tobytes(),
            np.packbits(np.array([d is None for d in doc_ids], bool), bitorder="little").tobytes(),
            np.array(counts, "<u8").tobytes()]
    levels = pack_levels(ids)
    body.append(struct.pack("<q", len(levels)))
    for chunks, bits, rank in levels:
        body += [struct.pack("<q", len(chunks)), chunks.tobytes(), bits.tobytes(), rank.tobytes()]
    body = b"".join(body)
    return HEADER.pack(MAGIC, len(body), shard, number, len(doc_ids), len(ids)) + body


class Segment:
    """One segment, read in place."""

    def __init__(self, data: memoryview, at: int = 0):
        magic, size, self.shard, self.number, n_docs, self.n_tokens = HEADER.unpack_from(data, at)
        if magic != MAGIC:
            raise ValueError("not a segment of a token file")
        self.end = at + HEADER.size + size
        if self.end > len(data):
            raise ValueError("the segment is cut short")
        self.at, self.data = at + HEADER.size, data
        ids, null = self.take("<i8", n_docs), self.take("u1", -(-n_docs // 8))
        nulls = np.unpackbits(null, count=n_docs, bitorder="little").astype(bool)
        self.doc_ids = [None if z else d for d, z in zip(ids.tolist(), nulls.tolist())]
        self.counts = self.take("<u8", n_docs).astype(np.int64)
        self.levels = []
        for _ in range(self.int()):
            n = self.int()
            self.levels.append((self.take("u1", n), self.take("u1", -(-n // 8)), self.take("<u4", -(-n // WORD))))

    def int(self) -> int:
        self.at += 8
        return struct.unpack_from("<q", self.data, self.at - 8)[0]

    def take(self, kind: str, n: int) -> np.ndarray:
        out = np.frombuffer(self.data, kind, n, self.at)
        self.at += out.nbytes
        return out

    def token(self, i: int) -> int:
        """The ``i``-th id, from one chunk, bit and rank entry per level."""
        if not 0 <= i < self.n_tokens:
            raise IndexError(i)
        value, shift = 0, 0
        for chunks, bits, rank in self.levels:
            value |= int(chunks[i]) << shift
            if not bits[i >> 3] >> (i & 7) & 1:
                return value
            first = i // WORD
            before = np.unpackbits(bits[first * WORD // 8:(i >> 3) + 1], count=i - first * WORD, bitorder="little")
            i = int(rank[first]) + int(before.sum())
            shift += 8
        raise ValueError("a continuation bit has no next level")

    def all_tokens(self) -> np.ndarray:
        value = np.zeros(0, "<u4")
        for chunks, bits, _ in reversed(self.levels):
            more = np.unpackbits(bits, count=len(chunks), bitorder="little").astype(bool)
            level = chunks.astype("<u4")
            level[more] |= value << np.uint32(8)
            value = level
        return value


def segments(data: bytes) -> Iterator[Segment]:
    view, at = memoryview(data), 0
    while at < len(view):
        seg = Segment(view, at)
        yield seg
        at = seg.end + 1  # the writer's record separator


def headers(data: bytes) -> list[tuple[int, int, int]]:
    """(shard, number, tokens) of each segment, skipping from header to header."""
    at, rows = 0, []
    while at < len(data):
        _, size, shard, number, _, tokens = HEADER.unpack_from(data, at)
        rows.append((shard, number, tokens))
        at += HEADER.size + size + 1
    return rows


class LibraryEncoder(BatchEncoder):
    """Ids of many texts by the tokenizers library's own model: one call for the new words of a batch.

    The ids of the words met are stretches of one array.  A worker keeps up to
    ``WORDS`` of them, or ``WORD_IDS`` ids, between its tasks; beyond, it begins
    anew, which changes no result.
    """

    def __init__(self, spec: str, vocab: Vocabulary):
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.v = vocab
        self.library = Tokenizer.from_str(spec)
        self.library.no_truncation()
        self.library.no_padding()
        # the words are normalised, cut and byte-mapped already; byte-mapped text has no white space
        self.library.normalizer, self.library.pre_tokenizer = None, WhitespaceSplit()
        self.ends = np.array([t.endswith(END) for t in vocab.token])
        self.clear()

    def clear(self) -> None:
        self.words: dict[str, int] = {}
        self.table, self.start, self.size = np.zeros(0, "<u4"), np.zeros(0, np.int32), np.zeros(0, np.int32)

    def release(self) -> None:
        """Give back what tasks have used; the words are kept, for the next task."""
        pa.default_memory_pool().release_unused()

    def learn(self, new: list[str]) -> None:
        """Ids of words not met before: byte-mapped ones have a space after them, added tokens a line feed."""
        odd = [w for w in new if not w or w[-1] in " \n"]
        plain = [w for w in new if w and w[-1] not in " \n"] if odd else new
        ready = [w for w in odd if w and w[-1] == " "]
        tokens = [w for w in odd if w and w[-1] == "\n"]
        none = [w for w in odd if not w]
        mapped = [w if w.isascii() else self.v.byte_mapped(w) for w in plain] + [w[:-1] for w in ready]
        ids, size = np.zeros(0, "<u4"), np.zeros(0, np.int32)
        if mapped:
            ids = np.array(self.library.encode_batch_fast([" ".join(mapped)], add_special_tokens=False)[0].ids, "<u4")
            size = np.diff(np.flatnonzero(self.ends[ids]), prepend=-1).astype(np.int32)
            if len(size) != len(mapped) or size.sum() != len(ids):
                raise ValueError("a word was cut by the library")
        size = np.concatenate([size, np.ones(len(tokens), np.int32), np.zeros(len(none), np.int32)])
        added = np.array([self.v.added[w[:-1]] for w in tokens], "<u4")
        at = len(self.words)
        self.words.update(zip([*plain, *ready, *tokens, *none], range(at, at + len(new))))
        self.start = np.concatenate([self.start, np.cumsum(size, dtype=np.int32) - size + np.int32(len(self.table))])
        self.size = np.concatenate([self.size, size])
        self.table = np.concatenate([self.table, ids, added])

    def __call__(self, texts: list[str | None], decoded: bool = False) -> tuple[np.ndarray, np.ndarray, None]:
        if decoded:
            raise ValueError("this encoder gives ids only")
        words, n = self.cut(texts)
        distinct = words.dictionary.to_pylist()
        new = [w for w in distinct if w not in self.words]
        if len(self.words) + len(new) > WORDS or len(self.table) > WORD_IDS:
            self.clear()
            new = distinct
        if new:
            self.learn(new)
        number = np.fromiter(map(self.words.__getitem__, distinct), np.int64, len(distinct))
        return *laid_out(self.table, self.start, self.size, number[words.indices.to_numpy()], n), None


_ENCODERS: dict[int, LibraryEncoder] = {}


def library_encoder(spec: str) -> LibraryEncoder:
    key = hash(spec)
    if key not in _ENCODERS:
        _ENCODERS.clear()
        _ENCODERS[key] = LibraryEncoder(spec, Vocabulary(spec))
    return _ENCODERS[key]


def write_tokens(df: DataFrame, path: str, vocabulary_path: str, end_id: int = 2, id_col: str = "doc_id",
                 text_col: str = "text", shards: int | None = None) -> None:
    """Encode each text, append ``end_id``, and write the ids in ascending id order.

    Rows are dealt to shards by ranges of the id, so shard and number within
    it give the order.  Rows of equal ids stand in the order of their texts;
    null ids come first; a null text has the end id alone.  An empty table
    gives files without segments.
    """
    spark = df.sparkSession
    with open(vocabulary_path, encoding="utf-8") as fh:
        spec = spark.sparkContext.broadcast(fh.read())
    n = shards or 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    src = df.select(col(id_col).cast("bigint").alias("id"), col(text_col).cast("string").alias("text")) \
        .repartitionByRange(n, F.col("id").asc_nulls_first()).sortWithinPartitions(F.col("id").asc_nulls_first(), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, shard, number = library_encoder(spec.value), TaskContext.get().partitionId(), 0
        docs, counts, parts, tokens = [], [], [], 0

        def flush():
            nonlocal docs, counts, parts, tokens, number
            seg = pack_segment(shard, number, docs, counts, np.concatenate(parts))
            docs, counts, parts, tokens, number = [], [], [], 0, number + 1
            return pa.RecordBatch.from_arrays([pa.array([seg], pa.binary())], ["segment"])

        for batch in batches:
            ids = batch.column(0).to_pylist()
            for at, rows in slices(batch.column(1), SLICE):
                own, n, _ = enc(rows)
                own = np.insert(own, np.cumsum(n), end_id)  # each document's end
                n = (n + 1).tolist()
                first = done = 0
                for d, k in zip(ids[at:at + len(rows)], n):
                    docs.append(d)
                    counts.append(k)
                    done += k
                    tokens += k
                    if tokens >= SEGMENT_TOKENS:
                        parts.append(own[first:done])
                        first = done
                        yield flush()
                parts.append(own[first:])
        if docs:
            yield flush()
        enc.release()

    src.mapInArrow(run, "segment binary").select(F.col("segment").cast("string").alias("value")) \
        .write.option("compression", "none").option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)


DOC_SCHEMA = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("number", T.LongType()), T.StructField("place", T.LongType()),
    T.StructField("doc_id", T.LongType()), T.StructField("offset", T.LongType()), T.StructField("n_tokens", T.LongType()),
    T.StructField("ids", T.BinaryType())])
SEGMENT_SCHEMA = T.StructType([
    T.StructField("shard", T.LongType()), T.StructField("number", T.LongType()), T.StructField("n_tokens", T.LongType())])


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per document of the files: its place, offset in its segment and ids (little-endian unsigned 32-bit)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                for seg in segments(content.as_py()):
                    raw, cuts = seg.all_tokens().tobytes(), np.concatenate([[0], np.cumsum(seg.counts)]).tolist()
                    n = len(seg.doc_ids)
                    yield pa.RecordBatch.from_arrays([
                        pa.array([seg.shard] * n, pa.int64()), pa.array([seg.number] * n, pa.int64()),
                        pa.array(range(n), pa.int64()), pa.array(seg.doc_ids, pa.int64()),
                        pa.array(cuts[:-1], pa.int64()), pa.array(seg.counts, pa.int64()),
                        pa.array([raw[4 * a:4 * b] for a, b in zip(cuts, cuts[1:])], pa.binary())], DOC_SCHEMA.names)
    return files(spark, path).mapInArrow(run, DOC_SCHEMA)


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """One row per segment, from the headers alone."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content in batch.column(0):
                rows = headers(content.as_py())
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], SEGMENT_SCHEMA.names)
    return files(spark, path).mapInArrow(run, SEGMENT_SCHEMA)


def files(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content")


def segment_starts(spark: SparkSession, path: str) -> DataFrame:
    """(shard, number, first): tokens of all earlier segments.

    Sums within shards are windows by shard; only one row per shard meets in
    the ordering over shards, so that step is as small as the shard count.
    """
    return starts_of(read_segments(spark, path))


def starts_of(seg: DataFrame) -> DataFrame:
    """The same from (shard, number, n_tokens) of the segments."""
    in_shard = Window.partitionBy("shard").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    shards = seg.groupBy("shard").agg(F.sum("n_tokens").alias("n")) \
        .select("shard", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    inner = seg.select("shard", "number", F.coalesce(F.sum("n_tokens").over(in_shard), F.lit(0)).alias("inner"))
    return inner.join(shards, "shard").select("shard", "number", (F.col("base") + F.col("inner")).alias("first"))


def with_starts(documents: DataFrame, starts: DataFrame) -> DataFrame:
    """Documents with ``start``, the number of tokens of all documents before.

    Give it the columns that are needed, without ``ids`` where a digest will
    do: the join moves what it is given.
    """
    return documents.join(starts, ["shard", "number"]).withColumn("start", F.col("first") + F.col("offset")) \
        .drop("shard", "number", "place", "offset", "first")

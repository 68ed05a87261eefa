"""Records of CSV files whose quoted cells hold line breaks, cut in parallel within files.

A line is a map from the quote state before it (outside or inside a quoted
cell) to the state after it: it sets the state, turns it over, or leaves it.
Such maps compose, so

1. each block of a file gives one row, the composed map of its lines;
2. running compositions over a file's few block rows give every block's start;
3. blocks are cut into records on their own.  What a block begins without
   ending, or ends without having begun, is a fragment, and the fragments of a
   file are joined in order.

Lines are never shuffled or sorted: tasks stream over their blocks.  A record is
held in memory as a whole.  UTF-16 files are cut at line feeds in whole code
units: a cut that leaves an odd number of bytes fell inside two characters, and
is undone.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerline.session import scratch_path, ship_package

BLOCKS_BROADCAST = 100_000  # block starts that are sent to every task; beyond, lines are brought to them in order
WHOLE, BEGINS, ENDS, PASSES = range(4)  # a whole record; a fragment that begins, ends or lies within one

BLOCK = T.StructType([T.StructField("path", T.StringType()), T.StructField("block", T.LongType()),
                      T.StructField("if_closed", T.IntegerType()), T.StructField("if_open", T.IntegerType())])
PIECE = T.StructType([T.StructField("path", T.StringType()), T.StructField("source_file", T.StringType()),
                      T.StructField("block", T.LongType()), T.StructField("kind", T.IntegerType()),
                      T.StructField("first", T.BooleanType()), T.StructField("n_lines", T.LongType()),
                      T.StructField("text", T.StringType())])
RAW = T.StructType([T.StructField("value", T.BinaryType()), T.StructField("path", T.StringType()),
                    T.StructField("source_file", T.StringType()), T.StructField("block", T.LongType())])


def states(opens: np.ndarray, stays: np.ndarray, start: int) -> np.ndarray:
    """Quote state after each line: ``opens`` is the state after it if closed before, ``stays`` if open before."""
    turned = np.cumsum(opens & ~stays)
    at = np.maximum.accumulate(np.where(opens == stays, np.arange(len(opens)), -1))
    base = np.where(at >= 0, opens[at] - turned[at], start)
    return (base + turned) & 1


def in_blocks(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Runs of rows of one block, by the columns ``path`` and ``block``."""
    path, block = batch.column("path"), batch.column("block").to_numpy()
    path = path.dictionary_encode().indices.to_numpy()
    cuts = np.flatnonzero((np.diff(block) != 0) | (np.diff(path) != 0)) + 1
    for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        if b > a:
            yield (batch.column("path")[a].as_py(), int(block[a])), batch.slice(a, b - a)


def block_maps(lines: DataFrame) -> DataFrame:
    """One row per block: the state after it if it starts outside quotes, and if it starts inside."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, now = None, (0, 1)
        done = []
        for batch in batches:
            for k, rows in in_blocks(batch):
                if k != key:
                    if key:
                        done.append((*key, *now))
                    key, now = k, (0, 1)
                flags = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays")]
                after = [int(states(*flags, s)[-1]) for s in (0, 1)]
                now = (after[now[0]], after[now[1]])
        if key:
            done.append((*key, *now))
        cols = list(zip(*done)) or [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.string(), pa.int64(), pa.int32(), pa.int32()))], BLOCK.names)

    return lines.select("path", "block", "opens", "stays").mapInArrow(run, BLOCK)


def block_starts(maps: DataFrame) -> DataFrame:
    """``path``, ``block``, and the quote state in which each block starts (``start``) and ends (``after``)."""
    so_far = Window.partitionBy("path").orderBy("block").rowsBetween(Window.unboundedPreceding, 0)
    turned = maps.withColumn("turns", F.sum(F.when(F.col("if_closed") > F.col("if_open"), 1).otherwise(0)).over(so_far))
    was_set = F.last(F.when(F.col("if_closed") == F.col("if_open"), F.col("if_closed") - F.col("turns")), ignorenulls=True).over(so_far)
    after = turned.withColumn("after", F.pmod(F.coalesce(was_set, F.lit(0)) + F.col("turns"), F.lit(2)).cast("int"))
    before = F.lag("after", 1, 0).over(Window.partitionBy("path").orderBy("block"))
    return after.select("path", "block", before.alias("start"), "after")


def cut_records(lines: DataFrame) -> DataFrame:
    """Whole records and fragments of blocks; ``lines`` has its block's ``start`` and comes in order."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key = name = None
        held: list[str] = []          # lines of the record that is open
        begun = first = True          # it began in this block; it is the first of its file
        state = 0
        out: list[tuple] = []

        def emit(whole: bool) -> None:
            kind = (WHOLE if begun else ENDS) if whole else (BEGINS if begun else PASSES)
            out.append((key[0], name, key[1], kind, first, len(held), "\n".join(held)))

        def flush() -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int32(), pa.bool_(), pa.int64(), pa.string())
            cols = list(zip(*out)) or [[]] * 7
            out.clear()
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, kinds)], PIECE.names)

        for batch in batches:
            for k, rows in in_blocks(batch):
                if k != key:
                    if held:
                        emit(False)
                    key, name, held = k, rows.column("source_file")[0].as_py(), []
                    state = rows.column("start")[0].as_py()
                    begun, first = not state, k[1] == 0
                flags = [rows.column(c).to_numpy(zero_copy_only=False) for c in ("opens", "stays")]
                after = states(*flags, state)
                text = rows.column("line").to_pylist()
                ends = (np.flatnonzero(after == 0) + 1).tolist()
                at = 0
                for end in ends:
                    held += text[at:end]
                    emit(True)
                    held, begun, first, at = [], True, False, end
                held += text[at:]
                state = int(after[-1])
            yield flush()
        if held:
            emit(False)
        yield flush()

    return lines.mapInArrow(run, PIECE)


def realigned(raw: DataFrame, little: bool) -> DataFrame:
    """UTF-16 lines cut at line feeds of whole code units, without the file's byte-order mark; a wrong cut is undone within its block."""
    feed, mark = (b"\n\x00", b"\xff\xfe") if little else (b"\x00\n", b"\xfe\xff")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, row, held, odd = None, (), [], False
        out: list[tuple] = []

        def close() -> None:
            if odd:
                raise ValueError(f"{key[0]}: what looks like a line feed lies across two characters and two blocks; read it in larger blocks")

        for batch in batches:
            for k, rows in in_blocks(batch):
                top = k != key and not k[1]
                if k != key:
                    close()
                    key, held, odd = k, [], False
                    row = (k[0], rows.column("source_file")[0].as_py(), k[1])
                for value in rows.column("value"):
                    piece = value.as_py()
                    if top:  # the file's first line
                        piece, top = piece.removeprefix(mark), False
                    held.append(piece)
                    odd ^= bool(len(piece) & 1)
                    if not odd:
                        out.append((feed.join(held), *row))
                        held = []
            cols = list(zip(*out)) or [[]] * 4
            out.clear()
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.binary(), pa.string(), pa.string(), pa.int64()))], RAW.names)
        close()

    return raw.select(F.col("value").cast("binary").alias("value"), "path", "source_file", "block").mapInArrow(run, RAW)


def file_lines(spark: SparkSession, paths: Sequence[str] | None, src, reader, utf16: str | None) -> DataFrame:
    """Lines of files with their block, in order; 8-bit files byte for byte as ISO-8859-1."""
    reader = reader.option("lineSep", "\n")
    if utf16:
        reader = reader.option("encoding", utf16)
    raw = reader.load(list(paths) if paths is not None else src).select(
        "value", F.col("_metadata.file_path").alias("path"), F.col("_metadata.file_name").alias("source_file"),
        F.col("_metadata.file_block_start").alias("block"))
    if not utf16:
        return raw.withColumn("line", F.decode(F.col("value").cast("binary"), "ISO-8859-1")).drop("value")
    return realigned(raw, utf16.endswith("LE")).withColumn("line", F.decode("value", utf16)).drop("value")


def pieces(lines: DataFrame, opens, stays) -> tuple[DataFrame, DataFrame]:
    """(whole records and fragments, on the shared folder; files whose last quote stays open) of files' lines.

    ``opens`` and ``stays`` are the line's columns: whether a line that starts
    outside, or inside, of a quoted cell ends inside of one.
    """
    spark = lines.sparkSession
    ship_package(spark)
    flagged = lines.withColumn("opens", opens).withColumn("stays", stays)
    path = scratch_path(spark, "csv-blocks")
    block_starts(block_maps(flagged)).write.parquet(path)
    starts = spark.read.parquet(path)
    last = starts.groupBy("path").agg(F.max_by("after", "block").alias("after"))
    unclosed = last.where("after = 1").select("path")
    if starts.count() <= BLOCKS_BROADCAST:  # from the file footers
        placed = flagged.join(F.broadcast(starts.select("path", "block", "start")), ["path", "block"])
    else:
        placed = flagged.withColumn("pos", F.monotonically_increasing_id()).join(starts.select("path", "block", "start"), ["path", "block"]) \
            .repartition("path", "block").sortWithinPartitions("path", "block", "pos")
    out = scratch_path(spark, "csv-pieces")
    cut_records(placed.select("path", "source_file", "block", "start", "opens", "stays", "line")).write.parquet(out)
    return spark.read.schema(PIECE).parquet(out), unclosed


def joined(parts: DataFrame) -> DataFrame:
    """``path``, ``source_file``, ``first``, ``n_lines`` and ``text`` of all records, fragments put together."""
    whole = parts.where(F.col("kind") == WHOLE).select("path", "source_file", "first", "n_lines", "text")
    order = F.struct("block", (F.col("kind") == BEGINS).alias("begins"))
    begun = F.sum((F.col("kind") == BEGINS).cast("int"))
    numbered = parts.where(F.col("kind") != WHOLE).withColumn("record", begun.over(Window.partitionBy("path").orderBy(order)))
    across = numbered.groupBy("path", "source_file", "record").agg(
        F.bool_or(F.col("first") & (F.col("kind") == BEGINS)).alias("first"), F.sum("n_lines").alias("n_lines"),
        F.sort_array(F.collect_list(F.struct(order.alias("o"), F.col("text").alias("text")))).alias("t"))
    return whole.unionByName(across.select("path", "source_file", "first", "n_lines", F.array_join(F.col("t.text"), "\n").alias("text")))

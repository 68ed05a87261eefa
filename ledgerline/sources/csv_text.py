"""CSV report reading: all cells as strings, by position.

* Lines are read split-parallel (no ``multiLine``); the header line of every
  file is dropped by the reader itself.
* Lines wrapped whole in quotes (with inner quotes doubled) are unwrapped by
  a line expression before parsing, so repair never rewrites the source.
* Cells are parsed with ``from_csv``: short rows are null-filled, extra cells
  dropped; an unquoted empty cell is null and a quoted empty cell is ''.
* A cell may hold line breaks inside its quotes; files with such cells are
  found by the profile pass and cut into records block by block.  Only a quote
  at the start of a cell opens it; other quotes of an unquoted cell are text.
  Files whose last quote stays open, or with a record of several lines that is
  too wide or whose quotes do not pair, are errors: rows may be hidden in it.
* The encoding of each file is decided from its own bytes: a UTF-16 byte
  order mark (little or big endian), else valid UTF-8, else by a count of its
  bytes 0x80 to 0x9F: windows-1252 if there are some (besides 0x85, a line mark
  in ISO-8859-1) and all are characters of it, else ISO-8859-1.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.columns import ColumnCountError
from ledgerline.session import scratch_path
from ledgerline.sources.csv_records import file_lines, joined, pieces
from ledgerline.sources.files import SourceError, list_files, suffix_glob

# Reader options.  The null sentinel makes an unquoted empty cell
# null while a quoted empty cell stays ''.
NULL_SENTINEL = "\u0001"
# "multiLine" keeps line breaks inside quoted cells as they are.
CSV_OPTIONS = {"sep": ",", "quote": '"', "escape": '"', "nullValue": NULL_SENTINEL,
               "mode": "PERMISSIVE", "multiLine": "true"}
# Separator for reading whole lines as one cell (quoting off); never in report text.
LINE_SEP_TOKEN = "\u0001\u0002\u0003"
# possessive runs: a plain (?:[^"]|"")* recurses once per character in Java's
# regex engine and overflows the stack on long lines
WRAPPED_LINE = r'^"(?:[^"]++|"")*+"\z'
# Bytes 0x80 to 0x9F of windows-1252 that are characters, in order; those that are none.
CP1252_BYTES = "".join(map(chr, [0x80, *range(0x82, 0x8D), 0x8E, *range(0x91, 0x9D), 0x9E, 0x9F]))
CP1252_UNDEFINED = "\u0081\u008d\u008f\u0090\u009d"
CP1252_CHARS = "\u20ac\u201a\u0192\u201e\u2026\u2020\u2021\u02c6\u2030\u0160\u2039\u0152\u017d" \
               "\u2018\u2019\u201c\u201d\u2022\u2013\u2014\u02dc\u2122\u0161\u203a\u0153\u017e\u0178"


def is_wrapped(line: Column) -> Column:
    """The whole line is one quoted field (inner quotes doubled)."""
    return line.rlike(WRAPPED_LINE)


def repair_line(line: Column, compat: bool = False) -> Column:
    """Unwrap a quote-wrapped line: drop the outer quotes, then ``""`` -> ``"``.

    By default only lines that are a single quoted field are touched, so a
    normally quoted line such as ``"a","b"`` is left alone.  ``compat=True``
    drops the outer quotes of every line that starts and ends with one, and
    replaces ``""`` on every line.
    """
    inner = F.substr(line, F.lit(2), F.length(line) - 2)
    if compat:
        outer = line.startswith('"') & line.endswith('"') & (F.length(line) >= 2)
        return F.replace(F.when(outer, inner).otherwise(line), F.lit('""'), F.lit('"'))
    return F.when(is_wrapped(line), F.replace(inner, F.lit('""'), F.lit('"'))).otherwise(line)


def cells_ddl(names: Sequence[str]) -> str:
    return ", ".join(f"`{n}` string" for n in names)


def parse_cells(line: Column, names: Sequence[str]) -> Column:
    """Struct of string cells named by position."""
    return F.from_csv(line, F.lit(cells_ddl(names)), dict(CSV_OPTIONS))


def encoding_rule(first_bytes: Column, valid_utf8: Column, letters: Column, controls: Column) -> Column:
    """Encoding from a file's first bytes, whether all of it is valid UTF-8, and its numbers of bytes that windows-1252
    has as characters in place of control codes (``letters``) and of those that it does not define (``controls``):
    UTF-16 byte-order mark, else UTF-8, else windows-1252, else ISO-8859-1."""
    head = F.hex(F.substring(first_bytes, 1, 2))
    return (F.when(head == "FFFE", F.lit("UTF-16LE")).when(head == "FEFF", F.lit("UTF-16BE"))
             .when(valid_utf8, F.lit("UTF-8")).when((letters > 0) & (controls == 0), F.lit("windows-1252"))
             .otherwise(F.lit("ISO-8859-1")))


def _count_of(latin1: Column, chars: str) -> Column:
    """Characters of ``chars`` in a text."""
    return F.length(latin1) - F.length(F.translate(latin1, chars, ""))


def byte_counts(valid_utf8: Column, latin1: Column) -> tuple[Column, Column]:
    """``letters`` and ``controls`` of :func:`encoding_rule` for bytes as ISO-8859-1; valid UTF-8 is not counted.  Sums of
    parts are the counts of the whole, so they add up over lines, blocks and tasks."""
    some = ~valid_utf8 & latin1.rlike("[\u0080-\u009f]")
    letters = CP1252_BYTES.replace("\u0085", "")  # a line mark in the one, an ellipsis in the other: it decides nothing
    return tuple(F.when(some, _count_of(latin1, x)).otherwise(0) for x in (letters, CP1252_UNDEFINED))


def detect_encoding(content: Column) -> Column:
    """Encoding of a byte column."""
    valid = F.is_valid_utf8(content.cast("string"))
    return encoding_rule(content, valid, *byte_counts(valid, F.decode(content, "ISO-8859-1")))


def decode_as(content: Column, encoding: Column) -> Column:
    body = F.substring(content, 3, 1 << 30)  # after the byte-order mark
    return (F.when(encoding == "UTF-8", F.decode(content, "UTF-8"))
             .when(encoding == "UTF-16LE", F.decode(body, "UTF-16LE"))
             .when(encoding == "UTF-16BE", F.decode(body, "UTF-16BE"))
             .when(F.lower(encoding) == "windows-1252", cp1252(F.decode(content, "ISO-8859-1")))
             .otherwise(F.decode(content, "ISO-8859-1")))


def cp1252(latin1: Column) -> Column:
    """Text read as ISO-8859-1, as windows-1252 reads its bytes; the five undefined bytes stay as they are."""
    return F.translate(latin1, CP1252_BYTES, CP1252_CHARS)


@dataclass(frozen=True)
class FileProfile:
    path: str
    lines: int
    encoding: str
    header_cells: int
    wrapped_lines: int
    open_lines: int


_QUOTED_FIELD = r'"(?:[^"]++|"")*+"'


# A line's cells as from_csv reads them: a cell that starts with a quote ends at the next lone quote, with
# whatever follows up to the separator; a quote elsewhere is text.
_QUOTED_PART = r'(?:[^"]++|"")*+'
_WHOLE_CELLS = rf'(?:(?:"{_QUOTED_PART}"[^,]*+|[^",][^,]*+)?+,)*+'
# Lines that end inside quotes, of those that start outside and inside of them.
OPENS = rf'\A{_WHOLE_CELLS}"{_QUOTED_PART}\z'
STAYS_OPEN = rf'\A{_QUOTED_PART}(?:"[^,]*+,{_WHOLE_CELLS}"{_QUOTED_PART})?+\z'
# A record whose quoted cells end where their quotes do.
PAIRED = r'\A(?:(?:"(?:[^"]++|"")*+"[ \t\r]*+|[^",][^,]*+)?+(?:,|\z))*+\z'


def opens_quote(line: Column) -> Column:
    """A line that starts outside quotes ends inside them, so a cell goes on in the next line."""
    return line.contains('"') & line.rlike(OPENS)


def stays_open(line: Column) -> Column:
    """A line that starts inside quotes ends inside them."""
    return ~line.contains('"') | line.rlike(STAYS_OPEN)


def _sources(spark: SparkSession, src: str | Sequence[str], fmt: str):
    """A reader for a folder (non-recursive, ``*.csv`` any case) or a file list."""
    r = spark.read.format(fmt)
    if isinstance(src, str):
        return r.option("pathGlobFilter", suffix_glob(("csv",))).option("recursiveFileLookup", "false"), src
    return r, list(src)


def profile_frame(spark: SparkSession, src: str | Sequence[str]) -> DataFrame:
    """One row per file, computed by one pass over all lines: ``path``,
    ``lines`` (that are not blank), ``encoding``, ``header_cells`` (width of the header line, once
    unwrapped), ``wrapped`` (quote-wrapped lines) and ``open`` (lines that
    open a quoted cell which goes on in the next line).  Nothing is collected
    here."""
    reader, where = _sources(spark, src, "text")
    t = reader.load(where).select(
        "value", F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("pos"))
    raw = F.col("value").cast("binary")
    bytes_text = F.decode(raw, "ISO-8859-1")
    valid = F.is_valid_utf8("value")
    letters, controls = byte_counts(valid, bytes_text)
    first_block = F.col("block") == 0
    agg = t.groupBy("path").agg(
        F.count_if(F.col("value").rlike(r"[^\s\x00]")).alias("lines"),
        F.bool_and(valid).alias("utf8"), F.sum(letters).alias("letters"), F.sum(controls).alias("controls"),
        F.min_by(F.when(first_block, raw), F.when(first_block, F.col("pos"))).alias("header"),
        F.count_if(is_wrapped(F.col("value"))).alias("wrapped"),
        F.count_if(opens_quote(bytes_text)).alias("open8"),
        F.count_if(opens_quote(F.replace(bytes_text, F.lit("\u0000"), F.lit("")))).alias("open16"),
    )
    enc = encoding_rule(F.col("header"), F.col("utf8"), F.col("letters"), F.col("controls"))  # byte-order mark of the file's first line only
    # the header line split on raw "\n" bytes: for UTF-16 drop the BOM and the odd trailing byte
    h = F.col("header")
    h16 = F.substring(h, 3, 1 << 30)
    h16 = F.substring(h16, 1, (F.length(h16) / 2).cast("int") * 2)
    text = (F.when(F.col("encoding") == "UTF-16LE", F.decode(h16, "UTF-16LE"))
             .when(F.col("encoding") == "UTF-16BE", F.decode(h16, "UTF-16BE"))
             .when(F.col("encoding") == "UTF-8", F.decode(h, "UTF-8"))
             .when(F.col("encoding") == "windows-1252", cp1252(F.decode(h, "ISO-8859-1")))
             .otherwise(F.decode(h, "ISO-8859-1")))
    text = repair_line(F.regexp_replace(text, "^\ufeff|[\r\u0000]+$", ""))
    width = F.size(F.split(F.regexp_replace(text, _QUOTED_FIELD, "q"), ","))
    opened = F.when(F.col("encoding").startswith("UTF-16"), F.col("open16")).otherwise(F.col("open8")).alias("open")
    return (agg.withColumn("encoding", enc).withColumn("header_text", text)
               .select("path", "lines", "encoding", width.alias("header_cells"), "wrapped", opened))


def profile_files(spark: SparkSession, paths: Sequence[str] | str) -> list[FileProfile]:
    """The per-file profile as a list (for inspection and tests)."""
    rows = profile_frame(spark, paths).collect()
    return sorted((FileProfile(r.path, r.lines, r.encoding, r.header_cells, r.wrapped, r.open) for r in rows),
                  key=lambda p: p.path)


def read_lines(spark: SparkSession, paths: str | Sequence[str], encoding: str) -> DataFrame:
    """Data lines (header dropped) of files in one encoding, with file lineage.

    ``paths`` is a folder (its ``*.csv`` files) or a list of files."""
    reader, where = _sources(spark, paths, "csv")
    reader = (reader.schema("line string").option("header", True).option("sep", LINE_SEP_TOKEN)
              .option("quote", "").option("encoding", encoding))
    if encoding.upper().startswith("UTF-16"):
        reader = reader.option("lineSep", "\n")
    df = reader.load(where)
    return df.select(F.rtrim(F.col("line"), F.lit("\r")).alias("line"),
                     F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.file_path").alias("path"))


def decode_line_per_line(line: Column) -> Column:
    """A line read byte-for-byte as ISO-8859-1, re-decoded as UTF-8 when its
    bytes are valid UTF-8 (and kept as ISO-8859-1 text otherwise)."""
    raw = F.encode(line, "ISO-8859-1")
    return F.when(F.is_valid_utf8(raw.cast("string")), F.decode(raw, "UTF-8")).otherwise(line)


def decode_line(line: Column, encoding: str | Column) -> Column:
    """A line read byte-for-byte as ISO-8859-1, in the given encoding (not UTF-16)."""
    if isinstance(encoding, str):
        if encoding == "per-line":
            return decode_line_per_line(line)
        encoding = F.lit(encoding)
    return F.when(encoding == "UTF-8", F.decode(F.encode(line, "ISO-8859-1"), "UTF-8")) \
            .when(F.lower(encoding) == "windows-1252", cp1252(line)).otherwise(line)


def read_records(spark: SparkSession, src: str | Sequence[str], files: DataFrame, encoding: str,
                 names: Sequence[str]) -> DataFrame:
    """Records of files whose quoted cells hold line breaks, header dropped.

    ``files`` has the ``path`` and ``encoding`` of those files.  Blocks of a
    file are cut in parallel (:mod:`ledgerline.sources.csv_records`).  The
    records are written once; files with a record that may hide rows raise with
    the files as a DataFrame.
    """
    kinds = [r.encoding for r in files.select("encoding").distinct().collect()] if encoding == "auto" else [encoding]
    out, bad = None, None
    for utf16 in [None, *(k for k in kinds if k.upper().startswith("UTF-16"))]:
        own = files.where(F.col("encoding") == utf16 if utf16 and encoding == "auto" else ~F.col("encoding").startswith("UTF-16") if not utf16 else F.lit(True))
        if not utf16 and all(k.upper().startswith("UTF-16") for k in kinds):
            continue
        reader, where = _sources(spark, src, "text")
        # UTF-16 files are read by path, for their line feeds are other bytes
        paths = [r.path for r in own.select("path").collect()] if utf16 else None
        lines = file_lines(spark, paths, where, spark.read.format("text") if paths else reader, utf16)
        lines = lines.join(F.broadcast(own.select("path", "encoding")), "path") if not utf16 else lines.withColumn("encoding", F.lit(utf16))
        kind = own.select("path", F.col("encoding").alias("file_encoding"))
        parts, unclosed = pieces(lines.drop("encoding"), opens_quote(F.col("line")), stays_open(F.col("line")))
        records = joined(parts)
        text = F.rtrim(F.col("text"), F.lit("\r"))
        whole = repair_line(text)
        extra = parse_cells(whole, [*(f"c{i}" for i in range(len(names))), "more"])["more"]
        fault = F.when(~whole.rlike(PAIRED), F.lit("quotes do not pair")).when(extra.isNotNull(), F.lit("too many cells"))
        faults = unclosed.withColumn("fault", F.lit("a quote is never closed")).unionByName(
            records.where("n_lines > 1").select("path", fault.alias("fault")).where("fault is not null"))
        bad = faults if bad is None else bad.unionByName(faults)
        records = records.where(~F.col("first")).select("path", "source_file", text.alias("line"))
        if not utf16:
            charset = F.col("file_encoding") if encoding == "auto" else encoding
            records = records.join(kind, "path").withColumn("line", decode_line(F.col("line"), charset))
        records = records.select("line", "source_file")
        out = records if out is None else out.unionByName(records)
    found = bad.groupBy("path").agg(F.min("fault").alias("fault"))
    worst = found.agg(F.count(F.lit(1)).alias("files"), F.min(F.struct("path", "fault")).alias("w")).first()
    if worst.files:
        raise SourceError(f"{worst.files} CSV files have cells over several lines that may hide rows, "
                          f"such as {worst.w.path} ({worst.w.fault})", found)
    return out


def read_report_csv(spark: SparkSession, folder_or_paths: str | Sequence[str], names: Sequence[str],
                    encoding: str = "auto", compat: bool = False) -> tuple[DataFrame, dict]:
    """Read CSV report files into named string cells.

    Returns the frame (``source_file`` + one column per name) and a small
    dict of per-read facts for the audit (files, encodings, read mode).  A
    profile pass checks every file: exact header width, at least one data row;
    a failed check raises with the offending files as a DataFrame (``files``).
    Only one summary row per encoding reaches the driver, and the paths of
    UTF-16 files when they are mixed with others.

    ``encoding`` is ``'auto'`` (per file, from its bytes), ``'per-line'`` (UTF-8
    where a line's bytes are valid UTF-8, else ISO-8859-1), or a charset of all
    files, ``windows-1252`` included.  Files with line breaks inside quoted
    cells are read record by record.
    """
    src = folder_or_paths if isinstance(folder_or_paths, str) else list(folder_or_paths)
    if isinstance(src, str):
        list_files(spark, src, ("csv",))  # missing folder / no CSV files are errors
    elif not src:
        raise SourceError("no CSV files to read")
    n = len(names)
    path = scratch_path(spark, "csv-profile")
    profile_frame(spark, src).write.parquet(path)
    prof = spark.read.parquet(path)
    summary = prof.groupBy("encoding").agg(
        F.count(F.lit(1)).alias("files"), F.sum("wrapped").alias("wrapped"),
        F.count_if(F.col("open") > 0).alias("open"), F.count_if(F.col("lines") <= 1).alias("empty"),
        F.count_if(F.col("header_cells") != n).alias("bad_width")).collect()
    empty, wide = sum(r.empty for r in summary), sum(r.bad_width for r in summary)
    if empty:
        bad = prof.where("lines <= 1").select("path", "lines")
        raise SourceError(f"{empty} CSV files have no data rows, such as {bad.agg(F.min('path')).first()[0]}", bad)
    if wide:
        bad = prof.where(F.col("header_cells") != n).select("path", "header_cells")
        worst = bad.agg(F.min(F.struct("path", "header_cells")).alias("w")).first().w
        raise ColumnCountError(f"wrong number of columns: {worst.header_cells}; allowed: {n} ({worst.path}; {wide} files)", bad)
    utf16 = [r for r in summary if r.encoding.startswith("UTF-16")] if encoding == "auto" else []
    facts = {"files": sum(r.files for r in summary),
             "read_mode": "repaired" if any(r.wrapped for r in summary) else "plain",
             "encodings": {r.encoding: r.files for r in summary} if encoding == "auto" else {encoding: sum(r.files for r in summary)}}

    if encoding == "auto" and len(summary) == 1 and summary[0].encoding != "windows-1252":
        lines = read_lines(spark, src, summary[0].encoding)
    elif encoding.upper().startswith("UTF-") and encoding != "auto":
        lines = read_lines(spark, src, encoding)
    elif encoding != "auto":
        lines = read_lines(spark, src, "ISO-8859-1").withColumn("line", decode_line(F.col("line"), encoding))
    else:
        by_file = prof.where(~F.col("encoding").startswith("UTF-16")).select("path", "encoding")
        lines = read_lines(spark, src, "ISO-8859-1").join(by_file, "path") \
            .withColumn("line", decode_line(F.col("line"), F.col("encoding"))).drop("encoding")
        for r in utf16:
            paths = [p.path for p in prof.where(F.col("encoding") == r.encoding).select("path").collect()]
            lines = lines.unionByName(read_lines(spark, paths, r.encoding))
    if any(r.open for r in summary):
        broken = prof.where("open > 0")
        lines = lines.join(broken.select("path"), "path", "left_anti").select("line", "source_file") \
            .unionByName(read_records(spark, src, broken, encoding, names))
    parsed = lines.select("source_file", parse_cells(repair_line(F.col("line"), compat), names).alias("c"))
    return parsed.select("source_file", *[F.col("c")[x].alias(x) for x in names]), facts

"""Workbook report reading: ``binaryFile`` rows decoded by ``mapInPandas``.

One record per workbook file; tasks decode files in parallel and emit rows
``(source_file, source_format, sheet, row_no, cells)`` in bounded batches,
with only the requested cell positions.  All sheets of a workbook are read
(they share one layout) and the first row of each sheet is its header.
"""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import ship_package
from ledgerline.sources.files import SourceError, list_files
from ledgerline.sources.xlsx import Workbook, WorkbookError, sheet_records

ROW_SCHEMA = "source_file string, source_format string, sheet string, row_no int, cells array<string>"
BATCH_ROWS = 20_000
WORKBOOK_SUFFIXES = ("xlsx", "xls")


def _decode(path: str, content: bytes, positions: Sequence[int], only_sheet: int | None = None):
    fmt = path.rsplit(".", 1)[-1].lower()
    name = path.rsplit("/", 1)[-1]
    try:
        book = Workbook(content)
        for i, (sheet, part) in enumerate(book.sheets()):
            if only_sheet is not None and i != only_sheet:
                continue
            for row_no, cells in sheet_records(book, part, positions):
                yield name, fmt, sheet, row_no, cells
    except WorkbookError as e:
        raise WorkbookError(f"{e} (file: {path})") from e


def _has_rows(path: str, content: bytes, positions: Sequence[int]) -> bool:
    """Whether any sheet of a workbook has a data row; asked by the task of its first sheet, if that one is empty."""
    return next(iter(_decode(path, content, positions)), None) is not None


def split_sheets(files: DataFrame) -> DataFrame:
    """One record per sheet: ``(path, content, sheet_index)``.

    Lets a workbook with many sheets be decoded by many tasks (each task gets
    the workbook bytes and decodes one sheet); only ``workbook.xml`` is read
    here.
    """
    ship_package(files.sparkSession)

    def run(batches):
        for pdf in batches:
            out = []
            for path, content in zip(pdf["path"], pdf["content"]):
                try:
                    n = len(Workbook(bytes(content)).sheets())
                except WorkbookError as e:
                    raise WorkbookError(f"{e} (file: {path})") from e
                out.extend((path, content, i) for i in range(n))
            yield pd.DataFrame(out, columns=["path", "content", "sheet_index"])

    return files.select("path", "content").mapInPandas(run, "path string, content binary, sheet_index int")


def decode_workbooks(files: DataFrame, positions: Sequence[int], spread: int | None = None,
                     per_sheet: bool = False) -> DataFrame:
    """``files`` has ``path`` and ``content`` (as from ``binaryFile``).

    Decoding is CPU-bound per file; ``spread`` hash-partitions the file
    records over that many tasks first (one shuffle of the compressed
    bytes), for folders with few files relative to the cores.  With
    ``per_sheet`` the unit of work is one sheet instead of one workbook.
    """
    positions = [int(p) for p in positions]
    ship_package(files.sparkSession)
    if per_sheet:
        files = split_sheets(files)
        if spread:
            files = files.repartition(spread, "path", "sheet_index")
    else:
        files = files.select("path", "content", F.lit(None).cast("int").alias("sheet_index"))
        if spread:
            files = files.repartition(spread, "path")

    def run(batches):
        for pdf in batches:
            for path, content, only in zip(pdf["path"], pdf["content"], pdf["sheet_index"]):
                only = None if only is None or only != only else int(only)
                buf, seen = [], 0
                for rec in _decode(path, bytes(content), positions, only):
                    buf.append(rec)
                    seen += 1
                    if len(buf) >= BATCH_ROWS:
                        yield pd.DataFrame(buf, columns=["source_file", "source_format", "sheet", "row_no", "cells"])
                        buf = []
                if not seen and only is None:
                    raise WorkbookError(f"workbook has no data rows (file: {path})")
                if not seen and only == 0 and not _has_rows(path, bytes(content), positions):
                    raise WorkbookError(f"workbook has no data rows (file: {path})")
                if buf:
                    yield pd.DataFrame(buf, columns=["source_file", "source_format", "sheet", "row_no", "cells"])

    return files.select("path", "content", "sheet_index").mapInPandas(run, ROW_SCHEMA)


def read_workbooks(spark: SparkSession, folder: str, positions: Sequence[int], names: Sequence[str],
                   partitions: int | None = None, per_sheet: bool = False,
                   spread: int | None = None) -> DataFrame:
    """Read every ``.xlsx`` of a folder into named string cells (by position).

    ``.xls`` (BIFF) files are rejected up front: there is no decoder for them.
    ``partitions`` spreads decoded rows over more tasks (one extra shuffle).
    ``per_sheet`` makes a sheet the unit of work (for workbooks with many large
    sheets).  ``spread`` deals the files, or sheets, over that many tasks first.
    A workbook without any data row is an error either way.
    """
    listed = list_files(spark, folder, WORKBOOK_SUFFIXES)
    old = listed.filter(F.col("suffix") == "xls").select("path", "name")
    count, name = old.agg(F.count(F.lit(1)), F.min("name")).first()
    if count:
        raise SourceError(f".xls workbooks are not supported: {count} files, such as {name}", old)
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "*.[xX][lL][sS][xX]")
             .option("recursiveFileLookup", "false").load(folder))
    rows = decode_workbooks(files, positions, spread, per_sheet)
    if partitions:
        rows = rows.repartition(partitions)
    return rows.select("source_file", "source_format", "sheet", "row_no",
                       *[F.get("cells", i).alias(n) for i, n in enumerate(names)])


def _plain(v):
    """pandas/numpy scalars to plain Python values for the writer; NaN/NaT to None."""
    if v is None or v is pd.NaT:
        return None
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime()
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float) and v != v:
        return None
    return v


def workbook_files(df: DataFrame, book_key: str, sheet_key: str, columns: Sequence[str],
                   header: Sequence[str] | None = None, shared: bool = True) -> DataFrame:
    """Write rows of ``df`` into in-memory workbooks, one per ``book_key``
    value and one sheet per ``sheet_key`` value: ``(path, content)`` rows.

    Used to derive workbook fixtures from tables; each group is one file.
    """
    from ledgerline.sources.xlsx import write_workbook

    cols = list(columns)
    head = list(header or cols)
    ship_package(df.sparkSession)

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        book = pdf[book_key].iloc[0]
        sheets = []
        for sheet, part in pdf.sort_values(cols[0]).groupby(sheet_key, sort=True):
            rows = [head]
            for rec in part[cols].itertuples(index=False):
                rows.append([_plain(v) for v in rec])
            sheets.append((f"S{sheet}", rows))
        return pd.DataFrame({"path": [f"book_{book}.xlsx"], "content": [write_workbook(sheets, shared)]})

    # an explicit partition count is kept by AQE (a coalesced shuffle would put
    # all books in one or two tasks); the grouping reuses this partitioning
    spread = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(spread, book_key).groupBy(book_key).applyInPandas(build, "path string, content binary")

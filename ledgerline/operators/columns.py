"""Positional projection: cells known only by position get names."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.text import strip_unicode


class ColumnCountError(ValueError):
    """``files`` holds the offending files as a DataFrame, where there are any."""

    def __init__(self, message: str, files: DataFrame | None = None):
        super().__init__(message)
        self.files = files


def check_column_count(actual: int, expected: int, where: str = "") -> None:
    if actual != expected:
        raise ColumnCountError(
            f"wrong number of columns: {actual}; allowed: {expected}" + (f" ({where})" if where else ""))


def select_positions(df: DataFrame, cells: str, positions: Sequence[int], names: Sequence[str],
                     keep: Sequence[str] = ()) -> DataFrame:
    """Pick cells of an ``array<string>`` column by 0-based position and name them.

    A position past the end of a short row yields null.
    """
    check_column_count(len(positions), len(names))
    arr = F.col(cells)
    picked = [F.get(arr, p).alias(n) for p, n in zip(positions, names)]
    return df.select(*keep, *picked)


def strip_all(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Trim Unicode white space on every (or the given) string column."""
    cols = list(columns) if columns is not None else [
        f.name for f in df.schema.fields if f.dataType.simpleString() == "string"]
    return df.withColumns({c: strip_unicode(F.col(c)) for c in cols})

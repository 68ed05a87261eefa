"""Folder scans by suffix (non-recursive, case-insensitive)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class SourceError(RuntimeError):
    """``files`` holds the offending files as a DataFrame, where there are any."""

    def __init__(self, message: str, files: DataFrame | None = None):
        super().__init__(message)
        self.files = files


def suffix_glob(suffixes: Sequence[str]) -> str:
    """``('csv',)`` -> ``*.[cC][sS][vV]``; several suffixes become ``*.{a,b}``."""
    def ci(s: str) -> str:
        return "".join(f"[{ch.lower()}{ch.upper()}]" if ch.isalpha() else ch for ch in s.lstrip("."))
    parts = [ci(s) for s in suffixes]
    return "*." + (parts[0] if len(parts) == 1 else "{" + ",".join(parts) + "}")


def list_files(spark: SparkSession, folder: str, suffixes: Sequence[str]) -> DataFrame:
    """Files of a folder with the given suffixes, as ``(path, name, suffix, length)``.

    Only file metadata is read (the content column is pruned).  A missing
    folder or a folder without matching files is an error.
    """
    try:
        df = (spark.read.format("binaryFile").option("pathGlobFilter", suffix_glob(suffixes))
              .option("recursiveFileLookup", "false").load(folder))
    except AnalysisException as e:
        if (e.getCondition() or "").split(".")[0] != "PATH_NOT_FOUND":
            raise
        raise SourceError(f"folder not found: {folder}") from e
    out = df.select(
        "path", F.regexp_extract("path", r"([^/]*)$", 1).alias("name"),
        F.lower(F.regexp_extract("path", r"\.([^./]*)$", 1)).alias("suffix"), "length")
    if out.isEmpty():
        raise SourceError(f"no {'/'.join(suffixes)} files in folder: {folder}")
    return out

"""Cut-off filter, de-duplication, audit aggregates and preview."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerline.functions.dates import format_dmy
from ledgerline.session import scratch_path

#: Repeated fingerprints that are sent to every task, at 16 bytes each.
FINGERPRINT_BROADCAST = 1_000_000


def _day(c: Column | str) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast("date")


def keep_until(df: DataFrame, date_column: str, cutoff: _dt.date) -> DataFrame:
    """Rows whose date is on or before the cut-off.  Null dates are removed too."""
    return df.filter(_day(date_column) <= F.lit(cutoff))


def pre_cutoff_metrics(date_column: str, cutoff: _dt.date) -> list[Column]:
    """Aggregates over every parsed row, before the cut-off filter."""
    d = _day(date_column)
    return [
        F.count(F.lit(1)).alias("n_in"),
        F.max(d).alias("last_date"),
        F.count_if(d <= F.lit(cutoff)).alias("n_kept"),
        F.count_if(d > F.lit(cutoff)).alias("excluded"),
        F.count_if(d.isNull()).alias("null_date_rows"),
    ]


def post_dedupe_metrics(date_column: str) -> list[Column]:
    return [F.count(F.lit(1)).alias("n_out"), F.min(_day(date_column)).alias("first_date")]


def dedupe(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Full-row de-duplication (nulls compare equal); order is not kept."""
    return df.dropDuplicates(columns) if columns else df.dropDuplicates()


def dedupe_stored(df: DataFrame, broadcast_limit: int = FINGERPRINT_BROADCAST) -> DataFrame:
    """The rows of ``dedupe``, where only rows that may have a copy are shuffled.

    A first pass counts 128-bit fingerprints (two 64-bit hashes of the row) and
    writes those that occur more than once to the shared folder.  Rows with any
    other fingerprint have no copy and stay where they are; the rest are compared
    in full, so rows of equal fingerprint that differ both stay.  Beyond
    ``broadcast_limit`` repeated fingerprints, every row meets its equals in the
    one shuffle of ``dedupe``.

    ``df`` is read three times, so it must be a stored table, or otherwise give the
    same rows at every read and be cheap to read.  Nulls compare equal; an empty
    frame gives no rows.
    """
    spark = df.sparkSession
    taken = {c.lower() for c in df.columns}
    a, b = (next(n for n in (f"{mark}{'_' * k}" for k in range(len(taken) + 1)) if n not in taken)
            for mark in ("mark_a", "mark_b"))
    cells = [F.col("`" + c.replace("`", "``") + "`") for c in df.columns]
    marked = df.select(*cells, F.xxhash64(*cells).alias(a), F.xxhash64(F.lit(1), *cells).alias(b))
    path = scratch_path(spark, "repeated-fingerprints")
    marked.groupBy(a, b).agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(a, b) \
        .write.mode("overwrite").parquet(path)
    repeated = spark.read.schema(marked.select(a, b).schema).parquet(path)
    if repeated.count() > broadcast_limit:
        return dedupe(df)
    alone = marked.join(F.broadcast(repeated), [a, b], "left_anti").select(*cells)
    copies = marked.join(F.broadcast(repeated), [a, b], "left_semi").select(*cells)
    return alone.unionByName(dedupe(copies))


def audit_frame(parsed: DataFrame, loaded: DataFrame, report: str, date_column: str,
                cutoff: _dt.date) -> DataFrame:
    """One-row audit from the parsed (pre cut-off) and loaded (final) frames.

    Both sides are global aggregates (partial per task, one tiny final
    merge); they are combined by a union and a second aggregate, not a join.
    """
    pre = parsed.agg(*pre_cutoff_metrics(date_column, cutoff)).select(
        "n_in", "last_date", "excluded", "null_date_rows",
        F.lit(None).cast("bigint").alias("n_out"), F.lit(None).cast("date").alias("first_date"))
    post = loaded.agg(*post_dedupe_metrics(date_column)).select(
        F.lit(None).cast("bigint").alias("n_in"), F.lit(None).cast("date").alias("last_date"),
        F.lit(None).cast("bigint").alias("excluded"), F.lit(None).cast("bigint").alias("null_date_rows"),
        "n_out", "first_date")
    both = pre.unionByName(post).agg(*[F.max(c).alias(c) for c in pre.columns])
    return both.select(
        F.lit(report).alias("report"),
        F.coalesce("n_in", F.lit(0)).cast("bigint").alias("n_in"),
        F.coalesce("n_out", F.lit(0)).cast("bigint").alias("n_out"),
        F.coalesce("excluded", F.lit(0)).cast("bigint").alias("excluded"),
        F.coalesce("null_date_rows", F.lit(0)).cast("bigint").alias("null_date_rows"),
        "first_date", "last_date",
        format_dmy("first_date").alias("first_date_text"),
        format_dmy("last_date").alias("last_date_text"),
        F.when(F.col("excluded") > 0, F.lit("warn")).otherwise(F.lit("info")).alias("level"),
    )


def newest(df: DataFrame, date_column: str, columns: list[str], n: int = 20,
           tie_breakers: list[str] | None = None) -> DataFrame:
    """The ``n`` newest rows (a top-k report; Spark plans TakeOrderedAndProject)."""
    order = [F.col(date_column).desc()] + [F.col(c).asc_nulls_last() for c in (tie_breakers or columns)]
    return df.select(*columns).orderBy(*order).limit(n)


def audit_one_scan(parsed: DataFrame, report: str, date_column: str, cutoff: _dt.date,
                   columns: list[str]) -> DataFrame:
    """The same one-row audit as ``audit_frame`` from a single scan of ``parsed``.

    All parsed rows are grouped by the output ``columns`` (which include the
    date column); that grouping is the de-duplication, and one global
    aggregate over the groups gives both the pre-cut-off counts (sums of the
    group sizes) and the post-de-duplication ones (the kept groups).
    """
    groups = parsed.groupBy(*columns).agg(F.count(F.lit(1)).alias("__n"))
    d = _day(date_column)
    n = F.col("__n")
    kept = d <= F.lit(cutoff)
    out = groups.agg(
        F.sum(n).cast("bigint").alias("n_in"),
        F.count_if(kept).cast("bigint").alias("n_out"),
        F.sum(F.when(d > F.lit(cutoff), n).otherwise(F.lit(0))).cast("bigint").alias("excluded"),
        F.sum(F.when(d.isNull(), n).otherwise(F.lit(0))).cast("bigint").alias("null_date_rows"),
        F.min(F.when(kept, d)).alias("first_date"),
        F.max(d).alias("last_date"),
    )
    return out.select(
        F.lit(report).alias("report"),
        F.coalesce("n_in", F.lit(0)).cast("bigint").alias("n_in"), "n_out",
        F.coalesce("excluded", F.lit(0)).cast("bigint").alias("excluded"),
        F.coalesce("null_date_rows", F.lit(0)).cast("bigint").alias("null_date_rows"),
        "first_date", "last_date",
        format_dmy("first_date").alias("first_date_text"),
        format_dmy("last_date").alias("last_date_text"),
        F.when(F.col("excluded") > 0, F.lit("warn")).otherwise(F.lit("info")).alias("level"),
    )

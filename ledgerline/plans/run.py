"""Top-level report loads: one call per report, or several in order.

``load_report`` picks the reader from the folder's files (``.xlsx``
workbooks by position, or CSV reports), applies the report's transforms and
publishes with the guard.  ``load_reports`` runs SD then OS and stops after
the first failure.  ``python -m ledgerline.plans.run`` is the same from a shell.
"""

from __future__ import annotations

import argparse
import datetime as _dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.plans.reports import LoadContext, os_parsed, sd_text_parsed, sd_workbook_parsed
from ledgerline.sinks.publish import LoadError, LoadResult, publish, run_reports
from ledgerline.sinks.targets import JdbcTarget, ParquetTarget
from ledgerline.sources.csv_text import read_report_csv
from ledgerline.sources.files import list_files
from ledgerline.sources.workbooks import read_workbooks
from ledgerline.spec import SPECS


def _source_kind(spark: SparkSession, folder: str) -> str:
    suffixes = {r.suffix for r in list_files(spark, folder, ("xlsx", "xls", "csv")).select("suffix")
                .distinct().collect()}
    if suffixes <= {"csv"}:
        return "csv"
    if "csv" in suffixes:
        raise ValueError(f"folder mixes CSV and workbook reports: {folder}")
    return "xlsx"


def parsed_report(spark: SparkSession, report: str, folder: str, ctx: LoadContext,
                  source: str = "auto", encoding: str = "auto", compat: bool = False,
                  per_sheet: bool = False, on_bad: str = "fail") -> tuple[DataFrame, str]:
    """Parsed (pre cut-off) rows of one report folder, and the read mode.

    ``encoding`` goes to the CSV reader; ``per_sheet`` to the workbook reader."""
    spec = SPECS[report]
    kind = _source_kind(spark, folder) if source == "auto" else source
    if kind == "csv":
        names = spec.raw_names
        cells, facts = read_report_csv(spark, folder, names, encoding=encoding, compat=compat)
        keep = ("source_file",) if on_bad == "quarantine" else ()
        parse = sd_text_parsed if report == "SD" else os_parsed
        return parse(cells, ctx, keep=keep, on_bad=on_bad), facts["read_mode"]
    if on_bad != "fail":
        raise ValueError("rows of workbooks are not set aside; load them with on_bad='fail'")
    cells = read_workbooks(spark, folder, spec.positions, spec.raw_names, per_sheet=per_sheet)
    if report == "SD":
        return sd_workbook_parsed(cells, ctx, F.col("source_format"), compat=compat), "workbook"
    return os_parsed(cells, ctx), "workbook"


def load_report(spark: SparkSession, report: str, folder: str, cutoff, target, guard: str = "fail",
                source: str = "auto", load_ts: _dt.datetime | None = None, load_user: str | None = None,
                encoding: str = "auto", compat: bool = False,
                per_sheet: bool = False, quarantine: str | None = None) -> LoadResult:
    """Load one report folder; bad rows of CSV reports go to the folder ``quarantine``, if there is one, and else fail the load."""
    ctx = LoadContext.of(cutoff, load_ts, load_user)
    on_bad = "fail" if quarantine is None else "quarantine"
    parsed, mode = parsed_report(spark, report, folder, ctx, source, encoding, compat, per_sheet, on_bad)
    return publish(spark, parsed, SPECS[report], ctx, target, guard=guard, read_mode=mode, quarantine=quarantine)


def load_reports(spark: SparkSession, jobs: Sequence[tuple[str, str, object]], cutoff, guard: str = "fail",
                 **kw) -> list[dict]:
    """``jobs``: (report, folder, target) in order, e.g. SD then OS.  One run
    stamp for all of them; the first failure stops the rest."""
    ctx = LoadContext.of(cutoff, kw.pop("load_ts", None), kw.pop("load_user", None))
    return run_reports([
        (report, (lambda r=report, f=folder, t=target: load_report(
            spark, r, f, ctx.cutoff, t, guard, load_ts=ctx.load_ts, load_user=ctx.load_user, **kw)))
        for report, folder, target in jobs])


def main(argv: Sequence[str] | None = None) -> int:
    from ledgerline.session import build_session

    p = argparse.ArgumentParser(description="Load SD/OS report folders into Parquet or JDBC tables.")
    p.add_argument("--sd", help="SD report folder")
    p.add_argument("--os", help="OS report folder")
    p.add_argument("--cutoff", required=True, help="cut-off date DD-MM-YYYY")
    to = p.add_mutually_exclusive_group(required=True)
    to.add_argument("--target-dir", help="folder holding DATA_SD / DATA_OS tables")
    to.add_argument("--jdbc-url", help="database holding the tables instead")
    p.add_argument("--jdbc-table", default="{}.DATA_{}", help="table name, filled with the schema and the report")
    p.add_argument("--jdbc-schema", default="CLI")
    p.add_argument("--jdbc-property", action="append", default=[], metavar="KEY=VALUE", help="connection property; repeatable")
    p.add_argument("--jdbc-connections", type=int, default=5, help="parallel connections of the append")
    p.add_argument("--guard", default="fail", choices=["fail", "skip", "append"])
    a = p.parse_args(argv)
    spark = build_session()
    if a.jdbc_url:
        props = dict(x.split("=", 1) for x in a.jdbc_property)
        target = lambda r: JdbcTarget(a.jdbc_url, a.jdbc_table.format(a.jdbc_schema, r), props, a.jdbc_connections)
    else:
        target = lambda r: ParquetTarget(f"{a.target_dir.rstrip('/')}/DATA_{r}")
    jobs = [(r, f, target(r)) for r, f in (("SD", a.sd), ("OS", a.os)) if f]
    try:
        audits, code = load_reports(spark, jobs, a.cutoff, a.guard), 0
    except LoadError as e:
        audits, code = e.audits, 1
    print(json.dumps(audits, default=str))
    return code


if __name__ == "__main__":
    raise SystemExit(main())

"""Consolidate, audit and append one report, in one pass over the input.

1. The already-loaded guard compares the target's last load date with the
   run date: ``fail`` raises, ``skip`` stops without reading anything,
   ``append`` goes on.
2. The final rows are written once to a staging table in the shared folder
   (``spark.checkpoint.dir``).  Two Observations ride on that write: one
   before the cut-off (rows in, kept, last date, excluded, null dates) and one
   after de-duplication (rows out, first date).  Strict parse errors surface
   here, before anything reaches the target.
3. The counts are checked against the staged table and against each other; when
   the observed part of the plan was replaced at run time (adaptive execution
   does so over an empty stage), or a re-run task was counted twice, they are
   computed from the rows instead.
4. The target takes over the staged table: it asks the guard again, with the
   version that the new one will follow, and publishes the load as a whole.  Of
   two runs that both passed the first check, one loads and the other is refused
   or skipped.  No staged table is left behind, whatever the outcome.

Only the one-row audit (and per-file facts) reach the driver.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ledgerline.operators.cutoff import newest, post_dedupe_metrics, pre_cutoff_metrics
from ledgerline.plans.reports import LoadContext, finish, finish_split
from ledgerline.session import scratch_path
from ledgerline.sinks.targets import LoadFacts, remove
from ledgerline.spec import ReportSpec

AUDIT_DDL = ("report string, n_in bigint, n_out bigint, excluded bigint, null_date_rows bigint, "
             "first_date date, last_date date, read_mode string, status string, elapsed_s bigint")


class LoadError(RuntimeError):
    """``audits`` holds the outcome of every report of the run, where there is one."""

    def __init__(self, message: str, audits: list[dict] | None = None):
        super().__init__(message)
        self.audits = audits or []


class AlreadyLoaded(LoadError):
    pass


@dataclass
class LoadResult:
    audit: dict
    target: object
    load_ts: _dt.datetime

    def audit_frame(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame([self.audit], AUDIT_DDL)

    def loaded(self, spark: SparkSession) -> DataFrame:
        """The rows of this load, from the target."""
        return self.target.read_load(spark, self.load_ts)

    def schema_frame(self, spark: SparkSession) -> DataFrame:
        """The loaded table's resolved schema as rows (position, column, type)."""
        fields = self.loaded(spark).schema.fields
        return spark.createDataFrame([(i, f.name, f.dataType.simpleString()) for i, f in enumerate(fields)],
                                     "position int, column string, type string")

    def preview(self, spark: SparkSession, spec: ReportSpec, n: int = 20) -> DataFrame:
        """Newest rows of the load (top-k, no full sort)."""
        return newest(self.loaded(spark), spec.date_column, list(spec.preview), n)


def _observed(obs: Observation) -> dict:
    """Observed metrics, or {} when the observed part of the plan never ran; the counts then come from the rows."""
    try:
        return dict(obs.get)
    except (PySparkException, Py4JJavaError):
        return {}


def checked_metrics(parsed: DataFrame, written: DataFrame, spec: ReportSpec, ctx: LoadContext,
                    observed_in: dict, observed_out: dict) -> dict:
    """Audit counts that agree with the written table.

    Observed counts are taken when they are there, add up, and match what was
    written; else both sides are aggregated from the rows.
    """
    n_out = written.count()  # from the file footers
    m = observed_in | observed_out
    sound = m.get("n_in") is not None and m.get("n_out") == n_out \
        and m["n_in"] == m["n_kept"] + m["excluded"] + m["null_date_rows"] and m["n_kept"] >= n_out
    if not sound:
        m = parsed.agg(*pre_cutoff_metrics(spec.date_column, ctx.cutoff)).first().asDict() \
            | written.agg(*post_dedupe_metrics(spec.date_column)).first().asDict()
    return {k: m[k] for k in ("n_in", "n_out", "excluded", "null_date_rows", "first_date", "last_date")}


GUARDS = ("fail", "skip", "append")


def _refused(spec: ReportSpec, last: _dt.date, guard: str) -> None:
    """A load of the run date is there: an error under ``fail``."""
    if guard == "fail":
        raise AlreadyLoaded(f"report {spec.name} was already loaded on {last:%d-%m-%Y}")


def publish(spark: SparkSession, parsed: DataFrame, spec: ReportSpec, ctx: LoadContext, target,
            guard: str = "fail", on_empty: str = "fail", read_mode: str = "plain",
            run_date: _dt.date | None = None, quarantine: str | None = None) -> LoadResult:
    """Load one report.  ``quarantine`` is a folder for the bad rows of a frame parsed with ``on_bad="quarantine"``: good
    and bad rows are split by one write, and the load's bad rows go to ``<quarantine>/load=<stamp>-<id>``, with file,
    fault, raw cells and number of copies.  The audit then has ``quarantined``, and adds up:
    ``n_in = rows kept with their copies + excluded + null_date_rows + quarantined``."""
    if guard not in GUARDS:
        raise ValueError(f"guard must be one of {GUARDS}")
    t0 = time.time()
    today = run_date or ctx.load_ts.date()
    audit = {"report": spec.name, "n_in": None, "n_out": None, "excluded": None, "null_date_rows": None,
             "first_date": None, "last_date": None, "read_mode": read_mode, "status": "skipped", "elapsed_s": 0}
    seen = []

    def allowed(last: _dt.date) -> bool:
        seen.append(last)
        return last < today or guard == "append"

    if not allowed(target.last_load_date(spark)):
        _refused(spec, seen[-1], guard)
        return LoadResult(audit, target, ctx.load_ts)
    if quarantine is not None:
        return _publish_split(spark, parsed, spec, ctx, target, guard, on_empty, audit, allowed, seen, quarantine, t0)
    obs_in = Observation(f"{spec.name.lower()}_in")
    obs_out = Observation(f"{spec.name.lower()}_out")
    loaded = finish(parsed, spec, ctx, observation=obs_in)
    loaded = loaded.observe(obs_out, *post_dedupe_metrics(spec.date_column))
    staged_path = scratch_path(spark, f"stage-{spec.name.lower()}")
    try:
        loaded.write.mode("overwrite").parquet(staged_path)
        written = spark.read.schema(loaded.schema).parquet(staged_path)
        audit |= checked_metrics(parsed, written, spec, ctx, _observed(obs_in), _observed(obs_out))
        if audit["n_out"] == 0 and on_empty == "fail":
            raise LoadError(f"report {spec.name}: no rows on or before the cut-off {ctx.cutoff:%d-%m-%Y}")
        facts = LoadFacts(ctx.load_ts, audit["n_out"], audit["first_date"], audit["last_date"])
        if target.take_over(spark, staged_path, facts, allowed):
            audit["status"] = "loaded"
        else:
            _refused(spec, seen[-1], guard)
    finally:
        remove(spark, staged_path)
    audit["elapsed_s"] = int(time.time() - t0)
    return LoadResult(audit, target, ctx.load_ts)


def split_metrics(written: DataFrame) -> dict:
    """Audit counts from the split table: sums of the copies that were written, no second parse."""
    of = lambda part: F.coalesce(F.sum(F.when(F.col("part") == part, F.col("copies"))), F.lit(0))
    good = F.col("part") == "good"
    return written.agg(
        F.coalesce(F.sum("copies"), F.lit(0)).alias("n_in"), F.count_if(good).alias("n_out"), of("late").alias("excluded"),
        of("undated").alias("null_date_rows"), of("bad").alias("quarantined"),
        F.min(F.when(good, F.col("day"))).alias("first_date"), F.max("day").alias("last_date")).first().asDict()


def _publish_split(spark, parsed, spec, ctx, target, guard, on_empty, audit, allowed, seen, quarantine, t0) -> LoadResult:
    staged_path, good_path = (scratch_path(spark, f"stage-{spec.name.lower()}") for _ in range(2))
    try:
        split = finish_split(parsed, spec, ctx)
        split.write.partitionBy("part").parquet(staged_path)
        written = spark.read.schema(split.schema).parquet(staged_path)
        audit |= split_metrics(written)
        if audit["n_out"] == 0 and on_empty == "fail":
            raise LoadError(f"report {spec.name}: no rows on or before the cut-off {ctx.cutoff:%d-%m-%Y}")
        written.where("part = 'good'").select(*spec.output_names).write.parquet(good_path)
        facts = LoadFacts(ctx.load_ts, audit["n_out"], audit["first_date"], audit["last_date"])
        if target.take_over(spark, good_path, facts, allowed):
            audit["status"] = "loaded"
            if audit["quarantined"]:
                to = f"{quarantine.rstrip('/')}/load={ctx.load_ts:%Y%m%dT%H%M%S}-{uuid.uuid4().hex[:8]}"
                written.where("part = 'bad'").select("source_file", "fault", "raw", "copies").write.parquet(to)
        else:
            _refused(spec, seen[-1], guard)
    finally:
        remove(spark, staged_path)
        remove(spark, good_path)
    audit["elapsed_s"] = int(time.time() - t0)
    return LoadResult(audit, target, ctx.load_ts)


def run_reports(jobs) -> list[dict]:
    """Run report loads in order (e.g. SD then OS); a failure stops the rest.

    ``jobs`` is a sequence of ``(name, callable -> LoadResult)``.  Returns one
    audit dict per report.  On a failure the raised :class:`LoadError` carries
    them in ``audits``, with ``status='failed: ...'`` and ``'not run'``.
    """
    out, failed = [], None
    for name, job in jobs:
        if failed is not None:
            out.append({"report": name, "status": "not run"})
            continue
        try:
            out.append(job().audit)
        except Exception as e:  # noqa: BLE001 - recorded, then re-raised below
            failed = e
            out.append({"report": name, "status": f"failed: {e}"})
    if failed is not None:
        raise LoadError(f"load stopped: {failed}", out) from failed
    return out


def status_frame(spark: SparkSession, audits: list[dict]) -> DataFrame:
    """Per-report outcome as rows; reports that failed or did not run have their status only."""
    names = [f.split()[0] for f in AUDIT_DDL.split(", ")]
    return spark.createDataFrame([tuple(a.get(n) for n in names) for a in audits], AUDIT_DDL)


def audit_text(audit: dict) -> list[str]:
    """Report lines of an audit (dates as DD-MM-YYYY)."""
    fmt = lambda d: d.strftime("%d-%m-%Y") if d else "-"
    lines = [f"first date {audit['report']}: {fmt(audit.get('first_date'))}",
             f"last date {audit['report']}: {fmt(audit.get('last_date'))}"]
    if audit.get("excluded"):
        lines.append(f"rows excluded {audit['report']}: {audit['excluded']}")
    secs = int(audit.get("elapsed_s") or 0)
    lines.append(f"elapsed: {secs // 60} min, {secs % 60} s")
    return lines


__all__ = ["publish", "run_reports", "status_frame", "LoadResult", "LoadError", "AlreadyLoaded", "AUDIT_DDL", "audit_text"]

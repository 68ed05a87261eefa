"""Staged load, audit, guard and target append (Parquet target)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerline.operators.cutoff import audit_frame, keep_until
from ledgerline.plans import raw_views as rv
from ledgerline.plans.reports import LoadContext, finish, sd_text_parsed
from ledgerline.sinks.publish import AlreadyLoaded, LoadError, publish, run_reports
from ledgerline.sinks.targets import EMPTY_TARGET_DATE, ParquetTarget
from ledgerline.spec import SD_SPEC

SF = "/root/testdata/sf0.001"
CTX = LoadContext(dt.date(2000, 1, 1), dt.datetime(2024, 6, 30, 12, 0, 0), "etl-host/loader")


def test_cutoff_golden(spark):
    dates = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 2, 1), None]
    df = spark.createDataFrame([(d,) for d in dates], "d date")
    cutoff = dt.date(2024, 1, 31)
    kept = keep_until(df, "d", cutoff)
    assert kept.count() == 2
    a = audit_frame(df, kept, "X", "d", cutoff).first()
    assert (a.n_in, a.n_out, a.excluded, a.null_date_rows) == (4, 2, 1, 1)
    assert (a.first_date, a.last_date) == (dt.date(2024, 1, 30), dt.date(2024, 2, 1))
    assert (a.first_date_text, a.last_date_text, a.level) == ("30-01-2024", "01-02-2024", "warn")


def test_publish_one_pass_audit_and_guard(spark, scratch):
    target = ParquetTarget(f"{scratch}/DATA_SD")
    assert target.last_load_date(spark) == EMPTY_TARGET_DATE
    parsed = sd_text_parsed(rv.sd_raw(spark, SF), CTX)
    res = publish(spark, parsed, SD_SPEC, CTX, target)
    a = res.audit
    want = audit_frame(parsed, finish(parsed, SD_SPEC, CTX), "SD", "FECHA_REG", CTX.cutoff).first()
    assert (a["n_in"], a["n_out"], a["excluded"], a["null_date_rows"]) == (
        want.n_in, want.n_out, want.excluded, want.null_date_rows)
    assert (a["first_date"], a["last_date"]) == (want.first_date, want.last_date)
    assert a["n_in"] == a["excluded"] + a["null_date_rows"] + parsed.filter(
        F.col("FECHA_REG").cast("date") <= CTX.cutoff).count()
    assert a["status"] == "loaded"
    assert target.read(spark).count() == a["n_out"]
    assert target.read(spark).schema.simpleString() == finish(parsed, SD_SPEC, CTX).schema.simpleString()
    assert target.last_load_date(spark) == CTX.load_ts.date()
    prev = res.preview(spark, SD_SPEC).collect()
    assert len(prev) == 20 and prev[0].FECHA_REG >= prev[-1].FECHA_REG
    assert res.audit_frame(spark).count() == 1
    sch = res.schema_frame(spark).orderBy("position").collect()
    assert [r.column for r in sch] == SD_SPEC.output_names
    assert {r.column: r.type for r in sch}["FECHA_REG"] == "timestamp_ntz"

    with pytest.raises(AlreadyLoaded):
        publish(spark, parsed, SD_SPEC, CTX, target, guard="fail")
    assert publish(spark, parsed, SD_SPEC, CTX, target, guard="skip").audit["status"] == "skipped"
    assert target.read(spark).count() == a["n_out"]
    publish(spark, parsed, SD_SPEC, CTX, target, guard="append")
    assert target.read(spark).count() == 2 * a["n_out"]


def test_same_load_ts_same_rows(spark):
    parsed = sd_text_parsed(rv.sd_raw(spark, SF), CTX)
    a = finish(parsed, SD_SPEC, CTX)
    b = finish(sd_text_parsed(rv.sd_raw(spark, SF).repartition(5), CTX), SD_SPEC, CTX)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_empty_after_cutoff_fails(spark, scratch):
    ctx = LoadContext(dt.date(1900, 1, 1), CTX.load_ts, CTX.load_user)
    parsed = sd_text_parsed(rv.sd_raw(spark, SF), ctx)
    with pytest.raises(LoadError):
        publish(spark, parsed, SD_SPEC, ctx, ParquetTarget(f"{scratch}/T"))


def test_strict_error_surfaces_before_append(spark, scratch):
    raw = rv.sd_raw(spark, SF).withColumn(
        "FECHA_REG", F.when(F.col("row_id") == 1, F.lit("31/02/1999")).otherwise(F.col("FECHA_REG")))
    target = ParquetTarget(f"{scratch}/T")
    with pytest.raises(Exception):
        publish(spark, sd_text_parsed(raw, CTX), SD_SPEC, CTX, target)
    assert target.read(spark) is None


def test_run_reports_stops_after_failure():
    class Done:
        audit = {"report": "SD", "status": "loaded"}

    ran = []

    def boom():
        raise RuntimeError("x")
    with pytest.raises(LoadError) as e:
        run_reports([("SD", Done), ("OS", boom), ("OS2", lambda: ran.append(1))])
    assert not ran
    assert e.value.audits == [{"report": "SD", "status": "loaded"}, {"report": "OS", "status": "failed: x"},
                              {"report": "OS2", "status": "not run"}]


def stages(spark):
    import os

    from ledgerline.session import shared_dir
    base = shared_dir(spark).removeprefix("file:")
    return {d for d in os.listdir(base) if d.startswith("stage-")} if os.path.isdir(base) else set()


def test_no_stage_remains_and_failures_leave_the_target(spark, scratch):
    before, target = stages(spark), ParquetTarget(f"{scratch}/T")
    parsed = sd_text_parsed(rv.sd_raw(spark, SF), CTX)
    n = publish(spark, parsed, SD_SPEC, CTX, target).audit["n_out"]
    bad = rv.sd_raw(spark, SF).withColumn("FECHA_REG", F.lit("31/02/1999"))
    later = LoadContext(CTX.cutoff, CTX.load_ts + dt.timedelta(days=1), CTX.load_user)
    with pytest.raises(Exception, match="31/02/1999"):
        publish(spark, sd_text_parsed(bad, later), SD_SPEC, later, target)
    none = LoadContext(dt.date(1900, 1, 1), later.load_ts, CTX.load_user)
    with pytest.raises(LoadError, match="no rows"):
        publish(spark, sd_text_parsed(rv.sd_raw(spark, SF), none), SD_SPEC, none, target)
    assert target.read(spark).count() == n and stages(spark) == before


def test_audit_is_true_when_every_row_is_excluded(spark, scratch):
    ctx = LoadContext(dt.date(1980, 1, 1), CTX.load_ts, CTX.load_user)
    parsed = sd_text_parsed(rv.sd_raw(spark, SF), ctx)
    a = publish(spark, parsed, SD_SPEC, ctx, ParquetTarget(f"{scratch}/T"), on_empty="ok").audit
    want = audit_frame(parsed, finish(parsed, SD_SPEC, ctx), "SD", "FECHA_REG", ctx.cutoff).first()
    assert (a["n_in"], a["n_out"], a["excluded"], a["null_date_rows"], a["last_date"]) == (
        want.n_in, 0, want.excluded, want.null_date_rows, want.last_date)
    assert a["n_in"] > 0 and a["last_date"] is not None


def test_guard_is_checked_before_anything_is_read(spark, scratch):
    target = ParquetTarget(f"{scratch}/T")
    publish(spark, sd_text_parsed(rv.sd_raw(spark, SF), CTX), SD_SPEC, CTX, target)
    bad = sd_text_parsed(rv.sd_raw(spark, SF).withColumn("FECHA_REG", F.lit("31/02/1999")), CTX)
    assert publish(spark, bad, SD_SPEC, CTX, target, guard="skip").audit["status"] == "skipped"
    with pytest.raises(AlreadyLoaded):
        publish(spark, bad, SD_SPEC, CTX, target)


def test_only_a_missing_table_counts_as_none(spark, scratch):
    import os
    os.makedirs(f"{scratch}/T")
    assert ParquetTarget(f"{scratch}/T").read(spark) is None
    with open(f"{scratch}/T/part-0.parquet", "w") as f:
        f.write("not parquet")
    with pytest.raises(Exception):
        ParquetTarget(f"{scratch}/T").last_load_date(spark)


def test_a_cluster_needs_a_shared_folder():
    from types import SimpleNamespace as N

    from ledgerline.session import shared_dir
    none = N(conf=N(get=lambda k, d=None: d), sparkContext=N(getCheckpointDir=lambda: None, master="spark://host:7077"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(none)


def test_audit_text():
    from ledgerline.sinks.publish import audit_text
    a = {"report": "SD", "first_date": dt.date(2024, 1, 30), "last_date": dt.date(2024, 2, 1), "excluded": 3,
         "elapsed_s": 125}
    assert audit_text(a) == ["first date SD: 30-01-2024", "last date SD: 01-02-2024", "rows excluded SD: 3",
                             "elapsed: 2 min, 5 s"]
    assert audit_text({"report": "OS", "excluded": 0})[-1] == "elapsed: 0 min, 0 s"


def test_one_scan_audit_equals_two_pass(spark):
    from ledgerline.operators.cutoff import audit_one_scan

    dates = [dt.date(2024, 1, 30), dt.date(2024, 1, 31), dt.date(2024, 1, 31), dt.date(2024, 2, 1), None]
    df = spark.createDataFrame([(d, "x") for d in dates], "d date, v string")
    cutoff = dt.date(2024, 1, 31)
    two = audit_frame(df, keep_until(df, "d", cutoff).dropDuplicates(), "X", "d", cutoff).first()
    one = audit_one_scan(df, "X", "d", cutoff, ["d", "v"]).first()
    assert one == two
    parsed = sd_text_parsed(rv.sd_raw(spark, SF), CTX)
    body = [c for c in SD_SPEC.output_names if c not in ("FECHA_DATA", "USUARIO_DATA")]
    assert (audit_one_scan(parsed, "SD", "FECHA_REG", CTX.cutoff, body).first()
            == audit_frame(parsed, finish(parsed, SD_SPEC, CTX), "SD", "FECHA_REG", CTX.cutoff).first())


def test_quarantine_sets_bad_rows_aside(spark, scratch):
    from ledgerline.plans.run import load_report
    import os
    row = "DNI,{n},ANA PAZ,01/01/1980,P,{d},WEB,PERU,VIDA,77,BK SUR,06/01/2024,,U1,08/01/2024\n"
    os.makedirs(f"{scratch}/in")
    with open(f"{scratch}/in/a.csv", "w") as f:
        f.write(",".join(SD_SPEC.raw_names) + "\n" + row.format(n=1, d="05/01/1999") * 2 + row.format(n=2, d="99/99/1999") * 2
                + row.format(n=3, d="soon") + row.format(n=4, d="05/01/2024") + row.format(n=5, d=""))
    with open(f"{scratch}/in/b.csv", "w") as f:
        f.write(",".join(SD_SPEC.raw_names) + "\n" + row.format(n=2, d="99/99/1999"))
    target = ParquetTarget(f"{scratch}/T")
    a = load_report(spark, "SD", f"{scratch}/in", "01-01-2000", target, load_ts=CTX.load_ts, quarantine=f"{scratch}/bad").audit
    assert {k: a[k] for k in ("status", "n_in", "n_out", "excluded", "null_date_rows", "quarantined")} == {
        "status": "loaded", "n_in": 8, "n_out": 1, "excluded": 1, "null_date_rows": 1, "quarantined": 4}
    assert (a["first_date"], a["last_date"]) == (dt.date(1999, 1, 5), dt.date(2024, 1, 5))
    bad = spark.read.parquet(f"{scratch}/bad").collect()
    assert sorted((r.source_file, r.copies, r.fault) for r in bad) == [
        ("a.csv", 1, "FECHA_REG is no date"), ("a.csv", 2, "FECHA_REG is no date"), ("b.csv", 1, "FECHA_REG is no date")]
    assert all('"NRO_DOC"' in r.raw for r in bad) and target.read(spark).columns == SD_SPEC.output_names
    with pytest.raises(Exception):
        load_report(spark, "SD", f"{scratch}/in", "01-01-2000", ParquetTarget(f"{scratch}/T2"), load_ts=CTX.load_ts)

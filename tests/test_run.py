"""Top-level loads: folder in, guarded Parquet table out."""

import datetime as dt
import os

import pytest

from ledgerline.plans.run import load_report, load_reports
from ledgerline.sinks.publish import LoadError
from ledgerline.sinks.targets import ParquetTarget
from ledgerline.sources.xlsx import write_workbook
from ledgerline.spec import OS_SPEC, SD_SPEC

TS = dt.datetime(2024, 6, 30, 12)


def sd_workbook_rows(n):
    head = ["TIPO_DOCUMENTO", "PID", "NOMBRE", "AP_PATERNO", "AP_MATERNO", "RAZON_SOCIAL", "F_NACIMIENTO",
            "TIPO_ENTIDAD", "F_REGISTRO", "FUENTE_DATO", "NACIONALIDAD", "NOM_REL", "AGEN_FAMIL", "NOMBRE_BK",
            "VALIDO_DESDE", "VALIDO_HASTA", "USU", "REGISTRATION_DATE"]
    rows = [head]
    for i in range(n):
        rows.append(["RUC 20" if i % 2 else "DNI", f"{i:011d}", "A", "B", "C", f" Cliente {i} ",
                     dt.datetime(1980, 1, 1 + i % 28), "P", dt.datetime(2024, 1, 1 + i % 31, 9, 30),
                     "WEB", "PERU", "VIDA", 77, "BK SUR", dt.datetime(2024, 1, 1), None if i % 3 else "2025-01-01",
                     "U1", dt.datetime(2024, 1, 2)])
    return rows


def test_load_report_workbooks_then_guard(spark, scratch):
    src = f"{scratch}/sd"
    os.makedirs(src)
    with open(f"{src}/a.xlsx", "wb") as f:
        f.write(write_workbook([("s1", sd_workbook_rows(40)), ("s2", sd_workbook_rows(10))]))
    target = ParquetTarget(f"{scratch}/DATA_SD")
    res = load_report(spark, "SD", src, "15-01-2024", target, load_ts=TS, load_user="u")
    a = res.audit
    again = load_report(spark, "SD", src, "15-01-2024", ParquetTarget(f"{scratch}/SD2"), load_ts=TS,
                        load_user="u", per_sheet=True).audit
    assert {k: again[k] for k in ("n_in", "n_out", "excluded")} == {k: a[k] for k in ("n_in", "n_out", "excluded")}
    assert a["n_in"] == 50 and a["status"] == "loaded" and a["read_mode"] == "workbook"
    out = target.read(spark)
    assert out.columns == SD_SPEC.output_names
    # kept: sheet-1 rows with day <= 15 (i in 0..14 and 31..39) = 24; sheet 2 repeats rows 0..9
    assert out.count() == a["n_out"] == 24
    assert {r.TIPO_DOC for r in out.collect()} == {"RUC", "DNI"}
    assert a["excluded"] == 16 and a["null_date_rows"] == 0
    with pytest.raises(LoadError):
        load_reports(spark, [("SD", src, target)], "15-01-2024", load_ts=TS, load_user="u")


def test_load_report_csv_os(spark, scratch):
    src = f"{scratch}/os"
    os.makedirs(src)
    with open(f"{src}/o.csv", "w") as f:
        f.write(",".join(OS_SPEC.raw_names) + "\n")
        f.write("1,DNI,007,ANA,05/01/2024,,BK,,U2,OK\n2,DNI,008,LUIS,06/02/2024,1/1/2024,BK,U1,,OK\n")
    target = ParquetTarget(f"{scratch}/DATA_OS")
    res = load_report(spark, "OS", src, "31-01-2024", target, load_ts=TS, load_user="u")
    rows = target.read(spark).collect()
    single = load_report(spark, "OS", src, "31-01-2024", ParquetTarget(f"{scratch}/OS2"), load_ts=TS,
                         load_user="u", encoding="per-line")
    assert single.audit["n_out"] == 1 and single.audit["read_mode"] == "plain"
    assert len(rows) == 1 and rows[0].ID == 1 and rows[0].USUARIO_CREA is None
    assert res.audit["excluded"] == 1 and res.audit["read_mode"] == "plain"


def test_command_line(spark, scratch, capsys):
    import json

    from ledgerline.plans.run import main

    src = f"{scratch}/os"
    os.makedirs(src)
    with open(f"{src}/o.csv", "w") as f:
        f.write(",".join(OS_SPEC.raw_names) + "\n1,DNI,007,ANA,05/01/2024,,BK,,U2,OK\n")
    assert main(["--os", src, "--cutoff", "31-01-2024", "--target-dir", f"{scratch}/wh"]) == 0
    audits = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert audits[0]["report"] == "OS" and audits[0]["n_out"] == 1 and audits[0]["status"] == "loaded"
    assert main(["--os", src, "--cutoff", "31-01-2024", "--target-dir", f"{scratch}/wh", "--guard", "skip"]) == 0
    assert json.loads(capsys.readouterr().out.strip().splitlines()[-1])[0]["status"] == "skipped"


def test_command_line_reports_every_outcome(spark, scratch, capsys):
    import json

    from ledgerline.plans.run import main

    src = f"{scratch}/os"
    os.makedirs(src)
    with open(f"{src}/o.csv", "w") as f:
        f.write(",".join(OS_SPEC.raw_names) + "\n1,DNI,007,ANA,99/99/2024,,BK,,U2,OK\n")
    assert main(["--sd", f"{scratch}/none", "--os", src, "--cutoff", "31-01-2024", "--target-dir", f"{scratch}/wh"]) == 1
    audits = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert audits[0]["status"].startswith("failed") and audits[1]["status"] == "not run"

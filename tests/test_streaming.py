"""Incremental intake: each file is loaded once, batches are idempotent."""

import datetime as dt
import os

import pytest

from ledgerline.plans.reports import LoadContext, load_sd_text
from ledgerline.spec import SD_SPEC
from ledgerline.streaming.intake import csv_report_stream, start_intake

CTX = LoadContext(dt.date(2024, 12, 31), dt.datetime(2024, 6, 30, 12), "etl-host/loader")
HEADER = ",".join(SD_SPEC.raw_names) + "\n"
ROW = "DNI,{n},ANA PAZ,01/01/1980,P,05/01/2024,WEB,PERU,VIDA,77,BK SUR,06/01/2024,{vh},U1,08/01/2024\n"


def test_intake_loads_new_files_once(spark, scratch):
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    os.makedirs(src)
    with open(f"{src}/a.csv", "w") as f:
        f.write(HEADER + ROW.format(n=1, vh="") + ROW.format(n=1, vh="") + ROW.format(n=2, vh="07/01/2024"))
    stream = csv_report_stream(spark, src, SD_SPEC.raw_names, encoding="per-line")
    load = lambda b: load_sd_text(b, CTX)
    start_intake(stream, load, out, ck).awaitTermination(120)
    first = spark.read.parquet(out)
    assert first.count() == 2
    assert sorted(r.AGENCIAMIENTO for r in first.collect()) == ["A", "C"]

    with open(f"{src}/b.csv", "w") as f:
        f.write(HEADER + ROW.format(n=3, vh=""))
    start_intake(csv_report_stream(spark, src, SD_SPEC.raw_names), load, out, ck).awaitTermination(120)
    both = spark.read.parquet(out)
    assert both.count() == 3
    assert both.select("batch").distinct().count() == 2


def test_report_intake_writes_audit_per_batch(spark, scratch):
    from ledgerline.plans.reports import sd_text_parsed
    from ledgerline.streaming.intake import start_report_intake

    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    os.makedirs(src)
    late = ROW.format(n=9, vh="").replace("05/01/2024", "05/01/2025")  # after the cut-off
    with open(f"{src}/a.csv", "w") as f:
        f.write(HEADER + ROW.format(n=1, vh="") + ROW.format(n=1, vh="") + late)
    stream = csv_report_stream(spark, src, SD_SPEC.raw_names)
    start_report_intake(stream, SD_SPEC, sd_text_parsed, CTX, out, ck).awaitTermination(120)
    assert spark.read.parquet(out).count() == 1
    a = spark.read.parquet(f"{out}/_audit").first()
    assert (a.n_in, a.n_out, a.excluded, a.null_date_rows) == (3, 1, 1, 0)
    assert a.first_date == dt.date(2024, 1, 5) and a.last_date == dt.date(2025, 1, 5)


def test_batch_with_only_late_rows_has_a_true_audit(spark, scratch):
    from ledgerline.plans.reports import sd_text_parsed
    from ledgerline.streaming.intake import start_report_intake

    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    os.makedirs(src)
    late = ROW.format(n=9, vh="").replace("05/01/2024", "05/01/2025")
    with open(f"{src}/a.csv", "w") as f:
        f.write(HEADER + late + late)
    start_report_intake(csv_report_stream(spark, src, SD_SPEC.raw_names), SD_SPEC, sd_text_parsed, CTX, out, ck).awaitTermination(120)
    a = spark.read.parquet(f"{out}/_audit").first()
    assert (a.n_in, a.n_out, a.excluded, a.null_date_rows) == (2, 0, 2, 0)
    assert a.last_date == dt.date(2025, 1, 5) and a.first_date is None


def stream_rows(spark, scratch, body, names=("a", "b", "c"), whole=False):
    from ledgerline.streaming.intake import csv_file_stream, read_batch
    src, out, ck = f"{scratch}/in", f"{scratch}/out", f"{scratch}/ck"
    os.makedirs(src)
    with open(f"{src}/f.csv", "wb") as f:
        f.write(body)
    stream = csv_file_stream(spark, src) if whole else csv_report_stream(spark, src, names)
    load = (lambda b: read_batch(b, names)) if whole else (lambda b: b)
    start_intake(stream, load, out, ck).awaitTermination(120)
    return sorted((tuple(r[n] for n in names) for r in spark.read.parquet(out).collect()), key=str)


@pytest.mark.parametrize("body, what", [(b'h1,h2,h3\na,"5\npipe",c\n', "goes on"), (b"h1,h2,h3\na,b,c,d\n", "more than 3")])
def test_lines_that_hide_cells_stop_the_stream(spark, scratch, body, what):
    with pytest.raises(Exception, match=what):
        stream_rows(spark, scratch, body)


def test_lines_of_the_stream_with_quotes(spark, scratch):
    body = b'h1,h2,h3\na,5" pipe,c\n"x, y","a ""b""",\n"p,""q r"",s"\n'
    assert stream_rows(spark, scratch, body) == sorted([("a", '5" pipe', "c"), ("x, y", 'a "b"', None), ("p", "q r", "s")], key=str)


def test_whole_files_of_the_stream_have_the_batch_checks(spark, scratch):
    body = 'h1,h2,h3\n1,"a\nb",\u20ac\n'.encode("cp1252")
    assert stream_rows(spark, scratch, body, whole=True) == [("1", "a\nb", "\u20ac")]
    with pytest.raises(Exception, match="wrong number of columns"):
        stream_rows(spark, f"{scratch}/2", b"h1,h2,h3,h4\na,b,c,d\n", whole=True)

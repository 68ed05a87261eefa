"""Golden rows for the scalar rules (FIXTURES section 2)."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from ledgerline.functions.dates import (
    excel_serial_seconds, excel_serial_to_date, excel_serial_to_timestamp, parse_cutoff, parse_date_dmy,
    parse_date_iso, parse_timestamp_iso,
)
from ledgerline.functions.text import (
    blank_to_null, classify_contains, date_shape, flag_blank, normalize_doc_type, strip_unicode,
)
from ledgerline.operators.chunks import chunk_columns, plan_chunks


def one_col(spark, values, fn, dtype="string"):
    df = spark.createDataFrame([(v,) for v in values], f"v {dtype}")
    return [r[0] for r in df.select(fn(F.col("v"))).collect()]


def test_strip_unicode(spark):
    got = one_col(spark, ["\t x\n", "  ", None, "　a b ", "x"], strip_unicode)
    assert got == ["x", "", None, "a b", "x"]


def test_strip_is_idempotent(spark):
    vals = [" a ", "  b", "c"]
    once = one_col(spark, vals, strip_unicode)
    assert one_col(spark, once, strip_unicode) == once


def test_doc_type(spark):
    got = one_col(spark, ["RUC 20", "PASAPORTE", "CARNET EXT.", "DNI", "RUC PAS", "ruc", None], normalize_doc_type)
    assert got == ["RUC", "PT", "CE", "DNI", "RUC", "ruc", None]
    # idempotent
    assert one_col(spark, got, normalize_doc_type) == got


def test_classify_first_match_wins(spark):
    got = one_col(spark, ["ab", "b", "z"], lambda c: classify_contains(c, [("a", "A"), ("b", "B")]))
    assert got == ["A", "B", "z"]


def test_agency_flag(spark):
    assert one_col(spark, [None, "", "31/12/2024"], lambda c: flag_blank(c, "A", "C")) == ["A", "A", "C"]


def test_date_shape(spark):
    got = one_col(spark, ["", None, "01/02/2024 10:00", "01-02/2024", "1/2/2024", "99/99/9999", "-"], date_shape)
    assert got == [True, None, True, True, False, True, False]


def test_lenient_date(spark):
    got = one_col(spark, ["01/02/2024 x", "31/02/2024", "", "01-02-2024", "1/2/2024", None],
                  lambda c: parse_date_dmy(c, strict=False))
    assert got == [dt.date(2024, 2, 1), None, None, None, dt.date(2024, 2, 1), None]


def test_strict_date_fails(spark):
    df = spark.createDataFrame([("31/02/2024",)], "v string")
    with pytest.raises(PySparkException):
        df.select(parse_date_dmy("v", strict=True)).collect()


def test_strict_timestamp(spark):
    got = one_col(spark, ["2024-05-06 07:08:09", "2024-05-06 07:08:09.5"], parse_timestamp_iso)
    assert got == [dt.datetime(2024, 5, 6, 7, 8, 9)] * 2
    df = spark.createDataFrame([("2024-05-06",)], "v string")
    with pytest.raises(PySparkException):
        df.select(parse_timestamp_iso("v")).collect()


def test_iso_date_lenient(spark):
    assert one_col(spark, ["2024-05-06 00:00:00", "x", None], parse_date_iso) == [dt.date(2024, 5, 6), None, None]


def test_serial_date(spark):
    assert one_col(spark, ["45000.25", "45000"], excel_serial_to_date) == [dt.date(2023, 3, 15)] * 2


def test_serial_timestamp_default_and_compat(spark):
    assert one_col(spark, ["45000.25"], excel_serial_to_timestamp) == [dt.datetime(2023, 3, 15, 6)]
    assert one_col(spark, ["45000"], excel_serial_to_timestamp) == [dt.datetime(2023, 3, 15)]
    compat = lambda c: excel_serial_to_timestamp(c, compat=True)
    assert one_col(spark, ["45000"], compat) == [dt.datetime(2023, 3, 15, 10, 48)]


def test_serial_fraction_seconds(spark):
    dflt = lambda c: excel_serial_seconds(c)
    compat = lambda c: excel_serial_seconds(c, compat=True)
    assert one_col(spark, ["1.7083449074", "1.3333564815"], dflt) == [61201, 28802]
    assert one_col(spark, ["1.7083449074", "1.3333564815"], compat) == [61201, 28801]


def test_blank_to_null(spark):
    assert one_col(spark, ["", "ana", None], blank_to_null) == [None, "ana", None]


def test_strict_int(spark):
    assert one_col(spark, ["12"], lambda c: c.cast("int")) == [12]
    for bad in ("", "4.5"):
        df = spark.createDataFrame([(bad,)], "v string")
        with pytest.raises(PySparkException):
            df.select(F.col("v").cast("int")).collect()


@pytest.mark.parametrize("n,plan", [(8750, [8750]), (8751, [5000, 3751]), (25000, [5000] * 5),
                                    (100000, [20000] * 5), (0, [])])
def test_chunk_plan(n, plan):
    assert plan_chunks(n) == plan


def test_chunk_columns_match_plan(spark):
    ns = [1, 8750, 8751, 25000, 100000, 123457]
    df = spark.createDataFrame([(n,) for n in ns], "n bigint").withColumns(chunk_columns(F.col("n")))
    for r in df.collect():
        p = plan_chunks(r.n)
        assert (r.n_chunks, r.chunk_size, r.last_chunk) == (len(p), p[0], p[-1])


def test_cutoff_parameter():
    assert parse_cutoff("31-01-2024") == dt.date(2024, 1, 31)
    with pytest.raises(ValueError):
        parse_cutoff("2024-01-31")


def test_strict_date_of_blank_fails_but_null_passes(spark):
    df = spark.createDataFrame([("",)], "v string")
    with pytest.raises(PySparkException):
        df.select(parse_date_dmy("v", strict=True)).collect()
    nul = spark.createDataFrame([(None,)], "v string")
    assert nul.select(parse_date_dmy("v", strict=True)).first()[0] is None


def test_dash_is_not_date_shaped(spark):
    """The shape pattern needs the whole dd-mm-yyyy form or an empty cell."""
    assert one_col(spark, ["-"], date_shape) == [False]
    assert one_col(spark, ["--/--/----"], lambda c: parse_date_dmy(c, strict=False)) == [None]

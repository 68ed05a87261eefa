"""Realignment golden rows (FIXTURES section 2) and properties."""

from pyspark.sql import functions as F

from ledgerline.operators.realign import CELLS, realign
from ledgerline.spec import SD_SPEC

NAMES = list(SD_SPEC.raw_names[2:])
CLEAN = ["ANA PAZ", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK SUR", "06/01/2024",
         "07/01/2024", "U1", "08/01/2024"]


def run(spark, rows):
    data = [("DNI", "1", *r) for r in rows]
    df = spark.createDataFrame(data, SD_SPEC.raw_ddl)
    out = realign(df, kind_column="k").collect()
    return [([r[n] for n in NAMES], r.k) for r in out]


def test_kinds(spark):
    A, B, C = "A", "B", "C"
    cases = [
        (CLEAN, CLEAN, 0),
        (["ANA", "PAZ", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK SUR", "06/01/2024",
          "07/01/2024", "U1"], CLEAN[:12] + [None], 1),
        (["ANA", "PAZ", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK", "SUR", "06/01/2024",
          "07/01/2024"], CLEAN[:11] + [None, None], 2),
        (["ANA PAZ", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK", "SUR", "06/01/2024",
          "07/01/2024", "U1"], CLEAN[:12] + [None], 3),
        ([A, B, C, None, "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK SUR", "06/01/2024", "07/01/2024"],
         ["A,B,C", None] + CLEAN[2:11] + [None, None], 4),
        ([A, B, C, None, "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK", "SUR", "06/01/2024"],
         ["A,B,C", None] + CLEAN[2:8] + ["BK,SUR", "06/01/2024", None, None, None], 5),
    ]
    got = run(spark, [c[0] for c in cases])
    for (raw, want, kind), (cells, k) in zip(cases, got):
        assert k == kind, (raw, k)
        assert cells == want, (kind, cells)


def test_rule3_wins_over_rule4_when_birth_date_is_dated(spark):
    raw = ["A", "B", "C", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK SUR", "06/01/2024",
           "07/01/2024"]
    (cells, k), = run(spark, [raw])
    assert k == 3
    assert cells == ["A", "B", "C", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA 77", "BK SUR",
                     "06/01/2024", "07/01/2024", None]


def test_null_part_nulls_joined_name(spark):
    raw = ["ANA", None, "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK SUR", "06/01/2024",
           "07/01/2024", "U1"]
    (cells, k), = run(spark, [raw])
    assert k == 1 and cells[0] is None


def test_blank_nationality_meets_rule_4_or_5(spark):
    raw = list(CLEAN)
    raw[CELLS.index("NA")] = ""
    (_, k), = run(spark, [raw])
    assert k in (4, 5)


def test_row_count_kept_and_partition_independent(spark):
    rows = [CLEAN] * 50 + [["ANA", "PAZ", "01/01/1980", "P", "05/01/2024", "WEB", "PERU", "VIDA", "77", "BK SUR",
                            "06/01/2024", "07/01/2024", "U1"]] * 30
    df = spark.createDataFrame([("DNI", str(i), *r) for i, r in enumerate(rows)], SD_SPEC.raw_ddl)
    a = realign(df.repartition(1)).orderBy("NRO_DOC").collect()
    b = realign(df.repartition(7)).orderBy("NRO_DOC").collect()
    assert len(a) == len(rows) and a == b
    assert realign(df).filter(F.col("REGISTRATION_DATE").isNull()).count() == 30

"""De-duplication by fingerprints against the plain form."""

import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ledgerline.operators import cutoff
from ledgerline.operators.cutoff import dedupe, dedupe_stored


def rows_of(df):
    return Counter(map(repr, df.collect()))


ROWS = [(1, "a", None, 0.0), (1, "a", None, -0.0), (1, None, "a", 0.0), (1, None, "a", float("nan")),
        (1, None, "a", float("nan")), (None, None, None, None), (None, None, None, None), (2, "", "", 1.5),
        (2, "", None, 1.5), (3, "x" * 200_000, "y", 2.0), (3, "x" * 200_000, "y", 2.0), (4, "only", "once", 4.0)]


@pytest.mark.parametrize("limit", [cutoff.FINGERPRINT_BROADCAST, 0])
def test_same_rows_as_full_comparison(spark, limit):
    df = spark.createDataFrame(ROWS, "mark_a int, mark_b string, `n.x` string, d double").repartition(3)
    got = dedupe_stored(df, limit)
    assert got.columns == df.columns
    assert got.count() == 8
    clean = [F.coalesce(F.col("d"), F.lit(-1.0)) + 0.0]
    assert rows_of(got.withColumn("d", *clean)) == rows_of(dedupe(df).withColumn("d", *clean))


def test_empty_table(spark):
    assert dedupe_stored(spark.createDataFrame([], "a int, b string")).count() == 0


def test_one_row_a_third_of_all(spark):
    df = spark.range(3_000).select(F.when(F.col("id") < 1_000, F.lit(-1)).otherwise(F.col("id")).alias("k"), F.lit("t").alias("t"))
    assert dedupe_stored(df).count() == 2_001


def test_rows_of_equal_fingerprint_are_compared_in_full(spark, monkeypatch):
    monkeypatch.setattr(cutoff.F, "xxhash64", lambda *c: F.lit(7).cast("bigint"))
    df = spark.createDataFrame([(1, "a"), (1, "a"), (2, "a"), (1, None)], "k int, t string")
    assert sorted(map(tuple, dedupe_stored(df).collect()), key=str) == [(1, "a"), (1, None), (2, "a")]


def test_only_rows_with_a_repeated_fingerprint_are_shuffled(spark):
    df = spark.createDataFrame(ROWS, "k int, a string, b string, d double")
    plan = dedupe_stored(df)._jdf.queryExecution().optimizedPlan().toString()
    aggregate = plan[plan.index("Aggregate"):]
    assert "LeftSemi" in aggregate and "LeftAnti" not in aggregate
    assert len(re.findall(r"^\W*Aggregate", plan, re.M)) == 1

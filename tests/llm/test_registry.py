import duckdb
import pytest

from ledgerline.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    names = sorted(df.columns)
    want = con.execute(f"SELECT {', '.join(names)} FROM ({ORACLES[name]})").fetchall()
    got = [tuple(r) for r in df.select(*names).collect()]
    assert sorted(got, key=str) == sorted(want, key=str) and got


def test_entry_registers_queries_and_pipeline():
    import __spark_entry__ as e
    assert set(QUERIES) | {"pipeline"} <= set(e.queries())
    assert set(ORACLES) <= set(e.oracle_sql()) and "pipeline" not in e.oracle_sql()

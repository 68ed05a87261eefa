"""Driver contract of __spark_entry__.py."""

import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_every_report_query_has_an_oracle():
    from ledgerline.plans.registry import ORACLES, QUERIES
    e = load_entry()
    assert set(QUERIES) == set(ORACLES)
    assert len(QUERIES) >= 27
    assert set(QUERIES) <= set(e.queries())
    assert set(e.oracle_sql()) <= set(e.queries())


def test_entry_returns_the_sd_report(spark):
    from ledgerline.spec import SD_SPEC
    df = load_entry().entry(spark)
    assert df.columns == SD_SPEC.output_names
    assert dict(df.dtypes)["FECHA_REG"] == "timestamp_ntz"
    assert df.count() > 0

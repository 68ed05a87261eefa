"""Physical-plan shape of the loads (guards the scale properties)."""

import contextlib
import io
import os

from ledgerline.plans import raw_views as rv
from ledgerline.plans.registry import CTX
from ledgerline.plans.reports import finish, sd_text_parsed
from ledgerline.sources.csv_text import read_report_csv
from ledgerline.spec import SD_SPEC

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_load_has_one_exchange_and_metrics_below_filter(spark, scratch):
    rv.sd_raw(spark, SF).write.parquet(f"{scratch}/raw")
    raw = spark.read.parquet(f"{scratch}/raw")
    p = plan(finish(sd_text_parsed(raw, CTX), SD_SPEC, CTX))
    tree = p.split("\n\n")[0]
    assert tree.count("Exchange") == 1, tree
    assert "Join" not in tree and "Sort" not in tree
    assert tree.index("Filter") < tree.index("CollectMetrics")  # filter sits above the observe node
    assert tree.count("HashAggregate") == 2  # partial + final around the one exchange
    # the scan reads only the 15 report cells
    assert "row_id" not in p.split("ReadSchema:")[1].split("\n")[0]


def test_csv_scan_reads_only_the_line(spark, scratch):
    os.makedirs(f"{scratch}/csv")
    with open(f"{scratch}/csv/a.csv", "w") as f:
        f.write(",".join(SD_SPEC.raw_names) + "\n" + ",".join(["x"] * 15) + "\n")
    cells, _ = read_report_csv(spark, f"{scratch}/csv", SD_SPEC.raw_names)
    p = plan(finish(sd_text_parsed(cells, CTX), SD_SPEC, CTX))
    assert "ReadSchema: struct<line:string>" in p
    assert p.split("\n\n")[0].count("Exchange") == 1

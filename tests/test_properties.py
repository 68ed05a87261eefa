"""Randomised checks against plain-Python brute force (one Spark job each)."""

import random
import re

from pyspark.sql import functions as F

from ledgerline.functions.text import UNICODE_WHITESPACE, date_shape, strip_unicode
from ledgerline.operators.realign import realign
from ledgerline.spec import SD_SPEC

NAMES = list(SD_SPEC.raw_names[2:])


def py_shape(v):
    if v is None:
        return None
    return re.fullmatch(r"(?:\d{2}[-/]\d{2}[-/]\d{4})?", v[:10]) is not None


def py_and(*xs):
    if any(x is False for x in xs):
        return False
    return None if any(x is None for x in xs) else True


def py_join(sep, *xs):
    return None if any(x is None for x in xs) else sep.join(xs)


def py_realign(c):
    """The shift table written out by hand, rule by rule."""
    N, FN, TE, FR, FU, NA, RA, CB, BK, VD, VH, US, RD = c
    d = py_shape
    nd = lambda v: None if d(v) is None else not d(v)
    if py_and(d(FU), nd(VD), d(VH)):
        return 1, [py_join(" ", N, FN), TE, FR, FU, NA, RA, CB, BK, VD, VH, US, RD, None]
    if py_and(d(FU), nd(VD), nd(VH)):
        return 2, [py_join(" ", N, FN), TE, FR, FU, NA, RA, CB, BK, py_join(" ", VD, VH), US, RD, None, None]
    if py_and(d(FR), nd(VD)):
        return 3, [N, FN, TE, FR, FU, NA, RA, CB, py_join(" ", BK, VD), VH, US, RD, None]
    if py_and(d(NA), d(US)):
        return 4, [py_join(",", N, FN, TE), FR, FU, NA, RA, CB, BK, VD, VH, US, RD, None, None]
    if py_and(d(NA), nd(US)):
        return 5, [py_join(",", N, FN, TE), FR, FU, NA, RA, CB, BK, VD, py_join(",", VH, US), RD, None, None, None]
    return 0, list(c)


POOL = [None, "", "01/02/2024", "31-12-1999 10:00", "1/2/2024", "ANA", "B C", "77", "99/99/9999", "x01/02/2024"]


def test_realign_matches_brute_force(spark):
    rnd = random.Random(11)
    rows = [[rnd.choice(POOL) for _ in NAMES] for _ in range(3000)]
    df = spark.createDataFrame([("DNI", str(i), *r) for i, r in enumerate(rows)], SD_SPEC.raw_ddl)
    got = {int(r.NRO_DOC): (r.k, [r[n] for n in NAMES]) for r in realign(df, kind_column="k").collect()}
    kinds = set()
    for i, r in enumerate(rows):
        want = py_realign(r)
        assert got[i] == want, (r, got[i], want)
        kinds.add(want[0])
    assert kinds == {0, 1, 2, 3, 4, 5}


def test_strip_and_shape_match_python(spark):
    rnd = random.Random(5)
    alphabet = list(UNICODE_WHITESPACE) + list("ab /-0123456789") + ["\u00e9", "\u200b", "\ufeff"]
    vals = ["".join(rnd.choice(alphabet) for _ in range(rnd.randint(0, 14))) for _ in range(3000)] + [None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, v string")
    out = df.select("i", strip_unicode("v").alias("s"), date_shape(F.col("v")).alias("d")).collect()
    for r in out:
        v = vals[r.i]
        assert r.s == (None if v is None else v.strip(UNICODE_WHITESPACE)), repr(v)
        assert r.d == py_shape(v), repr(v)


def test_csv_round_trip_with_wrapped_lines(spark, scratch):
    """Random cells written with Python's csv module (RFC quoting), every third
    line wrapped whole in quotes, read back unchanged."""
    import csv
    import io

    from ledgerline.sources.csv_text import read_report_csv

    rnd = random.Random(3)
    pool = ["a", "b c", "x,y", 'say "hi"', '"q"', "", "ñandú", ",", '""', "z" * 50]
    names = ["c0", "c1", "c2", "c3"]
    rows = [[rnd.choice(pool) for _ in names] for _ in range(400)]
    lines = []
    for i, r in enumerate(rows):
        buf = io.StringIO()
        csv.writer(buf, lineterminator="").writerow(r)
        line = buf.getvalue()
        lines.append('"' + line.replace('"', '""') + '"' if i % 3 == 0 else line)
    with open(f"{scratch}/r.csv", "w", encoding="utf-8") as f:
        f.write(",".join(names) + "\n" + "\n".join(lines) + "\n")
    df, _ = read_report_csv(spark, scratch, names)
    key = lambda t: tuple((v is not None, v or "") for v in t)
    got = sorted((tuple(r[n] for n in names) for r in df.collect()), key=key)
    # Python's writer leaves an empty cell unquoted: it reads back as null
    want = sorted((tuple(None if v == "" else v for v in r) for r in rows), key=key)
    assert got == want


def test_serial_dates_against_numpy(spark):
    """Default: serial text of whole-second timestamps round-trips exactly.
    Compat: seconds equal numpy float32 arithmetic, truncated."""
    import datetime as dt

    import numpy as np

    from ledgerline.functions.dates import excel_serial_seconds, excel_serial_to_timestamp

    rnd = random.Random(9)
    epoch = dt.datetime(1899, 12, 30)
    stamps = [dt.datetime(1950, 1, 1) + dt.timedelta(seconds=rnd.randint(0, 80 * 365 * 86400)) for _ in range(2000)]
    serials = []
    for t in stamps:
        days = (t.date() - epoch.date()).days
        secs = t.hour * 3600 + t.minute * 60 + t.second
        serials.append(f"{days}.{(secs * 10**10 + 43200) // 86400:010d}")
    serials += [str(rnd.randint(1, 60000)) for _ in range(200)]  # whole-number serials
    df = spark.createDataFrame([(i, s) for i, s in enumerate(serials)], "i int, s string")
    out = df.select("i", excel_serial_to_timestamp("s").alias("ts"),
                    excel_serial_seconds("s", compat=True).alias("cs")).collect()
    for r in out:
        s = serials[r.i]
        if r.i < len(stamps):
            assert r.ts == stamps[r.i], s
        else:
            assert r.ts == epoch + dt.timedelta(days=int(s))
        frac = np.float32("0." + s.split(".")[-1])
        assert r.cs == int(frac * np.float32(86400)), s

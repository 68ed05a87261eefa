"""File sources: CSV (ragged, blanks, wrapped lines, Latin-1, checks) and workbooks."""

import datetime as dt
import os

import pytest
from pyspark.errors import PySparkException

from ledgerline.operators.columns import ColumnCountError
from ledgerline.sources.csv_text import profile_files, read_report_csv
from ledgerline.sources.files import SourceError, list_files, suffix_glob
from ledgerline.sources.workbooks import read_workbooks
from ledgerline.sources.xlsx import write_workbook

NAMES = ["a", "b", "c"]


def write(path, data: bytes):
    with open(path, "wb") as f:
        f.write(data)


def rows(df):
    return sorted((tuple(r[n] for n in NAMES) for r in df.collect()),
                  key=lambda t: tuple((v is not None, v or "") for v in t))


def test_suffix_glob():
    assert suffix_glob(["csv"]) == "*.[cC][sS][vV]"
    assert suffix_glob(["xlsx", "xls"]) == "*.{[xX][lL][sS][xX],[xX][lL][sS]}"


def test_ragged_blank_wrapped(spark, scratch):
    write(f"{scratch}/r.csv", b'h1,h2,h3\n1,"",3\n1,,3\n"4,""x, y"""\n5,6\n7,8,9,10\n')
    df, facts = read_report_csv(spark, scratch, NAMES)
    want = [("1", None, "3"), ("1", "", "3"), ("4", "x, y", None), ("5", "6", None), ("7", "8", "9")]
    assert rows(df) == sorted(want, key=lambda t: tuple((v is not None, v or "") for v in t))
    assert facts["read_mode"] == "repaired"
    assert df.select("source_file").distinct().first()[0] == "r.csv"


def test_normal_quoting_untouched(spark, scratch):
    write(f"{scratch}/q.CSV", b'h1,h2,h3\n"a","b, c","d"\n')
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert rows(df) == [("a", "b, c", "d")]
    assert facts["read_mode"] == "plain"


def test_latin1_and_utf8_files(spark, scratch):
    write(f"{scratch}/l.csv", "h1,h2,h3\ncaf\xe9,ni\xf1o,x\n".encode("latin-1"))
    write(f"{scratch}/u.csv", "h1,h2,h3\ncafé,niño,y\n".encode("utf-8"))
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert rows(df) == [("café", "niño", "x"), ("café", "niño", "y")]
    assert facts["encodings"] == {"ISO-8859-1": 1, "UTF-8": 1}
    enc = {os.path.basename(p.path): p.encoding for p in profile_files(spark, scratch)}
    assert enc == {"l.csv": "ISO-8859-1", "u.csv": "UTF-8"}


def test_utf16_and_utf8_bom_files(spark, scratch):
    write(f"{scratch}/le.csv", "h1,h2,h3\n\u00f1,b,c\nd,e,f\n".encode("utf-16"))
    write(f"{scratch}/be.csv", "\ufeffh1,h2,h3\ng,h,i\n".encode("utf-16-be"))
    write(f"{scratch}/bom.csv", "h1,h2,h3\nx,y,z\n".encode("utf-8-sig"))
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert rows(df) == [("d", "e", "f"), ("g", "h", "i"), ("x", "y", "z"), ("\u00f1", "b", "c")]
    assert facts["encodings"] == {"UTF-16BE": 1, "UTF-16LE": 1, "UTF-8": 1}


def test_per_line_encoding_keeps_the_checks(spark, scratch):
    write(f"{scratch}/l.csv", "h1,h2,h3\ncaf\xe9,ni\xf1o,x\n\"7,\"\"a, b\"\"\"\n".encode("latin-1"))
    write(f"{scratch}/u.csv", "h1,h2,h3\ncaf\u00e9,ni\u00f1o,y\n".encode("utf-8"))
    df, facts = read_report_csv(spark, scratch, NAMES, encoding="per-line")
    assert rows(df) == [("7", "a, b", None), ("caf\u00e9", "ni\u00f1o", "x"), ("caf\u00e9", "ni\u00f1o", "y")]
    assert facts["read_mode"] == "repaired"
    write(f"{scratch}/w.csv", b"h1,h2\n1,2\n")
    with pytest.raises(ColumnCountError) as e:
        read_report_csv(spark, scratch, NAMES, encoding="per-line")
    assert [os.path.basename(r.path) for r in e.value.files.collect()] == ["w.csv"]


def test_latin1_line_starting_like_a_bom_stays_latin1(spark, scratch):
    write(f"{scratch}/l.csv", b"h1,h2,h3\n\xff\xfex,b,c\n")
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert facts["encodings"] == {"ISO-8859-1": 1}
    assert rows(df) == [("\u00ff\u00fex", "b", "c")]


def test_long_wrapped_line_whole_text(spark, scratch):
    text = "word, " * 25000  # 150,000 characters in one cell
    line = '"1,""' + text.replace('"', '""') + '"",3"'
    write(f"{scratch}/long.csv", ("h1,h2,h3\n" + line + "\n").encode("utf-8"))
    df, facts = read_report_csv(spark, scratch, NAMES)
    got = df.collect()
    assert len(got) == 1 and got[0]["b"] == text and got[0]["c"] == "3"
    assert facts["read_mode"] == "repaired"


def test_line_breaks_inside_quotes_are_kept(spark, scratch):
    write(f"{scratch}/q.csv", b'h1,h2,h3\n1,"U\n1",x\n"a ""b"",\r\n\nc",2,\n3,4,5\n')
    write(f"{scratch}/p.csv", b"h1,h2,h3\n6,7,8\n")
    write(f"{scratch}/l.csv", 'h1,h2,h3\n9,"caf\u00e9\nx",y\n'.encode("latin-1"))
    df, _ = read_report_csv(spark, scratch, NAMES)
    want = [("1", "U\n1", "x"), ('a "b",\r\n\nc', "2", None), ("3", "4", "5"), ("6", "7", "8"), ("9", "caf\u00e9\nx", "y")]
    assert rows(df) == sorted(want, key=lambda t: tuple((v is not None, v or "") for v in t))


def test_stray_quotes_of_unquoted_cells_are_text(spark, scratch):
    write(f"{scratch}/s.csv", b'h1,h2,h3\na,5" pipe,c\nd,e,f\n"O""B",x"y"z,"1" 2\ng,h,i\n')
    write(f"{scratch}/m.csv", b'h1,h2,h3\nj,6" rod,k\n7,"U\n"" 1",4" x\nl,"m\nn, 2""",o\np,q,r"\ns,t,u\n')
    write(f"{scratch}/u.csv", 'h1,h2,h3\nv,8" \u2264,w\n'.encode("utf-16"))
    df, _ = read_report_csv(spark, scratch, NAMES)
    want = [("a", '5" pipe', "c"), ("d", "e", "f"), ('O"B', 'x"y"z', '"1" 2'), ("g", "h", "i"), ("j", '6" rod', "k"),
            ("7", 'U\n" 1', '4" x'), ("l", 'm\nn, 2"', "o"), ("p", "q", 'r"'), ("s", "t", "u"), ("v", '8" \u2264', "w")]
    assert rows(df) == sorted(want)


@pytest.mark.parametrize("body", [
    b'1,"a,x\nd,e,f\ng,h,i\n',                 # never closed
    b'1,"a,x\nd,"e",f\ng,h,i\n',               # closed by another row's opening quote
    b'1,2,"a\nd,e",f,g\nh,i,j\n',              # wider than the header
])
def test_records_that_may_hide_rows_are_an_error(spark, scratch, body):
    write(f"{scratch}/bad.csv", b"h1,h2,h3\n" + body)
    write(f"{scratch}/good.csv", b'h1,h2,h3\n1,"a\nb",c\n')
    with pytest.raises(SourceError, match="hide rows") as e:
        read_report_csv(spark, scratch, NAMES)
    assert [os.path.basename(r.path) for r in e.value.files.collect()] == ["bad.csv"]


@pytest.fixture()
def small_blocks(spark):
    """Files are cut into blocks of 200 bytes."""
    conf = {"spark.sql.files.maxPartitionBytes": "200", "spark.sql.files.openCostInBytes": "0"}
    was = {k: spark.conf.get(k) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    yield
    for k, v in was.items():
        spark.conf.set(k, v)


def quoted_rows(rng, n):
    """Rows with quotes, separators and line breaks in every place, and a long cell over many blocks."""
    cell = lambda: "".join(rng.choice(['"', ",", "\n", "a", "b c", "\u00e9", "\n\n"]) for _ in range(rng.randrange(12)))
    out = [(f"r{k}", cell(), rng.choice(["", "x", cell()])) for k in range(n)]
    return [*out[:n // 2], ("long", 'li"ne, \n' * 150, "\n"), *out[n // 2:]]


@pytest.mark.parametrize("encoding", ["utf-8", "latin-1", "utf-16-le", "utf-16-be"])
def test_records_across_blocks_as_the_csv_module_writes_them(spark, scratch, small_blocks, encoding):
    import csv
    import io
    import random

    from ledgerline.sources.csv_records import file_lines
    want, mark = [], "\ufeff" if "16" in encoding else ""
    for k in range(2):
        lines = quoted_rows(random.Random(k), 60)
        text = io.StringIO(newline="")
        writer = csv.writer(text, quoting=csv.QUOTE_ALL if k else csv.QUOTE_MINIMAL, lineterminator="\r\n" if k else "\n")
        writer.writerows([("h1", "h2", "h3"), *lines])
        write(f"{scratch}/f{k}.csv", (mark + text.getvalue()).encode(encoding))
        want += [tuple(None if v == "" and not k else v for v in r) for r in lines]
    df, facts = read_report_csv(spark, scratch, NAMES)
    key = lambda t: tuple((v is not None, v or "") for v in t)
    assert rows(df) == sorted(want, key=key) and facts["files"] == 2
    blocks = file_lines(spark, [f"{scratch}/f0.csv"], None, spark.read.format("text"), None).select("block").distinct().count()
    assert blocks >= 8


def test_utf16_line_feeds_across_characters(spark, scratch):
    """The bytes of a line feed that lie in two characters are no line break."""
    for name, encoding, body in (("l", "utf-16-le", "1,\u0a05\u0100x,\"a\nb\"\n"), ("b", "utf-16-be", "2,\u4e00\u0a05,\"a\nb\"\n")):
        write(f"{scratch}/{name}.csv", ("\ufeffh1,h2,h3\n" + body).encode(encoding))
    df, _ = read_report_csv(spark, scratch, NAMES)
    assert rows(df) == [("1", "\u0a05\u0100x", "a\nb"), ("2", "\u4e00\u0a05", "a\nb")]


def test_no_window_or_shuffle_over_the_lines_of_a_file(spark, scratch):
    from ledgerline.sources import csv_records
    from ledgerline.sources.csv_text import opens_quote, stays_open
    from pyspark.sql import functions as F
    write(f"{scratch}/q.csv", b'h1,h2,h3\n1,"a\nb",c\n')
    lines = csv_records.file_lines(spark, [f"{scratch}/q.csv"], None, spark.read.format("text"), None)
    flagged = lines.withColumn("opens", opens_quote(F.col("line"))).withColumn("stays", stays_open(F.col("line")))
    plan = csv_records.block_maps(flagged)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Window" not in plan and "Sort" not in plan
    starts = csv_records.block_starts(csv_records.block_maps(flagged)).select("path", "block", "start")
    placed = flagged.join(F.broadcast(starts), ["path", "block"]).select("path", "source_file", "block", "start", "opens", "stays", "line")
    top = csv_records.cut_records(placed)._jdf.queryExecution().executedPlan().toString().split("BroadcastExchange")[0]
    assert "Exchange" not in top.replace("BroadcastHashJoin", "") and "SortMergeJoin" not in top


def test_wrapped_header_and_line_marks(spark, scratch):
    write(f"{scratch}/w.csv", '"h1,""h2"",h3"\n"1,""a\u2028b"",c"\n"2,""d\u2029""""e"",f"\n'.encode("utf-8"))
    write(f"{scratch}/l.csv", 'h1,h2,h3\n"3,""x\u0085y"",\u00e9"\n'.encode("latin-1"))
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert rows(df) == [("1", "a\u2028b", "c"), ("2", 'd\u2029"e', "f"), ("3", "x\u0085y", "\u00e9")]
    assert facts["read_mode"] == "repaired"


def test_compatible_repair_touches_every_line(spark):
    from pyspark.sql import functions as F

    from ledgerline.sources.csv_text import repair_line
    lines = ['"a,""b"""', '"a","b"', 'x,""y""', '""', '"', "p"]
    df = spark.createDataFrame([(x,) for x in lines], "v string")
    got = [tuple(r) for r in df.select(repair_line(F.col("v")), repair_line(F.col("v"), compat=True)).collect()]
    assert got == [('a,"b"', 'a,"b"'), ('"a","b"', 'a","b'), ('x,""y""', 'x,"y"'), ("", ""), ('"', '"'), ("p", "p")]


def test_windows_1252_when_asked_for(spark, scratch):
    body = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    write(f"{scratch}/c.csv", b"h1,h2,h3\n" + body + b',"\xe9",z\n')
    df, facts = read_report_csv(spark, scratch, NAMES, encoding="windows-1252")
    assert rows(df) == [(body.decode("cp1252"), "\u00e9", "z")]
    assert facts["encodings"] == {"windows-1252": 1}


def test_windows_1252_from_the_bytes(spark, scratch):
    body = bytes(b for b in range(0x80, 0xA0) if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D))
    write(f"{scratch}/w.csv", b"h1,h2,h3\nplain,b,c\n" * 1 + b"w," + body + b',"\xe9 ""x"""\n')
    write(f"{scratch}/l.csv", b"h1,h2,h3\nl,\x85,\xe9\n")              # a line mark only
    write(f"{scratch}/c.csv", b"h1,h2,h3\nc,\x93\x81,\xe9\n")          # a byte that windows-1252 lacks
    write(f"{scratch}/u.csv", "h1,h2,h3\nu,\u0093,\u20ac\n".encode())   # valid UTF-8
    write(f"{scratch}/q.csv", b'h1,h2,h3\nq,"\x80\n\x99",\xe9\n')       # with a line break in a cell
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert facts["encodings"] == {"windows-1252": 2, "ISO-8859-1": 2, "UTF-8": 1}
    assert rows(df) == sorted([("plain", "b", "c"), ("w", body.decode("cp1252"), '\u00e9 "x"'), ("l", "\u0085", "\u00e9"),
                               ("c", "\u0093\u0081", "\u00e9"), ("u", "\u0093", "\u20ac"), ("q", "\u20ac\n\u2122", "\u00e9")])


def test_one_windows_1252_file(spark, scratch):
    write(f"{scratch}/w.csv", "h1,h2,h3\n\u20ac,\u00e9,\u201cz\u201d\n".encode("cp1252"))
    df, facts = read_report_csv(spark, scratch, NAMES)
    assert facts["encodings"] == {"windows-1252": 1} and rows(df) == [("\u20ac", "\u00e9", "\u201cz\u201d")]


def test_wrong_width_fails(spark, scratch):
    write(f"{scratch}/w.csv", b"h1,h2\n1,2\n")
    with pytest.raises(ColumnCountError, match="allowed: 3"):
        read_report_csv(spark, scratch, NAMES)


def test_empty_csv_fails_naming_file(spark, scratch):
    write(f"{scratch}/full.csv", b"h1,h2,h3\n1,2,3\n")
    write(f"{scratch}/empty.csv", b"h1,h2,h3\n")
    with pytest.raises(SourceError, match="empty.csv"):
        read_report_csv(spark, scratch, NAMES)


def test_missing_folder_and_no_match(spark, scratch):
    with pytest.raises(SourceError):
        list_files(spark, f"{scratch}/nope", ["csv"])
    write(f"{scratch}/x.txt", b"1")
    with pytest.raises(SourceError):
        list_files(spark, scratch, ["csv"])


def test_workbook_two_sheets_gaps_and_dates(spark, scratch):
    when = dt.datetime(2024, 5, 6, 7, 8, 9)
    book = write_workbook([
        ("one", [["h0", "h1", "h2", "h3"], ["a", 1, 2.5, when], ["b", None, 3, dt.date(2024, 1, 2)]]),
        ("two", [["h0", "h1", "h2", "h3"], [], ["c", 7, None, None]]),
    ], shared=True)
    write(f"{scratch}/b1.xlsx", book)
    write(f"{scratch}/b2.xlsx", write_workbook([("s", [["h0", "h1", "h2", "h3"], ["d", 8, 9, None]])],
                                               shared=False))
    df = read_workbooks(spark, scratch, [0, 3, 1], ["A", "D", "B"])
    got = sorted((r.source_file, r.sheet, r.row_no, r.A, r.D, r.B) for r in df.collect())
    assert got == [
        ("b1.xlsx", "one", 2, "a", "2024-05-06 07:08:09", "1"),
        ("b1.xlsx", "one", 3, "b", "2024-01-02 00:00:00", None),
        ("b1.xlsx", "two", 2, None, None, None),
        ("b1.xlsx", "two", 3, "c", None, "7"),
        ("b2.xlsx", "s", 2, "d", None, "8"),
    ]


def test_workbook_per_sheet_equals_per_book(spark, scratch):
    sheets = [(f"s{i}", [["h0", "h1"]] + [[f"r{i}-{j}", j] for j in range(40)]) for i in range(6)]
    write(f"{scratch}/many.xlsx", write_workbook(sheets))
    a = read_workbooks(spark, scratch, [1, 0], ["B", "A"])
    b = read_workbooks(spark, scratch, [1, 0], ["B", "A"], per_sheet=True)
    cols = ["source_file", "sheet", "row_no", "A", "B"]
    assert sorted(a.select(cols).collect()) == sorted(b.select(cols).collect())
    assert b.count() == 240


def test_workbook_header_only_fails(spark, scratch):
    write(f"{scratch}/e.xlsx", write_workbook([("s", [["h0", "h1"]])]))
    with pytest.raises(PySparkException, match="no data rows"):
        read_workbooks(spark, scratch, [0, 1], ["A", "B"]).collect()


def test_workbook_header_only_fails_by_sheet_too(spark, scratch):
    write(f"{scratch}/e.xlsx", write_workbook([("s", [["h0", "h1"]]), ("t", [["h0", "h1"]])]))
    with pytest.raises(PySparkException, match="no data rows"):
        read_workbooks(spark, scratch, [0, 1], ["A", "B"], per_sheet=True).collect()


def test_workbook_read_leaves_session_settings(spark, scratch):
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    write(f"{scratch}/e.xlsx", write_workbook([("s", [["h0"]]), ("t", [["h0"], ["a"]])]))
    assert read_workbooks(spark, scratch, [0], ["A"], per_sheet=True, spread=3).count() == 1
    assert spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before


def test_workbook_too_narrow_fails(spark, scratch):
    write(f"{scratch}/n.xlsx", write_workbook([("s", [["h0", "h1"], ["a", "b"]])]))
    with pytest.raises(PySparkException, match="wrong number of columns"):
        read_workbooks(spark, scratch, [0, 5], ["A", "B"]).collect()


def test_xls_rejected(spark, scratch):
    write(f"{scratch}/old.xls", b"\xd0\xcf\x11\xe0")
    with pytest.raises(SourceError, match="old.xls"):
        read_workbooks(spark, scratch, [0], ["A"])


def test_streaming_decoder_matches_reference():
    """Brute-force check: the chunked decoder equals the element-tree one."""
    import random

    from ledgerline.sources import xlsx

    rnd = random.Random(7)
    values = [None, "", "a & b <c>", "ñandú", 0, 7, -2.5, 1e-7, 123456789012, True,
              dt.datetime(2021, 3, 4, 5, 6, 7), dt.date(1999, 12, 31), "  spaced  "]
    for shared in (True, False):
        rows = [[f"h{i}" for i in range(9)]]
        for r in range(300):
            rows.append([] if r % 37 == 5 else [rnd.choice(values) for _ in range(rnd.randint(0, 9))])
        rows.append([None, None, "last"])
        book = xlsx.Workbook(xlsx.write_workbook([("s1", rows), ("s2", rows[:50])], shared=shared))
        old_chunk = xlsx.CHUNK
        xlsx.CHUNK = 997  # force many chunk boundaries
        try:
            for _, part in book.sheets():
                for pos in ([0, 1, 2], [8, 0, 3, 5]):
                    fast = list(xlsx.sheet_records(book, part, pos))
                    ref = list(xlsx.sheet_records_reference(book, part, pos))
                    assert fast == ref
        finally:
            xlsx.CHUNK = old_chunk

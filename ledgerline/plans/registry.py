"""Registered queries (Spark) and their DuckDB oracles.

Each query reads the given tables (or data Spark derives from them) in
full and returns a DataFrame; ``ORACLES`` holds, per key, SQL that states
the same result directly.  Keys follow the operator inventory.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.functions.dates import (
    excel_serial_seconds, excel_serial_to_date, excel_serial_to_timestamp, parse_date_dmy,
    parse_date_iso, parse_timestamp_iso,
)
from ledgerline.functions.text import blank_to_null, date_shape, flag_blank, normalize_doc_type
from ledgerline.operators.chunks import chunk_columns
from ledgerline.operators.columns import select_positions, strip_all
from ledgerline.operators.cutoff import audit_one_scan, dedupe, dedupe_stored, keep_until
from ledgerline.operators.realign import realign
from ledgerline.plans import raw_views as rv
from ledgerline.plans.reports import (
    LoadContext, finish, load_os, load_sd_text, os_parsed, sd_text_parsed, sd_workbook_parsed,
)
from ledgerline.plans.sql_fixtures import OS_LOADED, SD_BASE, SD_LOADED
from ledgerline.session import scratch_path
from ledgerline.plans.run import load_reports
from ledgerline.sinks.manifest import file_system, listed
from ledgerline.sinks.publish import AlreadyLoaded, LoadError, publish, run_reports, status_frame
from ledgerline.sinks.targets import ParquetTarget
from ledgerline.sources.csv_text import (
    CP1252_BYTES, CP1252_CHARS, decode_as, detect_encoding, parse_cells, read_report_csv, repair_line,
)
from ledgerline.sources.files import SourceError
from ledgerline.sources.workbooks import decode_workbooks, workbook_files
from ledgerline.spec import OS_SPEC, SD_SPEC

# Fixed parameters of the registered checks.
CUTOFF = _dt.date(2000, 1, 1)
LOAD_TS = _dt.datetime(2024, 6, 30, 12, 0, 0)
LOAD_USER = "etl-host/loader"
CTX = LoadContext(CUTOFF, LOAD_TS, LOAD_USER)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None):
    def deco(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn
    return deco


def _orders(spark, sf):
    return rv.table(spark, sf, "orders")


# ---------------------------------------------------------------- projections

@register("strip_all", """
SELECT c.c_custkey, c.c_name, n.n_name, c.c_mktsegment, '' AS blank
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
""")
def q_strip_all(spark, sf):
    c = rv.table(spark, sf, "customer")
    n = rv.table(spark, sf, "nation")
    padded = c.join(n, c.c_nationkey == n.n_nationkey).select(
        "c_custkey",
        F.concat(F.lit("\t\u00a0 "), "c_name", F.lit("\u2003\n")).alias("c_name"),
        F.concat(F.lit("\u3000"), "n_name", F.lit(" \r\n")).alias("n_name"),
        F.concat(F.lit("\u0085"), "c_mktsegment").alias("c_mktsegment"),
        F.lit(" \t\u00a0 ").alias("blank"))
    return strip_all(padded)


@register("positional_select", """
SELECT c_mktsegment AS SEGMENT, CAST(c_custkey AS VARCHAR) AS ID, c_name AS NAME,
       CAST(NULL AS VARCHAR) AS MISSING
FROM customer
""")
def q_positional_select(spark, sf):
    c = rv.table(spark, sf, "customer")
    cells = c.select(F.array(F.col("c_custkey").cast("string"), "c_name",
                             F.col("c_nationkey").cast("string"), "c_mktsegment").alias("cells"))
    return select_positions(cells, "cells", [3, 0, 1, 7], ["SEGMENT", "ID", "NAME", "MISSING"])


# ---------------------------------------------------------------- rules

@register("doc_type", f"""
WITH {SD_BASE}
SELECT TIPO_DOC_NORM AS TIPO_DOC, CAST(count(*) AS BIGINT) AS n FROM rows_sd GROUP BY 1
""")
def q_doc_type(spark, sf):
    raw = rv.sd_raw(spark, sf)
    return (strip_all(raw, ["TIPO_DOC"]).groupBy(normalize_doc_type("TIPO_DOC").alias("TIPO_DOC"))
            .agg(F.count(F.lit(1)).alias("n")))


@register("agency_flag", f"""
WITH {SD_BASE}
SELECT k AS row_id,
       CASE WHEN VALIDO_HASTA IS NULL OR VALIDO_HASTA = '' THEN 'A' ELSE 'C' END AS AGENCIAMIENTO
FROM rows_sd
""")
def q_agency_flag(spark, sf):
    raw = rv.sd_raw(spark, sf)
    fixed = realign(strip_all(raw, list(SD_SPEC.raw_names)))
    return fixed.select("row_id", flag_blank("VALIDO_HASTA", "A", "C").alias("AGENCIAMIENTO"))


@register("blank_to_null", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS FUENTE
FROM orders
""")
def q_blank_to_null(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    src = o.select(k, F.when(k % 4 == 0, F.lit("")).otherwise(F.col("o_orderpriority")).alias("p"))
    return src.select(k, blank_to_null("p").alias("FUENTE"))


@register("date_shape", """
WITH s AS (
  SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS od FROM orders
)
SELECT k AS o_orderkey,
  CASE k % 6 WHEN 0 THEN strftime(od, '%d/%m/%Y') || ' 10:00' WHEN 1 THEN ''
             WHEN 2 THEN NULL WHEN 3 THEN strftime(od, '%-d/%-m/%Y')
             WHEN 4 THEN strftime(od, '%d-%m/%Y') ELSE '99/99/9999' END AS cell,
  CASE k % 6 WHEN 2 THEN NULL WHEN 3 THEN day(od) >= 10 AND month(od) >= 10 ELSE TRUE END
    AS looks_like_date
FROM s
""")
def q_date_shape(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("date")
    m = k % 6
    cell = (F.when(m == 0, F.concat(F.date_format(od, "dd/MM/yyyy"), F.lit(" 10:00")))
             .when(m == 1, F.lit("")).when(m == 2, F.lit(None).cast("string"))
             .when(m == 3, F.date_format(od, "d/M/yyyy"))
             .when(m == 4, F.date_format(od, "dd-MM/yyyy")).otherwise(F.lit("99/99/9999")))
    return o.select(k, cell.alias("cell")).withColumn("looks_like_date", date_shape("cell"))


_REALIGNED_COLUMNS = ", ".join(SD_SPEC.raw_names)


@register("realign_clean", f"""
WITH {SD_BASE}
SELECT k AS row_id, {_REALIGNED_COLUMNS}, CAST(kind AS INTEGER) AS shift_kind FROM rows_sd
""")
def q_realign_clean(spark, sf):
    raw = rv.sd_raw(spark, sf)
    fixed = realign(strip_all(raw, list(SD_SPEC.raw_names)), kind_column="shift_kind")
    return fixed.select("row_id", *SD_SPEC.raw_names, "shift_kind")


@register("realign_kinds", f"""
WITH {SD_BASE}
SELECT CAST(kind AS INTEGER) AS shift_kind, CAST(count(*) AS BIGINT) AS n FROM rows_sd GROUP BY 1
""")
def q_realign_kinds(spark, sf):
    raw = rv.sd_raw(spark, sf)
    fixed = realign(strip_all(raw, list(SD_SPEC.raw_names)), kind_column="shift_kind")
    return fixed.groupBy("shift_kind").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- dates

@register("parse_dates_lenient", """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 5 IN (0, 3) THEN CAST(o_orderdate AS DATE) END AS FECHA_DMY,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate AS DATE) END AS FECHA_ISO
FROM orders
""")
def q_parse_dates_lenient(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    od = F.col("o_orderdate").cast("date")
    m = k % 5
    dmy = (F.when(m == 0, F.concat(F.date_format(od, "dd/MM/yyyy"), F.lit(" 08:00:00")))
            .when(m == 1, F.lit("31/02/2024")).when(m == 2, F.lit(""))
            .when(m == 3, F.date_format(od, "d/M/yyyy")).otherwise(F.date_format(od, "dd-MM-yyyy")))
    iso = (F.when(k % 3 == 0, F.concat(F.date_format(od, "yyyy-MM-dd"), F.lit(" 00:00:00")))
            .when(k % 3 == 1, F.lit("x")).otherwise(F.lit(None).cast("string")))
    src = o.select(k, dmy.alias("dmy"), iso.alias("iso"))
    return src.select(k, parse_date_dmy("dmy").alias("FECHA_DMY"), parse_date_iso("iso").alias("FECHA_ISO"))


@register("parse_dates_strict", """
SELECT event_id, CAST(ts AS DATE) AS FECHA_DMY, CAST(CAST(ts AS DATE) AS TIMESTAMP) AS FECHA_MIDNIGHT,
       date_trunc('second', ts) AS FECHA_TS, CAST(ts AS DATE) AS DIA
FROM events
""")
def q_parse_dates_strict(spark, sf):
    e = rv.table(spark, sf, "events")
    src = e.select("event_id", F.date_format("ts", "dd/MM/yyyy HH:mm").alias("dmy"),
                   F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("iso"))
    d = parse_date_dmy("dmy", strict=True)
    ts = parse_timestamp_iso("iso", strict=True)
    return src.select("event_id", d.alias("FECHA_DMY"), d.cast("timestamp_ntz").alias("FECHA_MIDNIGHT"),
                      ts.alias("FECHA_TS"), ts.cast("date").alias("DIA"))


_SERIAL_SQL = """
WITH s AS (
  SELECT event_id, ts, date_diff('day', DATE '1899-12-30', CAST(ts AS DATE)) AS days,
         CAST(hour(ts) * 3600 + minute(ts) * 60 + second(ts) AS BIGINT) AS secs
  FROM events
), t AS (
  SELECT *, CASE WHEN event_id % 7 = 0 THEN CAST(days AS VARCHAR)
                 ELSE CAST(days AS VARCHAR) || '.' ||
                      lpad(CAST((secs * 10000000000 + 43200) // 86400 AS VARCHAR), 10, '0') END AS serial
  FROM s
)
"""


def _serial_source(spark, sf):
    e = rv.table(spark, sf, "events")
    ts = F.col("ts")
    days = F.datediff(ts.cast("date"), F.lit("1899-12-30").cast("date"))
    secs = (F.hour(ts) * 3600 + F.minute(ts) * 60 + F.second(ts)).cast("long")
    digits = F.lpad(((secs * F.lit(10_000_000_000) + 43200) / 86400).cast("long").cast("string"), 10, "0")
    serial = F.when(F.col("event_id") % 7 == 0, days.cast("string")).otherwise(
        F.concat(days.cast("string"), F.lit("."), digits))
    return e.select("event_id", serial.alias("serial"))


@register("serial_dates", _SERIAL_SQL + """
SELECT event_id, serial, CAST(ts AS DATE) AS FECHA_NAC,
       CASE WHEN event_id % 7 = 0 THEN CAST(CAST(ts AS DATE) AS TIMESTAMP)
            ELSE date_trunc('second', ts) END AS FECHA_REG
FROM t
""")
def q_serial_dates(spark, sf):
    src = _serial_source(spark, sf)
    return src.select("event_id", "serial", excel_serial_to_date("serial").alias("FECHA_NAC"),
                      excel_serial_to_timestamp("serial").alias("FECHA_REG"))


@register("serial_dates_compat", _SERIAL_SQL + """
, c AS (
  SELECT event_id, serial, days,
    CAST(trunc(CAST('0.' || split_part(serial, '.', -1) AS FLOAT) * CAST(86400 AS FLOAT)) AS INTEGER)
      AS SECONDS
  FROM t
)
SELECT event_id, serial, SECONDS,
       CAST(DATE '1899-12-30' + CAST(days AS INTEGER) AS TIMESTAMP) + to_seconds(CAST(SECONDS AS BIGINT))
         AS FECHA_REG
FROM c
""")
def q_serial_dates_compat(spark, sf):
    src = _serial_source(spark, sf)
    return src.select("event_id", "serial", excel_serial_seconds("serial", compat=True).alias("SECONDS"),
                      excel_serial_to_timestamp("serial", compat=True).alias("FECHA_REG"))


# ---------------------------------------------------------------- filters, aggregates, sorts

@register("cutoff_keep", """
SELECT o_orderkey, CAST(o_orderdate AS DATE) AS FECHA
FROM orders WHERE o_orderkey % 11 <> 0 AND CAST(o_orderdate AS DATE) <= DATE '2000-01-01'
""")
def q_cutoff_keep(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    src = o.select(k, F.when(k % 11 == 0, F.lit(None).cast("date"))
                   .otherwise(F.col("o_orderdate").cast("date")).alias("FECHA"))
    return keep_until(src, "FECHA", CUTOFF)


@register("audit_sd", f"""
WITH {SD_BASE}, {SD_LOADED},
pre AS (
  SELECT CAST(count(*) AS BIGINT) AS n_in,
         max(CASE WHEN FECHA_REG IS NOT NULL THEN od END) AS last_date,
         CAST(count(*) FILTER (WHERE FECHA_REG IS NOT NULL AND od > DATE '2000-01-01') AS BIGINT) AS excluded,
         CAST(count(*) FILTER (WHERE FECHA_REG IS NULL) AS BIGINT) AS null_date_rows
  FROM rows_sd
), post AS (
  SELECT CAST(count(*) AS BIGINT) AS n_out, CAST(min(FECHA_REG) AS DATE) AS first_date FROM loaded
)
SELECT 'SD' AS report, n_in, n_out, excluded, null_date_rows, first_date, last_date,
       strftime(first_date, '%d-%m-%Y') AS first_date_text, strftime(last_date, '%d-%m-%Y') AS last_date_text,
       CASE WHEN excluded > 0 THEN 'warn' ELSE 'info' END AS level
FROM pre, post
""")
def q_audit_sd(spark, sf):
    parsed = sd_text_parsed(rv.sd_raw(spark, sf), CTX)
    body = [c for c in SD_SPEC.output_names if c not in ("FECHA_DATA", "USUARIO_DATA")]
    return audit_one_scan(parsed, "SD", SD_SPEC.date_column, CUTOFF, body)


@register("dedupe_rows", """
SELECT DISTINCT o_custkey, o_orderstatus,
       CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE o_orderpriority END AS o_orderpriority
FROM orders
""")
def q_dedupe_rows(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    src = o.select("o_custkey", "o_orderstatus",
                   F.when(k % 4 == 0, F.lit(None).cast("string")).otherwise(F.col("o_orderpriority"))
                   .alias("o_orderpriority"))
    return dedupe(src)


@register("dedupe_stored_rows", "SELECT DISTINCT text, lang, source, n_chars FROM documents")
def q_dedupe_stored_rows(spark, sf):
    return dedupe_stored(rv.table(spark, sf, "documents").select("text", "lang", "source", "n_chars"))


@register("newest_20", f"""
WITH {SD_BASE}, {SD_LOADED}
SELECT {", ".join(SD_SPEC.preview)} FROM loaded
ORDER BY {SD_SPEC.date_column} DESC, {", ".join(SD_SPEC.preview)} LIMIT 20
""")
def q_newest_20(spark, sf):
    """The preview of a published SD load."""
    result = publish(spark, sd_text_parsed(rv.sd_raw(spark, sf), CTX), SD_SPEC, CTX, ParquetTarget(scratch_path(spark, "target")))
    return result.preview(spark, SD_SPEC)


@register("union_folder", """
SELECT CAST(c_custkey AS VARCHAR) AS ID, c_name AS NAME, CAST(c_nationkey AS VARCHAR) AS NATION, c_mktsegment AS SEGMENT FROM customer
""")
def q_union_folder(spark, sf):
    """Several report files of one folder as one frame."""
    c = rv.table(spark, sf, "customer")
    line = F.concat_ws(",", F.col("c_custkey").cast("string"), quoted(F.col("c_name")), F.col("c_nationkey").cast("string"), "c_mktsegment")
    folder = written_files(c.select(three("c_custkey"), line.alias("line")), scratch_path(spark, "csv-union"), "ID,NAME,NATION,SEGMENT")
    cells, _ = read_report_csv(spark, folder, ["ID", "NAME", "NATION", "SEGMENT"])
    return cells.drop("source_file")


@register("chunk_plan", """
WITH g AS (
  SELECT o_orderstatus AS grp, count(*) AS n FROM orders GROUP BY 1
  UNION ALL SELECT 'ALL', count(*) FROM orders
), s AS (
  SELECT grp, CAST(n AS BIGINT) AS n,
         CAST(CASE WHEN n > 8750 THEN greatest(ceil(n * 0.2), 5000) ELSE n END AS BIGINT) AS chunk_size
  FROM g
)
SELECT grp, n, chunk_size, CAST(ceil(n / chunk_size) AS BIGINT) AS n_chunks,
       CAST(n - (ceil(n / chunk_size) - 1) * chunk_size AS BIGINT) AS last_chunk
FROM s
""")
def q_chunk_plan(spark, sf):
    o = _orders(spark, sf)
    # per status and the whole table in one scan (grouping sets), not two
    both = o.rollup("o_orderstatus").agg(F.count(F.lit(1)).alias("n"), F.grouping("o_orderstatus").alias("g"))
    both = both.select(F.when(F.col("g") == 1, F.lit("ALL")).otherwise(F.col("o_orderstatus")).alias("grp"), "n")
    return both.withColumns(chunk_columns(F.col("n")))


# ---------------------------------------------------------------- text sources

@register("csv_ragged", """
SELECT CAST(o_orderkey AS VARCHAR) AS K, CAST(o_custkey AS VARCHAR) AS CUST, o_orderstatus AS STATUS,
       CASE o_orderkey % 5 WHEN 1 THEN NULL WHEN 2 THEN '' WHEN 3 THEN NULL ELSE o_orderpriority END AS PRIO
FROM orders
""")
def q_csv_ragged(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey")
    m = k % 5
    head = F.concat_ws(",", k.cast("string"), F.col("o_custkey").cast("string"), "o_orderstatus")
    line = (F.when(m == 0, F.concat(head, F.lit(","), F.col("o_orderpriority"), F.lit(",X,Y")))
             .when(m == 1, head)
             .when(m == 2, F.concat(head, F.lit(',""')))
             .when(m == 3, F.concat(head, F.lit(",")))
             .otherwise(F.concat(head, F.lit(","), F.col("o_orderpriority"))))
    cells = o.select(parse_cells(line, ["K", "CUST", "STATUS", "PRIO"]).alias("c"))
    return cells.select("c.*")


@register("csv_wrapped_repair", """
SELECT CAST(o_orderkey AS VARCHAR) AS K, o_orderstatus || ', ' || o_orderpriority AS TEXT,
       CAST(o_custkey AS VARCHAR) AS CUST
FROM orders
""")
def q_csv_wrapped_repair(spark, sf):
    o = _orders(spark, sf)
    k = F.col("o_orderkey").cast("string")
    text = F.concat("o_orderstatus", F.lit(", "), "o_orderpriority")
    cust = F.col("o_custkey").cast("string")
    plain = F.concat(k, F.lit(',"'), text, F.lit('",'), cust)
    wrapped = F.concat(F.lit('"'), F.replace(plain, F.lit('"'), F.lit('""')), F.lit('"'))
    quoted = F.concat(F.lit('"'), k, F.lit('","'), text, F.lit('","'), cust, F.lit('"'))
    m = F.col("o_orderkey") % 3
    line = F.when(m == 0, wrapped).when(m == 1, plain).otherwise(quoted)
    cells = o.select(parse_cells(repair_line(line), ["K", "TEXT", "CUST"]).alias("c"))
    return cells.select("c.*")


@register("csv_latin1", r"""
SELECT doc_id,
  CASE WHEN doc_id % 2 = 0 OR NOT regexp_matches(text, '[^\x{00}-\x{7F}]') OR regexp_matches(text, '[^\x{00}-\x{FF}]')
       THEN 'UTF-8' ELSE 'ISO-8859-1' END AS encoding, text
FROM documents
""")
def q_csv_latin1(spark, sf):
    """Whole texts as bytes, every second one in ISO-8859-1 where it can be, and back by the readers' encoding rule."""
    d = rv.table(spark, sf, "documents")
    as_utf8 = (F.col("doc_id") % 2 == 0) | F.col("text").rlike(r"[^\x{00}-\x{FF}]")
    enc = F.when(as_utf8, F.encode("text", "UTF-8")).otherwise(
        F.encode(F.when(as_utf8, F.lit("")).otherwise(F.col("text")), "ISO-8859-1"))
    raw = d.select("doc_id", enc.alias("content"))
    detected = raw.withColumn("encoding", detect_encoding(F.col("content")))
    return detected.select("doc_id", "encoding", decode_as(F.col("content"), F.col("encoding")).alias("text"))


def written_files(lines: DataFrame, folder: str, header: str) -> list[str]:
    """Text files of whole ``line`` values, one per ``part``, each with a header line first; their paths."""
    heads = lines.select("part").distinct().select("part", F.lit(0).alias("place"), F.lit(header).alias("line"))
    rows = heads.unionByName(lines.where("line is not null").select("part", F.lit(1).alias("place"), "line"))
    (rows.repartition("part").sortWithinPartitions("part", "place").select("part", F.col("line").alias("value"))
     .write.partitionBy("part").option("lineSep", "\n").text(folder))
    spark = lines.sparkSession
    return [r.path for r in spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.txt")
            .load(folder).select("path").collect()]


def three(key: str):
    return F.concat(F.lit("p"), (F.col(key) % 3).cast("string")).alias("part")


def quoted(c):
    return F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"'))


def spread_files(lines: DataFrame, folder: str, header: str, encoding: str = "UTF-8") -> str:
    """A text file of whole ``line`` values per task, each with a header line first (after a byte-order mark in UTF-16)."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    mark = "\ufeff" if encoding.startswith("UTF-16") else ""
    text = F.when(place == 0, F.concat(F.lit(f"{mark}{header}\n"), "line")).otherwise(F.col("line"))
    if encoding == "windows-1252":
        text, encoding = F.translate(text, CP1252_CHARS, CP1252_BYTES), "ISO-8859-1"
    value = F.encode(text, encoding).cast("string")  # bytes pass through the text writer as they are
    lines.select(value.alias("value")).write.mode("append").option("encoding", encoding).option("lineSep", "\n").text(folder)
    return folder


def _text_files(spark, folder: str) -> list[str]:
    return [r.path for r in spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select("path").collect()]


CP1252_TAIL = " \u20ac\u201c\u0178\u201d \u00e9"  # characters that ISO-8859-1 lacks, and one that makes the bytes no UTF-8


QUOTED_NEWLINE_SQL = """
SELECT CAST(doc_id AS VARCHAR) AS ID, replace(text, chr(13), ' ') AS TEXT, source AS SOURCE FROM documents
"""


def _quoted_newline(spark, sf, encodings):
    d = rv.table(spark, sf, "documents")
    text = F.replace("text", F.lit("\r"), F.lit(" "))
    line = F.concat_ws(",", F.col("doc_id").cast("string"), quoted(text), "source")
    folder = scratch_path(spark, "csv-newline")
    for k, encoding in enumerate(encodings):
        spread_files(d.where(F.pmod("doc_id", F.lit(len(encodings))) == k).select(line.alias("line")), folder, "ID,TEXT,SOURCE", encoding)
    cells, _ = read_report_csv(spark, _text_files(spark, folder), ["ID", "TEXT", "SOURCE"])
    return cells.select("ID", "TEXT", "SOURCE")


@register("csv_quoted_newline", QUOTED_NEWLINE_SQL)
def q_csv_quoted_newline(spark, sf):
    """Files whose quoted cells hold line breaks and quotes, read back whole."""
    return _quoted_newline(spark, sf, ["UTF-8"])


@register("csv_quoted_newline_utf16", QUOTED_NEWLINE_SQL)
def q_csv_quoted_newline_utf16(spark, sf):
    """The same with files in UTF-16 of either byte order and in UTF-8."""
    return _quoted_newline(spark, sf, ["UTF-16LE", "UTF-16BE", "UTF-8"])


@register("csv_wrapped_header", """
SELECT CAST(o_orderkey AS VARCHAR) AS K, o_orderstatus || ', ' || o_orderpriority AS TEXT, CAST(o_custkey AS VARCHAR) AS CUST,
       'repaired' AS read_mode
FROM orders
""")
def q_csv_wrapped_header(spark, sf):
    """Files in which a tool has wrapped whole lines in quotes, the header too."""
    o = _orders(spark, sf)
    text = F.concat("o_orderstatus", F.lit(", "), "o_orderpriority")
    line = quoted(F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted(text), F.col("o_custkey").cast("string")))
    folder = written_files(o.select(three("o_orderkey"), line.alias("line")), scratch_path(spark, "csv-header"), '"K,""TEXT"",CUST"')
    cells, facts = read_report_csv(spark, folder, ["K", "TEXT", "CUST"])
    return cells.select("K", "TEXT", "CUST", F.lit(facts["read_mode"]).alias("read_mode"))


@register("csv_wrapped_terminators", """
SELECT CAST(o_orderkey AS VARCHAR) AS K,
       o_orderstatus || CASE o_orderkey % 3 WHEN 0 THEN chr(133) WHEN 1 THEN chr(8232) ELSE chr(8233) END || '"' || o_orderpriority AS TEXT
FROM orders
""")
def q_csv_wrapped_terminators(spark, sf):
    """Wrapped lines that hold U+0085, U+2028 or U+2029."""
    o = _orders(spark, sf)
    m = F.col("o_orderkey") % 3
    mark = F.when(m == 0, F.lit("\u0085")).when(m == 1, F.lit("\u2028")).otherwise(F.lit("\u2029"))
    text = F.concat("o_orderstatus", mark, F.lit('"'), "o_orderpriority")
    line = quoted(F.concat_ws(",", F.col("o_orderkey").cast("string"), quoted(text)))
    folder = written_files(o.select(three("o_orderkey"), line.alias("line")), scratch_path(spark, "csv-marks"), "K,TEXT")
    cells, _ = read_report_csv(spark, folder, ["K", "TEXT"])
    return cells.select("K", "TEXT")


@register("csv_mixed_encodings", r"""
WITH d AS (SELECT doc_id, replace(replace(text, chr(13), ' '), chr(10), ' ') AS t FROM documents), l AS (
  SELECT doc_id, t, CASE WHEN doc_id % 4 = 0 THEN 'UTF-16LE' WHEN doc_id % 4 = 1 OR regexp_matches(t, '[^\x{00}-\x{7F}\x{A0}-\x{FF}]') THEN 'UTF-8'
                         WHEN doc_id % 4 = 2 THEN 'ISO-8859-1' ELSE 'windows-1252' END AS e FROM d)
SELECT e AS folder_part, CAST(doc_id AS VARCHAR) AS ID, CASE WHEN e = 'windows-1252' THEN t || '{TAIL}' ELSE t END AS TEXT,
       'plain' AS read_mode, 4 AS n_encodings FROM l
""".replace("{TAIL}", CP1252_TAIL))
def q_csv_mixed_encodings(spark, sf):
    """One folder of UTF-8, ISO-8859-1, windows-1252 and UTF-16 files, read in one call; whole texts."""
    d = rv.table(spark, sf, "documents")
    t = F.replace(F.replace("text", F.lit("\r"), F.lit(" ")), F.lit("\n"), F.lit(" "))
    k = F.col("doc_id")
    kind = (F.when(k % 4 == 0, F.lit("UTF-16LE")).when((k % 4 == 1) | t.rlike(r"[^\x{00}-\x{7F}\x{A0}-\x{FF}]"), F.lit("UTF-8"))
             .when(k % 4 == 2, F.lit("ISO-8859-1")).otherwise(F.lit("windows-1252")))
    t = F.when(kind == "windows-1252", F.concat(t, F.lit(CP1252_TAIL))).otherwise(t)
    rows = d.select(kind.alias("kind"), F.concat_ws(",", kind, k.cast("string"), quoted(t)).alias("line"))
    folder = scratch_path(spark, "csv-mixed")
    for encoding in ("UTF-8", "ISO-8859-1", "windows-1252", "UTF-16LE"):
        spread_files(rows.where(F.col("kind") == encoding).select("line"), folder, "PART,ID,TEXT", encoding)
    cells, facts = read_report_csv(spark, _text_files(spark, folder), ["PART", "ID", "TEXT"])
    return cells.select(F.col("PART").alias("folder_part"), "ID", "TEXT", F.lit(facts["read_mode"]).alias("read_mode"),
                        F.lit(len(facts["encodings"])).alias("n_encodings"))


# ---------------------------------------------------------------- whole loads

@register("load_sd", f"""
WITH {SD_BASE}, {SD_LOADED}
SELECT * FROM loaded
""")
def q_load_sd(spark, sf):
    return finish(sd_text_parsed(rv.sd_raw(spark, sf), CTX), SD_SPEC, CTX)


@register("load_os", OS_LOADED)
def q_load_os(spark, sf):
    return load_os(rv.os_raw(spark, sf), CTX)


# ---------------------------------------------------------------- workbooks

@register("xlsx_scan", """
SELECT 'book_' || CAST(s_suppkey // 100 AS VARCHAR) || '.xlsx' AS source_file, 'xlsx' AS source_format,
       'S' || CAST(s_suppkey % 2 AS VARCHAR) AS sheet,
       CAST(s_suppkey AS VARCHAR) AS ID, s_name AS NAME, CAST(s_nationkey AS VARCHAR) AS NATION,
       CASE WHEN s_acctbal = trunc(s_acctbal) THEN CAST(CAST(s_acctbal AS BIGINT) AS VARCHAR)
            ELSE CAST(s_acctbal AS VARCHAR) END AS BALANCE,
       strftime(TIMESTAMP '2000-01-01 00:00:00' + to_days(CAST(s_suppkey AS INTEGER))
                + to_seconds(s_suppkey % 86400), '%Y-%m-%d %H:%M:%S') AS SINCE
FROM supplier
""")
def q_xlsx_scan(spark, sf):
    s = rv.table(spark, sf, "supplier")
    k = F.col("s_suppkey")
    since = (F.lit("2000-01-01 00:00:00").cast("timestamp_ntz")
             + F.make_dt_interval(k.cast("int"), F.lit(0), F.lit(0), (k % 86400).cast("decimal(18,6)")))
    rows = s.select("s_suppkey", "s_name", "s_nationkey", "s_acctbal", since.alias("s_since"),
                    F.expr("s_suppkey div 100").alias("book"), (k % 2).alias("sheet"))
    files = workbook_files(rows, "book", "sheet", ["s_suppkey", "s_name", "s_nationkey", "s_acctbal", "s_since"])
    cells = decode_workbooks(files, [0, 1, 2, 3, 4])
    return cells.select("source_file", "source_format", "sheet",
                        *[F.get("cells", i).alias(n) for i, n in enumerate(["ID", "NAME", "NATION", "BALANCE", "SINCE"])])


def sd_workbook_source(spark, sf):
    """SD workbooks (18 source columns, typed cells) derived from the tables."""
    base = rv.order_customer(spark, sf)
    k = F.col("k")
    od = F.col("o_orderdate").cast("date")
    at = lambda d: d.cast("timestamp_ntz")
    rows = base.select(
        k, F.expr("k div 2000").alias("book"), (k % 2).alias("sheet"),
        rv._doc_type(k).alias("TIPO_DOCUMENTO"),
        F.lpad(F.col("c_custkey").cast("string"), 11, "0").alias("PID"),
        F.col("c_name").alias("NOMBRE"), F.lit("X").alias("AP_PATERNO"), F.lit("Y").alias("AP_MATERNO"),
        F.concat("c_name", F.lit(" SA")).alias("RAZON_SOCIAL"),
        F.when(k % 13 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(at(F.date_sub(od, (F.lit(7300) + k % 9000).cast("int")))).alias("F_NACIMIENTO"),
        F.col("o_orderstatus").alias("TIPO_ENTIDAD"),
        F.when(k % 19 == 0, F.lit(None).cast("timestamp_ntz"))
         .otherwise(at(od) + F.make_dt_interval(F.lit(0), F.lit(10), F.lit(11), F.lit(12))).alias("F_REGISTRO"),
        F.col("o_orderpriority").alias("FUENTE_DATO"), F.col("n_name").alias("NACIONALIDAD"),
        F.col("c_mktsegment").alias("NOM_REL"), F.col("c_nationkey").alias("AGEN_FAMIL"),
        F.concat(F.lit("BK "), F.col("c_nationkey").cast("string")).alias("NOMBRE_BK"),
        at(F.date_add(od, 30)).alias("VALIDO_DESDE"),
        F.when(k % 3 == 0, F.lit(None).cast("string")).when(k % 3 == 1, F.lit(""))
         .otherwise(F.date_format(F.date_add(od, 365), "yyyy-MM-dd")).alias("VALIDO_HASTA"),
        F.concat(F.lit("U"), (k % 50).cast("string")).alias("USU"),
        at(F.date_add(od, 1)).alias("REGISTRATION_DATE"))
    columns = rows.columns[3:]
    return workbook_files(rows, "book", "sheet", columns)


@register("load_sd_workbook", """
WITH b AS (
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS od, o.o_orderstatus, o.o_orderpriority,
         c.c_custkey, c.c_name, c.c_mktsegment, c.c_nationkey, n.n_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
)
SELECT DISTINCT
  CASE k % 6 WHEN 0 THEN 'RUC' WHEN 1 THEN 'PT' WHEN 2 THEN 'CE' WHEN 3 THEN 'DNI' WHEN 4 THEN 'RUC' END AS TIPO_DOC,
  lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS NRO_DOC, c_name || ' SA' AS NOMBRE_CLIENTE,
  CASE WHEN k % 13 = 0 THEN NULL ELSE od - CAST(7300 + k % 9000 AS INTEGER) END AS FECHA_NAC,
  o_orderstatus AS TIPO_ENTIDAD, CAST(od AS TIMESTAMP) + INTERVAL '10:11:12' AS FECHA_REG,
  o_orderpriority AS FUENTE, n_name AS NACIONALIDAD, c_mktsegment AS RAMOS,
  CAST(c_nationkey AS VARCHAR) AS COD_BROKER, 'BK ' || CAST(c_nationkey AS VARCHAR) AS BROKER,
  'U' || CAST(k % 50 AS VARCHAR) AS USUARIO,
  CASE WHEN k % 3 IN (0, 1) THEN 'A' ELSE 'C' END AS AGENCIAMIENTO,
  TIMESTAMP '2024-06-30 12:00:00' AS FECHA_DATA, 'etl-host/loader' AS USUARIO_DATA
FROM b WHERE k % 19 <> 0 AND od <= DATE '2000-01-01'
""")
def q_load_sd_workbook(spark, sf):
    cells = decode_workbooks(sd_workbook_source(spark, sf), SD_SPEC.positions)
    raw = cells.select("source_format", *[F.get("cells", i).alias(n) for i, n in enumerate(SD_SPEC.raw_names)])
    return finish(sd_workbook_parsed(raw, CTX, F.col("source_format")), SD_SPEC, CTX)


# ---------------------------------------------------------------- CSV report folders

@register("load_sd_csv_folder", f"""
WITH {SD_BASE}, {SD_LOADED}
SELECT * FROM loaded
""")
def q_load_sd_csv_folder(spark, sf):
    """SD view written as CSV report files (a quarter of the lines wrapped in
    quotes) to the shared folder, then read back as a folder and loaded."""
    folder = rv.write_csv_reports(rv.sd_raw(spark, sf), SD_SPEC.raw_names,
                                  scratch_path(spark, "csv-sd"), files=4, wrap_every=4)
    cells, _ = read_report_csv(spark, folder, SD_SPEC.raw_names)
    return load_sd_text(cells, CTX)


@register("load_os_workbook", OS_LOADED)
def q_load_os_workbook(spark, sf):
    """OS view written as workbooks (text cells, one book per 2,000 orders, two
    sheets each), decoded by position and loaded."""
    raw = rv.os_raw(spark, sf).withColumns({"book": F.expr("row_id div 2000"), "sheet": F.col("row_id") % 2})
    files = workbook_files(raw, "book", "sheet", ["row_id", *OS_SPEC.raw_names], shared=False)
    cells = decode_workbooks(files, [i + 1 for i in OS_SPEC.positions])
    named = cells.select(*[F.get("cells", i).alias(n) for i, n in enumerate(OS_SPEC.raw_names)])
    return load_os(named, CTX)


# ---------------------------------------------------------------- load control

AUDIT_SQL = f"""
WITH {SD_BASE}, {SD_LOADED},
pre AS (
  SELECT CAST(count(*) AS BIGINT) AS n_in, max(CASE WHEN FECHA_REG IS NOT NULL THEN od END) AS last_date,
         CAST(count(*) FILTER (WHERE FECHA_REG IS NOT NULL AND od > DATE 'CUTOFF') AS BIGINT) AS excluded,
         CAST(count(*) FILTER (WHERE FECHA_REG IS NULL) AS BIGINT) AS null_date_rows
  FROM rows_sd
), post AS (
  SELECT CAST(count(*) AS BIGINT) AS n_out, CAST(min(FECHA_REG) AS DATE) AS first_date FROM loaded
  WHERE CAST(FECHA_REG AS DATE) <= DATE 'CUTOFF'
)
SELECT 'SD' AS report, n_in, n_out, excluded, null_date_rows, first_date, last_date, 'plain' AS read_mode, 'loaded' AS status
FROM pre, post
"""


def _published_audit(spark, sf, cutoff):
    ctx = LoadContext(cutoff, LOAD_TS, LOAD_USER)
    result = publish(spark, sd_text_parsed(rv.sd_raw(spark, sf), ctx), SD_SPEC, ctx, ParquetTarget(scratch_path(spark, "target")), on_empty="ok")
    return result.audit_frame(spark).drop("elapsed_s")


@register("publish_audit", AUDIT_SQL.replace("CUTOFF", "2000-01-01"))
def q_publish_audit(spark, sf):
    """The audit row that publishing the SD view returns."""
    return _published_audit(spark, sf, CUTOFF)


@register("publish_audit_all_excluded", AUDIT_SQL.replace("CUTOFF", "1980-01-01"))
def q_publish_audit_all_excluded(spark, sf):
    """The same where the cut-off excludes every row."""
    return _published_audit(spark, sf, _dt.date(1980, 1, 1))


@register("append_guard", f"""
WITH {SD_BASE}, {SD_LOADED}, n AS (SELECT CAST(count(*) AS BIGINT) AS n FROM loaded)
SELECT 1 AS step, 'loaded' AS status, n AS n_rows, DATE '2024-06-30' AS last_load FROM n
UNION ALL SELECT 2, 'skipped', n, DATE '2024-06-30' FROM n
UNION ALL SELECT 3, 'refused', n, DATE '2024-06-30' FROM n
UNION ALL SELECT 4, 'loaded', 2 * n, DATE '2024-06-30' FROM n
""")
def q_append_guard(spark, sf):
    """Load, skip, refuse and append on one target: its rows and last load date after each."""
    target = ParquetTarget(scratch_path(spark, "target"))
    parsed = sd_text_parsed(rv.sd_raw(spark, sf), CTX)
    out = []
    for step, guard in enumerate(("fail", "skip", "fail", "append"), 1):
        try:
            status = publish(spark, parsed, SD_SPEC, CTX, target, guard=guard).audit["status"]
        except AlreadyLoaded:
            status = "refused"
        out.append((step, status, target.read(spark).count(), target.last_load_date(spark)))
    return spark.createDataFrame(out, "step int, status string, n_rows bigint, last_load date")


class _Stops(ParquetTarget):
    """A target whose writer dies after its files are in place and before the version is."""

    def _publish(self, spark, snapshot):
        raise ConnectionError("the driver stops here")


class _Overtaken(ParquetTarget):
    """A target on which another writer publishes a load after this one was let through and before its version is there."""

    def _publish(self, spark, snapshot):
        rival, last = ParquetTarget(self.path), snapshot.loads[-1]
        if snapshot.version == 1:
            rival._publish(spark, snapshot.__class__(snapshot.version, (*snapshot.loads[:-1], _copy_of(spark, self.path, last))))
        super()._publish(spark, snapshot)


def _copy_of(spark, home, load):
    """The rival's load: the same rows in files of its own."""
    folder = f"{load.folder}-rival"
    spark.read.parquet(f"{home}/{load.folder}").write.parquet(f"{home}/{folder}")
    return replace(load, folder=folder)


@register("publish_atomic", f"""
WITH {SD_BASE}, {SD_LOADED}, n AS (SELECT CAST(count(*) AS BIGINT) AS n FROM loaded)
SELECT 1 AS step, 'loaded' AS status, n AS n_rows, 1 AS version, n AS n_first FROM n
UNION ALL SELECT 2, 'stopped', n, 1, n FROM n
UNION ALL SELECT 3, 'loaded', 2 * n, 2, n FROM n
""")
def q_publish_atomic(spark, sf):
    """A load, one that stops when its files are in the folder, and its repeat: what readers see after each."""
    home = scratch_path(spark, "target")
    parsed = sd_text_parsed(rv.sd_raw(spark, sf), CTX)
    out = []
    for step, kind in enumerate((ParquetTarget, _Stops, ParquetTarget), 1):
        try:
            status = publish(spark, parsed, SD_SPEC, CTX, kind(home), guard="append").audit["status"]
        except ConnectionError:
            status = "stopped"
        target = ParquetTarget(home)
        out.append((step, status, target.read(spark).count(), target.snapshot(spark).version, target.read(spark, 1).count()))
    return spark.createDataFrame(out, "step int, status string, n_rows bigint, version int, n_first bigint")


@register("guard_concurrent", f"""
WITH {SD_BASE}, {SD_LOADED}, n AS (SELECT CAST(count(*) AS BIGINT) AS n FROM loaded)
SELECT 'fail' AS guard, 'refused' AS status, n AS n_rows, 1 AS loads FROM n
UNION ALL SELECT 'skip', 'skipped', n, 1 FROM n
UNION ALL SELECT 'append', 'loaded', 2 * n, 2 FROM n
""")
def q_guard_concurrent(spark, sf):
    """Two loads of one day that both pass the first check: one is in the table, the other as its guard says."""
    parsed = sd_text_parsed(rv.sd_raw(spark, sf), CTX)
    out = []
    for guard in ("fail", "skip", "append"):
        target = _Overtaken(scratch_path(spark, "target"))
        try:
            status = publish(spark, parsed, SD_SPEC, CTX, target, guard=guard).audit["status"]
        except AlreadyLoaded:
            status = "refused"
        out.append((guard, status, target.read(spark).count(), len(target.snapshot(spark).loads)))
    return spark.createDataFrame(out, "guard string, status string, n_rows bigint, loads int")


@register("quarantine_dates", """
WITH k AS (SELECT o_orderkey AS k, CAST(o_orderdate AS DATE) AS od, CASE WHEN o_orderkey % 17 = 0 THEN 2 ELSE 1 END AS c FROM orders)
SELECT 'FECHA_CREA is no date' AS what, CAST(coalesce(sum(c) FILTER (k % 29 = 0 AND k % 31 <> 0), 0) AS BIGINT) AS n_rows FROM k
UNION ALL SELECT 'ID is no number', CAST(coalesce(sum(c) FILTER (k % 31 = 0 AND k % 29 <> 0), 0) AS BIGINT) FROM k
UNION ALL SELECT 'ID is no number; FECHA_CREA is no date', CAST(coalesce(sum(c) FILTER (k % 31 = 0 AND k % 29 = 0), 0) AS BIGINT) FROM k
UNION ALL SELECT 'loaded', count(*) FILTER (k % 29 <> 0 AND k % 31 <> 0 AND k % 23 <> 0 AND od <= DATE '2000-01-01') FROM k
UNION ALL SELECT 'excluded', CAST(coalesce(sum(c) FILTER (k % 29 <> 0 AND k % 31 <> 0 AND k % 23 <> 0 AND od > DATE '2000-01-01'), 0) AS BIGINT) FROM k
UNION ALL SELECT 'undated', CAST(coalesce(sum(c) FILTER (k % 29 <> 0 AND k % 31 <> 0 AND k % 23 = 0), 0) AS BIGINT) FROM k
UNION ALL SELECT 'all', CAST(sum(c) AS BIGINT) FROM k
UNION ALL SELECT 'quarantined', CAST(coalesce(sum(c) FILTER (k % 29 = 0 OR k % 31 = 0), 0) AS BIGINT) FROM k
""")
def q_quarantine_dates(spark, sf):
    """An OS load in which every 29th date and every 31st id do not parse: good rows are loaded, bad ones set aside."""
    k = F.col("row_id")
    raw = rv.os_raw(spark, sf).withColumn("FECHA_CREA", F.when(k % 29 == 0, F.lit("31/02/2024")).otherwise(F.col("FECHA_CREA"))) \
        .withColumn("ID", F.when(k % 31 == 0, F.concat(F.lit("n"), "ID")).otherwise(F.col("ID")))
    target, aside = ParquetTarget(scratch_path(spark, "target")), scratch_path(spark, "quarantine")
    a = publish(spark, os_parsed(raw, CTX, on_bad="quarantine"), OS_SPEC, CTX, target, quarantine=aside).audit
    bad = spark.read.parquet(aside).groupBy(F.col("fault").alias("what")).agg(F.sum("copies").alias("n_rows"))
    rest = [("loaded", target.read(spark).count()), ("excluded", a["excluded"]), ("undated", a["null_date_rows"]), ("all", a["n_in"]),
            ("quarantined", a["quarantined"])]
    return bad.unionByName(spark.createDataFrame(rest, "what string, n_rows bigint"))


@register("load_reports_folders", f"""
WITH {SD_BASE}, {SD_LOADED}
SELECT 'SD' AS report, 'loaded' AS status, 'repaired' AS read_mode, CAST(count(*) AS BIGINT) AS n_out FROM loaded
UNION ALL SELECT 'OS', 'failed: wrong number of columns', NULL, NULL
UNION ALL SELECT 'SD', 'not run', NULL, NULL
""")
def q_load_reports_folders(spark, sf):
    """``load_reports`` over written CSV folders: wrapped SD lines are repaired, an OS folder of the wrong width stops the run."""
    sd, narrow = scratch_path(spark, "sd-csv"), scratch_path(spark, "os-csv")
    rows = rv.sd_raw(spark, sf)
    cell = lambda c: F.coalesce(quoted(F.col(c)), F.lit(""))
    line = F.concat_ws(",", *[cell(c) for c in SD_SPEC.raw_names])
    spread_files(rows.select(F.when(F.col("row_id") % 2 == 0, quoted(line)).otherwise(line).alias("line")), sd, ",".join(SD_SPEC.raw_names))
    spread_files(rv.os_raw(spark, sf).select(F.concat_ws(",", cell("ID"), cell("TIPO_DOC")).alias("line")), narrow, "ID,TIPO_DOC")
    sources = [_csv_folder(spark, x) for x in (sd, narrow)]
    jobs = [("SD", sources[0], ParquetTarget(scratch_path(spark, "target"))), ("OS", sources[1], ParquetTarget(scratch_path(spark, "target"))),
            ("SD", sources[0], ParquetTarget(scratch_path(spark, "target")))]
    try:
        audits = load_reports(spark, jobs, CUTOFF, load_ts=LOAD_TS, load_user=LOAD_USER)
    except LoadError as e:
        audits = e.audits
    status = F.regexp_extract("status", "^(failed: wrong number of columns|[a-z ]+)", 1)
    return status_frame(spark, audits).select("report", status.alias("status"), "read_mode", "n_out")


def _csv_folder(spark, folder: str) -> str:
    """The folder with its text files named as CSV files."""
    for f in listed(spark, folder):
        p, fs = file_system(spark, f.getPath().toString())
        if p.getName().endswith(".txt"):
            fs.rename(p, p.suffix(".csv"))
    return folder


@register("load_status", f"""
WITH {SD_BASE}, {SD_LOADED}
SELECT 'SD' AS report, 'loaded' AS status, CAST(count(*) AS BIGINT) AS n_out FROM loaded
UNION ALL SELECT 'OS', 'failed', NULL
UNION ALL SELECT 'OS2', 'not run', NULL
""")
def q_load_status(spark, sf):
    """Outcomes of a run whose second report fails."""
    def fails():
        os_rows = rv.os_raw(spark, sf).withColumn("FECHA_CREA", F.lit("not a date"))
        return publish(spark, os_parsed(os_rows, CTX), OS_SPEC, CTX, ParquetTarget(scratch_path(spark, "target")))
    try:
        audits = run_reports([
            ("SD", lambda: publish(spark, sd_text_parsed(rv.sd_raw(spark, sf), CTX), SD_SPEC, CTX, ParquetTarget(scratch_path(spark, "target")))),
            ("OS", fails), ("OS2", fails)])
    except LoadError as e:
        audits = e.audits
    return status_frame(spark, audits).select("report", F.split("status", ":")[0].alias("status"), "n_out")


@register("schema_report", "SELECT * FROM (VALUES " + ", ".join(
    f"({i}, '{n}', '{t}')" for i, (n, t) in enumerate(
        (n, {"FECHA_NAC": "date", "FECHA_REG": "timestamp_ntz", "FECHA_DATA": "timestamp_ntz"}.get(n, "string")) for n in SD_SPEC.output_names)) + ') t(position, "column", "type")')
def q_schema_report(spark, sf):
    """Schema of a published SD load, read from the target."""
    result = publish(spark, sd_text_parsed(rv.sd_raw(spark, sf), CTX), SD_SPEC, CTX, ParquetTarget(scratch_path(spark, "target")))
    return result.schema_frame(spark)


@register("empty_files", """
SELECT DISTINCT 'nation' || CAST(c_nationkey AS VARCHAR) AS part, CAST(1 AS BIGINT) AS lines FROM customer WHERE c_nationkey % 2 = 1
""")
def q_empty_files(spark, sf):
    """The files without data rows that a read reports: one file per nation, those of odd nations with a header only."""
    c = rv.table(spark, sf, "customer")
    even = F.when(F.col("c_nationkey") % 2 == 0, F.concat_ws(",", F.col("c_custkey").cast("string"), "c_name"))
    lines = c.select(F.concat(F.lit("nation"), F.col("c_nationkey").cast("string")).alias("part"), even.alias("line"))
    try:
        read_report_csv(spark, written_files(lines, scratch_path(spark, "csv-empty"), "ID,NAME"), ["ID", "NAME"])
        raise AssertionError("empty files were read")
    except SourceError as e:
        return e.files.select(F.regexp_extract("path", "part=(nation[0-9]+)", 1).alias("part"), "lines")


@register("load_sd_serial", """
WITH b AS (
  SELECT o.o_orderkey AS k, CAST(o.o_orderdate AS DATE) AS od, o.o_orderstatus, c.c_custkey, c.c_name
  FROM orders o JOIN customer c ON o.o_custkey = c.c_custkey
)
SELECT DISTINCT compat, lpad(CAST(c_custkey AS VARCHAR), 11, '0') AS NRO_DOC, c_name AS NOMBRE_CLIENTE,
       od - CAST(7300 + k % 9000 AS INTEGER) AS FECHA_NAC, o_orderstatus AS TIPO_ENTIDAD,
       CASE WHEN k % 2 = 0 THEN CAST(od AS TIMESTAMP) + INTERVAL '10:11:12'
            ELSE CAST(od AS TIMESTAMP) + INTERVAL '12:00:00' END AS FECHA_REG
FROM b, (VALUES (FALSE), (TRUE)) t(compat) WHERE od <= DATE '2000-01-01'
""")
def q_load_sd_serial(spark, sf):
    """SD rows of a folder that mixes ISO text (even orders) and serial dates (odd ones), by default and by the compatible rule."""
    base = rv.order_customer(spark, sf)
    k, od = F.col("k"), F.col("o_orderdate").cast("date")
    days = F.datediff(od, F.lit("1899-12-30").cast("date"))
    born = F.date_sub(od, (F.lit(7300) + k % 9000).cast("int"))
    text = k % 2 == 0
    cells = {n: F.lit("") for n in SD_SPEC.raw_names} | {
        "NRO_DOC": F.lpad(F.col("c_custkey").cast("string"), 11, "0"), "NOMBRE_CLIENTE": F.col("c_name"), "TIPO_ENTIDAD": F.col("o_orderstatus"),
        "FECHA_NAC": F.when(text, F.date_format(born, "yyyy-MM-dd 00:00:00")).otherwise(F.datediff(born, F.lit("1899-12-30").cast("date")).cast("string")),
        "FECHA_REG": F.when(text, F.date_format(od, "yyyy-MM-dd 10:11:12")).otherwise(F.concat(days.cast("string"), F.lit(".5")))}
    raw = base.select(F.when(text, F.lit("xlsx")).otherwise(F.lit("xls")).alias("source_format"), *[v.alias(n) for n, v in cells.items()])
    out = None
    for compat in (False, True):
        rows = finish(sd_workbook_parsed(raw, CTX, F.col("source_format"), compat=compat), SD_SPEC, CTX)
        part = rows.select(F.lit(compat).alias("compat"), "NRO_DOC", "NOMBRE_CLIENTE", "FECHA_NAC", "TIPO_ENTIDAD", "FECHA_REG")
        out = part if out is None else out.unionByName(part)
    return out

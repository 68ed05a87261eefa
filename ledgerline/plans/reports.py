"""SD and OS report transforms.

Each load is split in two pure steps so the audit can see both sides:

* ``*_parsed``: every input row, cleaned and typed (before the cut-off);
* ``finish``: cut-off filter, final column order and full-row de-duplication.

The load timestamp and user are literals fixed once per run, not
``current_timestamp()``, so every report of one run carries the same stamp.
"""

from __future__ import annotations

import datetime as _dt
import getpass
import socket
import uuid
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from ledgerline.functions.dates import (
    excel_serial_to_date, excel_serial_to_timestamp, parse_cutoff, parse_date_dmy, parse_date_iso,
    parse_timestamp_iso,
)
from ledgerline.functions.text import blank_to_null, flag_blank, normalize_doc_type
from ledgerline.operators.columns import strip_all
from ledgerline.operators.cutoff import dedupe, keep_until, pre_cutoff_metrics
from ledgerline.operators.realign import realign
from ledgerline.spec import OS_SPEC, SD_SPEC, ReportSpec


def default_user() -> str:
    return f"{socket.gethostname()}/{getpass.getuser()}"


@dataclass(frozen=True)
class LoadContext:
    cutoff: _dt.date
    load_ts: _dt.datetime = field(default_factory=lambda: _dt.datetime.now().replace(microsecond=0))
    load_user: str = field(default_factory=default_user)

    @staticmethod
    def of(cutoff, load_ts=None, load_user=None) -> "LoadContext":
        kw = {"cutoff": parse_cutoff(cutoff)}
        if load_ts is not None:
            kw["load_ts"] = load_ts
        if load_user is not None:
            kw["load_user"] = load_user
        return LoadContext(**kw)


def _stamp(ctx: LoadContext) -> dict[str, Column]:
    return {"FECHA_DATA": F.lit(ctx.load_ts).cast("timestamp_ntz"),
            "USUARIO_DATA": F.lit(ctx.load_user)}


#: What ``on_bad="quarantine"`` adds: why a row is set aside (null for good rows), and its raw cells as JSON.
FAULT, RAW = "__fault", "__raw"


def _set_aside(df: DataFrame, raw_names: tuple[str, ...], strict: dict[str, tuple[Column, str]]) -> DataFrame:
    """Parse each column of ``strict`` (name -> lenient parse, what it should be): a value that does not parse makes a
    fault instead of an error."""
    faults = [F.when(F.col(c).isNotNull() & parsed.isNull(), F.lit(f"{c} is no {what}")) for c, (parsed, what) in strict.items()]
    text = F.concat_ws("; ", *faults)
    fault = F.when(text != "", text)
    return df.withColumns({FAULT: fault, RAW: F.when(fault.isNotNull(), F.to_json(F.struct(*raw_names)))}) \
        .withColumns({c: parsed for c, (parsed, _) in strict.items()})


def sd_text_parsed(raw: DataFrame, ctx: LoadContext, realign_rows: bool = True,
                   keep: tuple[str, ...] = (), on_bad: str = "fail") -> DataFrame:
    """SD rows from a day-first text source (CSV): trim, realign, classify, parse.

    A registration date that does not parse is an error, or with
    ``on_bad="quarantine"`` a fault of its row (for ``publish(quarantine=...)``).
    """
    df = strip_all(raw.select(*keep, *SD_SPEC.raw_names), list(SD_SPEC.raw_names))
    if realign_rows:
        df = realign(df)
    if on_bad == "quarantine":
        lenient = {"FECHA_REG": (parse_date_dmy("FECHA_REG").cast("timestamp_ntz"), "date")}
        return _set_aside(df, SD_SPEC.raw_names, lenient).withColumns({
            "TIPO_DOC": normalize_doc_type("TIPO_DOC"),
            "AGENCIAMIENTO": flag_blank("VALIDO_HASTA", "A", "C"),
            "FECHA_NAC": parse_date_dmy("FECHA_NAC", strict=False),
        })
    return df.withColumns({
        "TIPO_DOC": normalize_doc_type("TIPO_DOC"),
        "AGENCIAMIENTO": flag_blank("VALIDO_HASTA", "A", "C"),
        "FECHA_NAC": parse_date_dmy("FECHA_NAC", strict=False),
        "FECHA_REG": parse_date_dmy("FECHA_REG", strict=True).cast("timestamp_ntz"),
    })


def sd_workbook_parsed(raw: DataFrame, ctx: LoadContext, source_format: str | Column = "xlsx",
                       compat: bool = False, keep: tuple[str, ...] = ()) -> DataFrame:
    """SD rows from workbooks: ISO text dates for ``xlsx``, serial numbers otherwise.

    ``source_format`` may be a column (e.g. the file suffix of each row), so a
    folder mixing both kinds parses each row by its own file's rule.
    """
    fmt = F.lower(source_format) if isinstance(source_format, Column) else F.lit(source_format.lower())
    df = strip_all(raw.select(*keep, *SD_SPEC.raw_names, fmt.alias("__fmt")), list(SD_SPEC.raw_names))
    is_text = F.col("__fmt") == F.lit("xlsx")
    return df.withColumns({
        "TIPO_DOC": normalize_doc_type("TIPO_DOC"),
        "AGENCIAMIENTO": flag_blank("VALIDO_HASTA", "A", "C"),
        "FECHA_NAC": F.when(is_text, parse_date_iso("FECHA_NAC", strict=False))
                      .otherwise(excel_serial_to_date("FECHA_NAC")),
        "FECHA_REG": F.when(is_text, parse_timestamp_iso("FECHA_REG", strict=True))
                      .otherwise(excel_serial_to_timestamp("FECHA_REG", compat=compat)),
    }).drop("__fmt")


def os_parsed(raw: DataFrame, ctx: LoadContext, keep: tuple[str, ...] = (), on_bad: str = "fail") -> DataFrame:
    """OS rows; an id or creation date that does not parse is an error, or a fault of its row as in :func:`sd_text_parsed`."""
    df = strip_all(raw.select(*keep, *OS_SPEC.raw_names), list(OS_SPEC.raw_names))
    if on_bad == "quarantine":
        lenient = {"ID": (F.col("ID").try_cast("int"), "number"), "FECHA_CREA": (parse_date_dmy("FECHA_CREA"), "date")}
        return _set_aside(df, OS_SPEC.raw_names, lenient).withColumns({
            "FECHA_CARTA": parse_date_dmy("FECHA_CARTA", strict=False),
            "USUARIO_CREA": blank_to_null("USUARIO_CREA"),
            "USUARIO_CARTA": blank_to_null("USUARIO_CARTA"),
        })
    return df.withColumns({
        "ID": F.col("ID").cast("int"),
        "FECHA_CREA": parse_date_dmy("FECHA_CREA", strict=True),
        "FECHA_CARTA": parse_date_dmy("FECHA_CARTA", strict=False),
        "USUARIO_CREA": blank_to_null("USUARIO_CREA"),
        "USUARIO_CARTA": blank_to_null("USUARIO_CARTA"),
    })


def observe_parsed(parsed: DataFrame, spec: ReportSpec, ctx: LoadContext,
                   observation: Observation | str | None = None) -> DataFrame:
    """Attach the pre-cut-off audit metrics to the parsed rows.

    The metrics ride along with whatever action runs the load (one pass).
    The observe node also keeps the cut-off filter above the parse, so the
    parse and realignment are evaluated once per row rather than once in a
    pushed-down filter and again in the projection.
    """
    name = observation if observation is not None else f"{spec.name.lower()}_parsed_{uuid.uuid4().hex[:12]}"
    return parsed.observe(name, *pre_cutoff_metrics(spec.date_column, ctx.cutoff))


def finish(parsed: DataFrame, spec: ReportSpec, ctx: LoadContext,
           observation: Observation | str | None = None) -> DataFrame:
    """Cut-off, final columns, de-duplication, then the run stamp.

    The stamp columns are constant, so adding them after the distinct gives
    the same rows while shuffling two columns less.
    """
    stamp = _stamp(ctx)
    body = [n for n in spec.output_names if n not in stamp]
    observed = observe_parsed(parsed, spec, ctx, observation)
    kept = keep_until(observed, spec.date_column, ctx.cutoff).select(*body)
    return dedupe(kept).withColumns(stamp).select(*spec.output_names)


def finish_split(parsed: DataFrame, spec: ReportSpec, ctx: LoadContext) -> DataFrame:
    """Good and bad rows in one frame, for one write split by ``part``.

    ``part`` is ``good`` (on or before the cut-off), ``late``, ``undated`` or
    ``bad``.  Equal rows are one with their number in ``copies``, which is the
    de-duplication; late and undated rows are folded into one row a date.  So
    the sums of ``copies`` are the audit's counts, from the very rows that were
    written, whatever tasks ran twice.
    """
    stamp = _stamp(ctx)
    body = [n for n in spec.output_names if n not in stamp]
    day = F.col(spec.date_column).cast("date")
    part = (F.when(F.col(FAULT).isNotNull(), F.lit("bad")).when(day.isNull(), F.lit("undated"))
             .when(day > F.lit(ctx.cutoff), F.lit("late")).otherwise(F.lit("good")))
    source = F.col("source_file") if "source_file" in parsed.columns else F.lit(None).cast("string")
    rows = parsed.withColumn("part", part)
    good, bad = F.col("part") == "good", F.col("part") == "bad"
    rows = rows.select(*[F.when(good, F.col(c)).alias(c) for c in body], "part", day.alias("day"),
                       *[F.when(bad, c).alias(n) for n, c in (("source_file", source), ("fault", F.col(FAULT)), ("raw", F.col(RAW)))])
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("copies")).withColumns(stamp)


def load_sd_text(raw: DataFrame, ctx: LoadContext, realign_rows: bool = True) -> DataFrame:
    return finish(sd_text_parsed(raw, ctx, realign_rows), SD_SPEC, ctx)


def load_os(raw: DataFrame, ctx: LoadContext) -> DataFrame:
    return finish(os_parsed(raw, ctx), OS_SPEC, ctx)

"""Date and timestamp parsing: day-first text, ISO text and spreadsheet serials.

``strict`` parses raise under ANSI mode and so abort the load; lenient parses
turn failures into null.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Formats of the source reports.
DMY = "d/M/yyyy"                 # day-first text, first 10 characters
ISO_DATE = "yyyy-M-d"            # workbook date text, first 10 characters
ISO_TIMESTAMP = "yyyy-MM-dd HH:mm:ss"  # workbook timestamp text, first 19 characters
REPORT_DATE = "dd-MM-yyyy"       # cut-off parameter and audit text
SERIAL_EPOCH = "1899-12-30"      # day 0 of spreadsheet serial dates (1900-01-01 is day 2)
SECONDS_PER_DAY = 86400


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date_dmy(c: Column | str, strict: bool = False) -> Column:
    s = F.substring(_col(c), 1, 10)
    return F.to_date(s, DMY) if strict else F.try_to_date(s, DMY)


def parse_date_iso(c: Column | str, strict: bool = False) -> Column:
    s = F.substring(_col(c), 1, 10)
    return F.to_date(s, ISO_DATE) if strict else F.try_to_date(s, ISO_DATE)


def parse_timestamp_iso(c: Column | str, strict: bool = True) -> Column:
    s = F.substring(_col(c), 1, 19)
    if strict:
        return F.to_timestamp_ntz(s, F.lit(ISO_TIMESTAMP))
    return F.try_to_timestamp(s, F.lit(ISO_TIMESTAMP)).cast("timestamp_ntz")


def _serial_days(c: Column) -> Column:
    # strict int cast of the whole-day part: '' or '4.5' parts abort the load
    return F.split_part(c, F.lit("."), F.lit(1)).cast("int")


def excel_serial_to_date(c: Column | str) -> Column:
    """Serial day number (text, optional fraction) to a date."""
    return F.date_add(F.lit(SERIAL_EPOCH).cast("date"), _serial_days(_col(c)))


def excel_serial_seconds(c: Column | str, compat: bool = False) -> Column:
    """Seconds into the day encoded by the fraction of a serial.

    Default: no dot means midnight; the fraction is read as a double and
    rounded to the nearest second.  ``compat=True`` reproduces the original
    rule: the text after the last dot (the whole text when there is none) is
    read as ``0.<digits>`` in single precision and truncated.
    """
    c = _col(c)
    last = F.split_part(c, F.lit("."), F.lit(-1))
    if compat:
        frac = F.concat(F.lit("0."), last).cast("float")
        return (frac * F.lit(SECONDS_PER_DAY).cast("float")).cast("int")
    frac = F.concat(F.lit("0."), last).cast("double")
    return F.when(c.contains("."), F.round(frac * F.lit(SECONDS_PER_DAY)).cast("int")).otherwise(F.lit(0))


def excel_serial_to_timestamp(c: Column | str, compat: bool = False) -> Column:
    c = _col(c)
    base = F.lit(f"{SERIAL_EPOCH} 00:00:00").cast("timestamp_ntz")
    return base + F.make_dt_interval(_serial_days(c), F.lit(0), F.lit(0),
                                     excel_serial_seconds(c, compat).cast("decimal(18,6)"))


def parse_cutoff(text: str | _dt.date) -> _dt.date:
    """Cut-off parameter: a date, or strict ``DD-MM-YYYY`` text."""
    if isinstance(text, _dt.datetime):
        return text.date()
    if isinstance(text, _dt.date):
        return text
    return _dt.datetime.strptime(text.strip(), "%d-%m-%Y").date()


def format_dmy(c: Column | str) -> Column:
    return F.date_format(_col(c), REPORT_DATE)

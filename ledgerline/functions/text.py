"""Text rules: trimming, classification, blank handling, date-shape test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters with the Unicode White_Space property.  Cells are
# trimmed of these at both ends (``trim`` alone would strip only U+0020).
UNICODE_WHITESPACE = (
    "\u0009\u000a\u000b\u000c\u000d\u0020\u0085\u00a0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# Document-type rules, first match wins; anything else is kept.
DOC_TYPE_RULES = (("RUC", "RUC"), ("PAS", "PT"), ("CARNET", "CE"))

# Fixed value: a cell "looks like a date" when its first 10 characters are
# empty or two digits, separator, two digits, separator, four digits.
DATE_SHAPE_PATTERN = r"(?U)^(?:\d{2}[-/]\d{2}[-/]\d{4})?\z"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_unicode(c: Column | str) -> Column:
    """Remove Unicode white space at both ends; whitespace-only becomes ''."""
    return F.btrim(_col(c), F.lit(UNICODE_WHITESPACE))


def classify_contains(c: Column | str, rules: Sequence[tuple[str, str]]) -> Column:
    """First rule whose needle is a (case-sensitive) substring wins; else the value."""
    c = _col(c)
    out = None
    for needle, label in rules:
        cond = c.contains(needle)
        out = F.when(cond, F.lit(label)) if out is None else out.when(cond, F.lit(label))
    return c if out is None else out.otherwise(c)


def normalize_doc_type(c: Column | str) -> Column:
    return classify_contains(c, DOC_TYPE_RULES)


def flag_blank(c: Column | str, if_blank: str = "A", otherwise: str = "C") -> Column:
    """``if_blank`` when the cell is null or '', else ``otherwise``."""
    c = _col(c)
    return F.when(c.isNull() | (c == F.lit("")), F.lit(if_blank)).otherwise(F.lit(otherwise))


def blank_to_null(c: Column | str) -> Column:
    return F.nullif(_col(c), F.lit(""))


def date_shape(c: Column | str) -> Column:
    """Shape-only date test on the first 10 characters: '' is true, null is null."""
    return F.substring(_col(c), 1, 10).rlike(DATE_SHAPE_PATTERN)

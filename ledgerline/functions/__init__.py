"""Column-level functions: every one returns a built-in Spark ``Column``
expression, so it stays inside whole-stage codegen."""

from ledgerline.functions.dates import (  # noqa: F401
    excel_serial_to_date, excel_serial_to_timestamp, format_dmy, parse_cutoff, parse_date_dmy,
    parse_date_iso, parse_timestamp_iso,
)
from ledgerline.functions.text import (  # noqa: F401
    blank_to_null, classify_contains, date_shape, flag_blank, normalize_doc_type, strip_unicode,
)

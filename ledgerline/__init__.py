"""ledgerline: customer-report loading as Spark DataFrame jobs.

Reports arrive as folders of CSV files or workbooks whose columns are known
only by position.  Everything here is a ``DataFrame -> DataFrame`` function
(or a reader/writer around one); the driver only ever receives one-row
audits and per-file metadata.
"""

from ledgerline.spec import OS_SPEC, SD_SPEC, ReportSpec  # noqa: F401

__all__ = ["ReportSpec", "SD_SPEC", "OS_SPEC"]

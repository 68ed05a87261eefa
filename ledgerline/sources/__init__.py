"""Report sources: folders of CSV files and workbooks, and target-table reads."""

"""Readers and writers: CSV and Parquet in, Parquet and CSV reports out."""

from .bucketed import read_table, write_bucketed
from .csv_towers import read_towers_csv
from .reports import preview, read_report, row_counts, schema_table, write_report, write_rows_csv
from .schemas import CLEAN_COLUMNS, REPORT_SCHEMAS, TOWER_SCHEMA
from .tables import read_clean, replace_partitions, stage_table, staged_table, write_table
from .workspace import new_workspace, temporary_workspace

__all__ = [
    "CLEAN_COLUMNS", "REPORT_SCHEMAS", "TOWER_SCHEMA", "new_workspace", "preview", "read_clean",
    "read_report", "read_table", "read_towers_csv", "replace_partitions", "row_counts", "schema_table",
    "stage_table", "staged_table", "temporary_workspace", "write_bucketed", "write_report", "write_rows_csv", "write_table",
]

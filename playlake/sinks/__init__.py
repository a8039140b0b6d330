"""Sinks and table definitions."""

from playlake.sinks.file_table import FileTable
from playlake.sinks.files import append_text, count_lines, write_csv_quoted, write_parquet
from playlake.sinks.tables import (
    append_rows,
    arrange,
    create_database,
    create_table,
    create_tables,
    drop_tables,
    insert_select,
)

__all__ = [
    "FileTable",
    "append_rows",
    "append_text",
    "arrange",
    "count_lines",
    "create_database",
    "create_table",
    "create_tables",
    "drop_tables",
    "insert_select",
    "write_csv_quoted",
    "write_parquet",
]

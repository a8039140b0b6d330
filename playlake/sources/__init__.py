"""Scans. Every schema is given, so no scan starts with a pass over the data to infer one."""

from playlake.sources.copy import copy_by_name, copy_by_paths
from playlake.sources.files import (
    count_files,
    count_listed,
    read_csv,
    read_csv_inferred,
    read_json_lines,
    read_json_objects,
    split_corrupt,
    union_sources,
)
from playlake.sources.judged import judged
from playlake.sources.records import read_csv_records
from playlake.sources.tables import read_leaves, read_partitioned, read_table

__all__ = [
    "copy_by_name",
    "copy_by_paths",
    "count_files",
    "count_listed",
    "judged",
    "read_csv",
    "read_csv_inferred",
    "read_csv_records",
    "read_json_lines",
    "read_json_objects",
    "read_leaves",
    "read_partitioned",
    "read_table",
    "split_corrupt",
    "union_sources",
]

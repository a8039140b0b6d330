"""The operators run on the given tables, each with the SQL that gives the same rows."""

from playlake.workload import build_queries, check_queries, file_queries, star_queries, stream_queries
from playlake.workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES", "build_queries", "check_queries", "file_queries", "star_queries", "stream_queries"]

"""Registered queries over the test tables, each with its DuckDB twin where SQL can express it."""

from catalogue import flow_queries, report_queries, storage_queries, text_queries, trend_queries  # noqa: F401
from catalogue.registry import ORACLE, QUERIES

__all__ = ["ORACLE", "QUERIES"]

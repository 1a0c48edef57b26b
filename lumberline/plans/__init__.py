"""Whole jobs and the SQL surface."""

from lumberline.plans.etl import dashboard_counts, raw_to_clean, raw_to_json
from lumberline.plans.sql import QueryRefused, preview_table, run_query, stringify_result

__all__ = [
    "QueryRefused",
    "dashboard_counts",
    "preview_table",
    "raw_to_clean",
    "raw_to_json",
    "run_query",
    "stringify_result",
]

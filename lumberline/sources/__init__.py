"""Reading and writing: raw text, parsed and clean logs, results, catalog tables."""

from lumberline.sources.catalog import (
    cache_result,
    drop_cached_result,
    list_tables,
    refresh_logs,
    register_logs,
)
from lumberline.sources.parsed import (
    read_clean_logs,
    read_parsed_logs,
    read_result,
    read_with_torn_lines,
    replace_days,
    store_result,
    torn_lines,
    whole_rows,
    write_apart,
    write_clean_logs,
    write_json_logs,
)
from lumberline.sources.raw import read_raw_logs, render_log_lines, write_raw_logs
from lumberline.sources.results import (
    forget_answer,
    keep_result,
    kept_results,
    read_kept_result,
    remembered,
)
from lumberline.sources.synth import synthesize_for, synthesize_logs

__all__ = [
    "cache_result",
    "drop_cached_result",
    "forget_answer",
    "keep_result",
    "kept_results",
    "list_tables",
    "read_clean_logs",
    "read_kept_result",
    "read_parsed_logs",
    "read_raw_logs",
    "read_result",
    "read_with_torn_lines",
    "refresh_logs",
    "register_logs",
    "remembered",
    "render_log_lines",
    "replace_days",
    "store_result",
    "synthesize_for",
    "synthesize_logs",
    "torn_lines",
    "whole_rows",
    "write_apart",
    "write_clean_logs",
    "write_json_logs",
    "write_raw_logs",
]

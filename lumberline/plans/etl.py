"""The jobs a log platform runs, put together from sources, operators and sinks."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from lumberline.operators.metrics import counts_by_level_and_id
from lumberline.operators.parse import parse_logs
from lumberline.operators.shape import drop_levels
from lumberline.sources.parsed import write_clean_logs, write_json_logs
from lumberline.sources.raw import read_raw_logs


def raw_to_json(
    spark: SparkSession,
    raw_path: str,
    json_path: str,
    recursive: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Raw text to JSON lines in one stage: scan, check, slice, write; nothing is shuffled."""
    logs = parse_logs(read_raw_logs(spark, raw_path, recursive))
    write_json_logs(logs, json_path, mode)


def raw_to_clean(
    spark: SparkSession,
    raw_path: str,
    clean_path: str,
    format: str = "parquet",
    without_levels: Iterable[str] = (),
    recursive: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Raw text to Parquet or CSV by day, optionally without some levels."""
    logs = parse_logs(read_raw_logs(spark, raw_path, recursive))
    levels = tuple(without_levels)
    if levels:
        logs = drop_levels(logs, levels)
    write_clean_logs(logs, clean_path, format, mode=mode)


def dashboard_counts(
    spark: SparkSession, table: str, levels: Iterable[str] = ("ERROR", "WARNING")
) -> DataFrame:
    """Counts by id for each level on the dashboard, from one scan of the table."""
    return counts_by_level_and_id(spark.table(table), levels)

"""Projections and filters over log rows."""

from __future__ import annotations

from collections.abc import Iterable
from datetime import date, datetime, time

from pyspark.sql import Column, DataFrame, functions as F

from lumberline.functions.parsing import event_time


def drop_levels(logs: DataFrame, levels: Iterable[str] = ("INFO",)) -> DataFrame:
    """Removes whole levels. An opt-in step: parsing itself keeps every level."""
    return logs.filter(~F.col("level").isin(*levels))


def select_log_columns(logs: DataFrame) -> DataFrame:
    return logs.select("timestamp", F.col("level").alias("log_level"))


def filter_level(logs: DataFrame, level: str) -> DataFrame:
    """Exact, case-sensitive match; pushed into JSON, CSV and Parquet scans."""
    return logs.filter(F.col("level") == level)


def filter_time_range(
    logs: DataFrame, start: str | date | datetime, end: str | date | datetime
) -> DataFrame:
    """Rows with ``start <= time < end``. Rows without a real time are dropped.

    Where the logs carry ``day``, the range is stated on it too, so that a scan of day-partitioned
    files skips the other days.
    """
    start, end = _as_datetime(start), _as_datetime(end)
    columns = set(logs.columns)
    event_ts = F.col("event_ts") if "event_ts" in columns else event_time(F.col("timestamp"))
    kept = logs
    if "day" in columns:
        last_day_is_open = end.time() == time()
        before_end = F.col("day") < _date(end) if last_day_is_open else F.col("day") <= _date(end)
        kept = kept.filter((F.col("day") >= _date(start)) & before_end)
    return kept.filter((event_ts >= _timestamp(start)) & (event_ts < _timestamp(end)))


def _as_datetime(bound: str | date | datetime) -> datetime:
    if isinstance(bound, str):
        bound = datetime.fromisoformat(bound)
    elif not isinstance(bound, datetime):
        bound = datetime.combine(bound, time())
    if bound.tzinfo is not None:
        raise ValueError("log times carry no zone; give the bound without one")
    return bound


def _timestamp(bound: datetime) -> Column:
    return F.lit(bound.isoformat(sep=" ")).cast("timestamp_ntz")


def _date(bound: datetime) -> Column:
    return F.lit(bound.date())

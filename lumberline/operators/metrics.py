"""Counts over log rows.

Every aggregate is a plain ``groupBy().count()``: Spark counts inside each map task first, so the
shuffle carries at most one row per group and task, however many rows a single id or day holds.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, functions as F

from lumberline.functions.parsing import event_time
from lumberline.operators.parse import ensure_event_time
from lumberline.operators.shape import filter_level


def count_by_id(logs: DataFrame, level: str) -> DataFrame:
    """Rows per id within one level. Rows without an id form their own group."""
    return filter_level(logs, level).groupBy("id").count()


def counts_by_level_and_id(
    logs: DataFrame, levels: Iterable[str] = ("ERROR", "WARNING")
) -> DataFrame:
    """:func:`count_by_id` for several levels in one scan."""
    return logs.filter(F.col("level").isin(*levels)).groupBy("level", "id").count()


def share_by_id(logs: DataFrame, level: str) -> DataFrame:
    """:func:`count_by_id` with each id's part of the level's total.

    The total is a scalar subquery over the same counts, not an unpartitioned window, so the number
    of distinct ids never has to fit one task; both sides reuse the same shuffle.
    """
    counts = count_by_id(logs, level)
    total = counts.agg(F.sum("count").alias("total")).scalar()
    share = F.col("count").cast("double") / total.cast("double")
    return counts.select("id", "count", share.alias("share"))


def count_per_day(logs: DataFrame, level: str = "ERROR") -> DataFrame:
    """Rows per day within one level. Rows without a real time belong to no day."""
    days = ensure_event_time(filter_level(logs, level)).filter(F.col("day").isNotNull())
    return days.groupBy("day").count()


def trend_by_day_and_level(logs: DataFrame) -> DataFrame:
    days = ensure_event_time(logs).filter(F.col("day").isNotNull())
    return days.groupBy("day", "level").count()


def level_timeseries(logs: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Rows per level and time bucket of the given width. Empty buckets are absent."""
    event_ts = F.col("event_ts") if "event_ts" in logs.columns else event_time(F.col("timestamp"))
    timed = logs.select(event_ts.alias("event_ts"), "level").filter(F.col("event_ts").isNotNull())
    start = F.window("event_ts", bucket)["start"]
    return timed.groupBy(start.alias("bucket"), "level").count()

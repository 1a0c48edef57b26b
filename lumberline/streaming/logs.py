"""Parsing and windowed counts on a stream."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from lumberline.functions.parsing import instant, wall_clock
from lumberline.operators.parse import parse_logs

# Clocks have no zone, so a right one can be ahead of its arrival by most of a day.
AHEAD = "1 day"


def stream_parse_to_json(
    lines: DataFrame, out: str, checkpoint: str, trigger: dict | None = None
) -> StreamingQuery:
    """Starts parsing a stream of lines to JSON files.

    Stateless, with the batch job's own expressions. The file sink and the checkpoint give each
    line exactly one output row, also after a restart. ``trigger`` holds the arguments of
    ``DataStreamWriter.trigger``, such as ``{"availableNow": True}``.
    """
    writer = (
        parse_logs(lines)
        .writeStream.format("json")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .option("compression", "none")
        .option("ignoreNullFields", "true")
        .outputMode("append")
    )
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def stream_level_counts(
    lines: DataFrame, bucket: str = "1 hour", delay: str = "1 hour", ahead: str = AHEAD
) -> DataFrame:
    """``bucket, level, count`` of a stream of lines, for use with append mode.

    A bucket is emitted once, when the newest time seen is ``delay`` beyond its end; rows that come
    later than that are dropped, as are rows without a real time. The state holds one counter per
    open bucket and level.

    One wrong clock must not make all later rows late, so rows whose time is more than ``ahead`` after
    their arrival are left to :func:`stream_ahead_of_arrival`.
    """
    counts = (
        _timed(lines).filter(~_is_ahead(ahead))
        .withWatermark("event_ts", delay)
        .groupBy(F.window("event_ts", bucket), "level")
        .count()
    )
    return counts.select(wall_clock(F.col("window.start")).alias("bucket"), "level", "count")


def stream_ahead_of_arrival(lines: DataFrame, ahead: str = AHEAD) -> DataFrame:
    """The log rows that :func:`stream_level_counts` leaves out for their clocks, as they come.

    Arrivals are part of the lines, so both functions always agree on a row.
    """
    logs = _timed(lines).filter(_is_ahead(ahead))
    return logs.select("timestamp", "level", "message", "id", "arrived")


def _timed(lines: DataFrame) -> DataFrame:
    """Log rows with a real time, and their arrivals."""
    logs = parse_logs(lines, keep=("arrived",))
    return logs.withColumn("event_ts", instant(F.col("timestamp"))).filter(F.col("event_ts").isNotNull())


def _is_ahead(ahead: str) -> Column:
    # A line of unknown arrival is taken as it is.
    return F.coalesce(F.col("event_ts") > F.col("arrived") + F.expr(f"INTERVAL {ahead}"), F.lit(False))

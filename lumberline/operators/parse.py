"""Raw lines to log rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from lumberline.functions.parsing import (
    event_time,
    id_suffix,
    is_log_line,
    line_head,
    log_fields,
)


def parse_log_lines(lines: DataFrame) -> DataFrame:
    """``value`` to ``timestamp, level, message, id``, one row per line.

    A line outside the grammar gives a row of NULLs; :func:`drop_unparsed` removes those.
    """
    checked = lines.select(*_line_parts(), is_log_line(F.col("value")).alias("matched"))
    return checked.select(
        *[F.when(F.col("matched"), field).alias(name) for name, field in _fields().items()]
    )


def drop_unparsed(logs: DataFrame) -> DataFrame:
    """Keeps rows that came from a valid line; every such row has a timestamp."""
    return logs.filter(F.col("timestamp").isNotNull())


def parse_logs(lines: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """``drop_unparsed(parse_log_lines(lines))`` with the line checked once instead of twice.

    ``keep`` names further columns of ``lines`` to pass on.
    """
    valid = lines.filter(is_log_line(F.col("value"))).select(*_line_parts(), *keep)
    return valid.select(*[field.alias(name) for name, field in _fields().items()], *keep)


def _line_parts() -> list[Column]:
    value = F.col("value")
    return [value, line_head(value).alias("head"), id_suffix(value).alias("suffix")]


def _fields() -> dict[str, Column]:
    return log_fields(F.col("value"), F.col("head"), F.col("suffix"))


def to_json_rows(logs: DataFrame) -> DataFrame:
    """All columns as one JSON object in ``json_data``, keys in column order, NULLs left out."""
    row = F.to_json(F.struct(*[F.col(c) for c in logs.columns]), {"ignoreNullFields": "true"})
    return logs.select(row.alias("json_data"))


def with_event_time(logs: DataFrame) -> DataFrame:
    """Adds ``event_ts`` and ``day``; both NULL where the timestamp is no real time."""
    event_ts = event_time(F.col("timestamp"))
    return logs.withColumns({"event_ts": event_ts, "day": event_ts.cast("date")})


def ensure_event_time(logs: DataFrame) -> DataFrame:
    """:func:`with_event_time` for logs that lack the columns or one of them."""
    if "event_ts" not in logs.columns:
        return with_event_time(logs)
    if "day" not in logs.columns:
        return logs.withColumn("day", F.col("event_ts").cast("date"))
    return logs

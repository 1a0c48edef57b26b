"""Deterministic log sets of any size, made by Spark."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumberline.functions.synthesis import div, synthetic_fields
from lumberline.schema import (
    DEFAULT_ERROR_PCT,
    DEFAULT_FILES,
    DEFAULT_LINES_PER_FILE,
    DEFAULT_WARNING_PCT,
)
from lumberline.sources.raw import LINES_PER_PART

DEFAULT_START = "2024-01-01 00:00:00"
DEFAULT_SEED = 17


def synthesize_logs(
    spark: SparkSession,
    files: int = DEFAULT_FILES,
    lines_per_file: int = DEFAULT_LINES_PER_FILE,
    error_pct: int = DEFAULT_ERROR_PCT,
    warning_pct: int = DEFAULT_WARNING_PCT,
    start: str = DEFAULT_START,
    step_seconds: float = 1,
    seed: int = DEFAULT_SEED,
    lines_per_part: int = LINES_PER_PART,
) -> DataFrame:
    """``file_index, line_no, level, message, id, event_ts``, files and lines counted from 1.

    Each task makes whole files, or whole parts of ``lines_per_part`` lines of a longer file, so
    ``write_raw_logs(..., clustered=True)`` can write them without a shuffle.
    """
    if files < 0 or lines_per_file < 0 or lines_per_part < 1:
        raise ValueError("files and lines_per_file must not be negative, lines_per_part positive")
    _check_last_time(start, step_seconds, files * lines_per_file)

    # Rows are numbered in a space padded to whole parts, whose task borders fall on part borders;
    # the padding is filtered out.
    part = max(1, min(lines_per_file, lines_per_part))
    parts_per_file = -(-lines_per_file // part)
    parts = files * parts_per_file
    per_task = max(1, min(lines_per_part // part, -(-parts // spark.sparkContext.defaultParallelism)))
    tasks = max(1, -(-parts // per_task))
    slots = spark.range(0, tasks * per_task * part if parts else 0, 1, tasks)

    padded = max(1, parts_per_file * part)
    rows = slots.select(
        div(F.col("id"), padded).alias("file"), F.pmod("id", F.lit(padded)).alias("line")
    ).filter((F.col("file") < files) & (F.col("line") < lines_per_file))
    number = F.col("file") * lines_per_file + F.col("line")
    numbered = rows.select(
        (F.col("file") + 1).alias("file_index"),
        (F.col("line") + 1).alias("line_no"),
        number.alias("n"),
    )
    fields = _fields(F.col("n"), error_pct, warning_pct, start, step_seconds, seed)
    return numbered.select("file_index", "line_no", *fields)


def synthesize_for(
    numbered: DataFrame,
    lines_per_file: int = DEFAULT_LINES_PER_FILE,
    error_pct: int = DEFAULT_ERROR_PCT,
    warning_pct: int = DEFAULT_WARNING_PCT,
    start: str = DEFAULT_START,
    step_seconds: float = 1,
    seed: int = DEFAULT_SEED,
) -> DataFrame:
    """The rows :func:`synthesize_logs` makes, for the row numbers in column ``n`` (from 0)."""
    n = F.col("n")
    fields = _fields(n, error_pct, warning_pct, start, step_seconds, seed)
    return numbered.select(
        (div(n, lines_per_file) + 1).alias("file_index"),
        (F.pmod(n, F.lit(lines_per_file)) + 1).alias("line_no"),
        *fields,
    )


def _fields(
    n: Column, error_pct: int, warning_pct: int, start: str, step_seconds: float, seed: int
) -> list[Column]:
    if min(error_pct, warning_pct) < 0 or error_pct + warning_pct > 100:
        raise ValueError("error_pct and warning_pct must lie in 0..100 and add up to 100 at most")
    fields = synthetic_fields(
        n, seed, error_pct, warning_pct, start, step_micros=round(step_seconds * 1_000_000)
    )
    return [field.alias(name) for name, field in fields.items()]


def _check_last_time(start: str, step_seconds: float, lines: int) -> None:
    """A year beyond 9999 has no place in the line format."""
    if step_seconds < 0:
        raise ValueError("step_seconds must not be negative")
    try:
        datetime.fromisoformat(start) + timedelta(seconds=step_seconds * max(0, lines - 1))
    except OverflowError:
        raise ValueError("the last line would lie beyond the year 9999; lower step_seconds") from None

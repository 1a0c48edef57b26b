"""Raw log text: reading files, rendering rows back to lines, writing line files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumberline.functions.parsing import log_line, timestamp_text

# About 130 MB of text, the size of one scan task's input.
LINES_PER_PART = 2_000_000


def read_raw_logs(
    spark: SparkSession, path: str | list[str], recursive: bool = False, line_sep: str | None = None
) -> DataFrame:
    """One row per line of every file in ``path``, blank lines included.

    Subfolders are read only with ``recursive``. Files whose names start with ``_`` or ``.`` are
    skipped. ``\\n``, ``\\r\\n`` and a lone ``\\r`` end a line unless ``line_sep`` names one end.
    """
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if line_sep is not None:
        reader = reader.option("lineSep", line_sep)
    return reader.text(path).select("value")


def render_log_lines(logs: DataFrame) -> DataFrame:
    """Inverse of parsing: ``value`` from level, message, id and ``timestamp`` or ``event_ts``."""
    return logs.select(_line(logs).alias("value"))


def write_raw_logs(
    logs: DataFrame,
    path: str,
    lines_per_part: int = LINES_PER_PART,
    clustered: bool = False,
    mode: str = "errorifexists",
) -> None:
    """Writes ``file_index=<i>/part=<p>`` folders of one text file each, lines in order.

    A file index longer than ``lines_per_part`` is cut into several parts, so one giant index is
    spread over tasks instead of landing in one. ``clustered`` says that each part already sits in
    a single task, as ``synthesize_logs`` returns it; then nothing is shuffled. Read the result
    back with ``read_raw_logs(..., recursive=True)``.
    """
    part = F.call_function("div", F.col("line_no") - 1, F.lit(lines_per_part))
    lines = logs.select("file_index", part.alias("part"), "line_no", _line(logs).alias("value"))
    if not clustered:
        lines = lines.repartition("file_index", "part")
    (
        lines.sortWithinPartitions("file_index", "part", "line_no")
        .select("file_index", "part", "value")
        .write.mode(mode)
        .partitionBy("file_index", "part")
        .text(path)
    )


def _line(logs: DataFrame) -> Column:
    if "timestamp" in logs.columns:
        timestamp = F.col("timestamp")
    else:
        timestamp = timestamp_text(F.col("event_ts"))
    return log_line(timestamp, F.col("level"), F.col("message"), F.col("id"))

"""Parsed logs and query results in files."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import (
    ArrayType,
    BinaryType,
    CalendarIntervalType,
    MapType,
    NullType,
    StringType,
    StructField,
    StructType,
    VariantType,
)

from lumberline.operators.parse import ensure_event_time
from lumberline.schema import CLEAN_SCHEMA, LOG_SCHEMA

# CSV has one spelling for a missing value and one for an empty text. These options keep the two
# apart, keep blanks at either end, and let a quoted text hold quotes, backslashes and NUL
# characters (the default escape of an escape is NUL, which reading would swallow). The time formats
# keep microseconds.
CSV_OPTIONS = {
    "header": "true",
    "nullValue": r"\N",
    "escape": '"',
    "charToEscapeQuoteEscaping": '"',
    "lineSep": "\n",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
}

# White space and texts of JSON.
_JSON_BLANKS = " \t\r\n"
_JSON_TEXT = r'"[^"\\]*+(?:\\.[^"\\]*+)*+"'
_TORN_SCHEMA = StructType([*(StructField(n, StringType()) for n in LOG_SCHEMA.names), StructField("torn", StringType())])

# CSV has no form of its own for these.
_STORED_AS_TEXT = (
    ArrayType,
    BinaryType,
    CalendarIntervalType,
    MapType,
    NullType,
    StructType,
    VariantType,
)


def write_json_logs(logs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """One JSON object per line, keys in column order, NULLs left out, uncompressed."""
    logs.write.mode(mode).json(path, compression="none", ignoreNullFields=True)


def read_parsed_logs(spark: SparkSession, path: str) -> DataFrame:
    """Reads :func:`write_json_logs` output with a fixed schema; a missing key is NULL.

    A line that is no JSON is an error, not a row of NULLs. :func:`read_with_torn_lines` reads on.
    """
    return spark.read.schema(LOG_SCHEMA).json(path, mode="FAILFAST")


def read_with_torn_lines(spark: SparkSession, path: str) -> DataFrame:
    """Reads :func:`write_json_logs` output past broken lines: the log columns, and ``torn``.

    Every line that is not blank gives one row. A line that is one whole object with a timestamp, a level and a message
    gives these, and ``torn`` is NULL. Any other line (cut off, glued to the next one, followed by rubbish, or lacking
    one of the three) stands in ``torn`` as it is, and the other columns are NULL.
    :func:`whole_rows` and :func:`torn_lines` part them; :func:`write_apart` stores both from one scan.
    """
    lines = spark.read.text(path).filter(F.trim("value", F.lit(_JSON_BLANKS)) != "")
    parsed = F.from_json("value", _TORN_SCHEMA, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "torn"})
    rows = lines.select("value", parsed.alias("row"))
    needed = [F.col(f"row.{f.name}").isNotNull() for f in LOG_SCHEMA.fields if not f.nullable]
    whole = F.col("row.torn").isNull() & reduce(lambda a, b: a & b, needed) & _is_one_object(F.col("value"))
    rows = rows.withColumn("whole", F.coalesce(whole, F.lit(False)))
    fields = [F.when(F.col("whole"), F.col(f"row.{name}")).alias(name) for name in LOG_SCHEMA.names]
    return rows.select(*fields, F.when(~F.col("whole"), F.col("value")).alias("torn"))


def whole_rows(logs: DataFrame) -> DataFrame:
    """The log rows of :func:`read_with_torn_lines`."""
    return logs.filter(F.col("torn").isNull()).select(*LOG_SCHEMA.names)


def torn_lines(logs: DataFrame) -> DataFrame:
    """``value``: the broken lines of :func:`read_with_torn_lines`."""
    return logs.filter(F.col("torn").isNotNull()).select(F.col("torn").alias("value"))


def write_apart(logs: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Stores :func:`read_with_torn_lines` output in one pass: rows in ``path/kind=whole``, broken lines in ``path/kind=torn``.

    Rows are JSON lines as from :func:`write_json_logs`; a broken line is an object with the key ``torn``.
    """
    kind = F.when(F.col("torn").isNull(), "whole").otherwise("torn")
    logs.withColumn("kind", kind).write.mode(mode).partitionBy("kind").json(path, compression="none", ignoreNullFields=True)


def _is_one_object(line: Column) -> Column:
    """Whether nothing follows the object that a line begins with, which the JSON reader doesn't tell.

    Mostly the first closing brace is the end of the line. Else texts are taken out, and one pair of braces must be left.
    """
    ended = F.rtrim(line, F.lit(_JSON_BLANKS))
    plain = F.octet_length(F.substring_index(ended, "}", 1)) + 1 == F.octet_length(ended)
    bare = F.regexp_replace(line, _JSON_TEXT, "")
    return F.when(plain, True).otherwise(bare.rlike(r"^[ \t\r\n]*\{[^{}]*\}[ \t\r\n]*$"))


def write_clean_logs(
    logs: DataFrame,
    path: str,
    format: str = "parquet",
    partition_by: str | None = "day",
    rebalance: bool = True,
    mode: str = "errorifexists",
) -> None:
    """Stores logs as Parquet or CSV, one folder per ``partition_by`` value.

    With ``rebalance`` rows are first brought together by that value, so a day gets a few large
    files and not one per input task. The adaptive planner cuts an oversized day over several
    tasks and merges small ones, so a day with a third of all rows is no bottleneck; without that
    planner the hint would send each day to one task, so it is an error. Switch it off where the
    input is already ordered by time; then nothing is shuffled. Whole log rows are stored with their
    time, whatever the folders are by.

    Rows are sorted by level and time inside each file, which lets Parquet scans skip row groups.
    Rows without a real time are kept, in the folder Spark uses for NULL.

    ``mode`` is one of Spark's, of which "overwrite" removes everything in ``path``, other days too; or
    "replace": the folders of the values that ``logs`` holds are replaced and all others stay, so writing
    a day again neither doubles it nor touches another. A value that ``logs`` no longer holds keeps its
    rows; :func:`replace_days` names the days that are to be as in ``logs``.
    """
    _check_format(format)
    if mode == "replace" and partition_by is None:
        raise ValueError("only folders by a value can be replaced")
    if partition_by in ("day", "event_ts") or set(LOG_SCHEMA.names) <= set(logs.columns):
        logs = ensure_event_time(logs)
    if partition_by is not None and rebalance:
        if logs.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
            raise ValueError("switch adaptive execution on, or rebalance off")
        logs = logs.hint("rebalance", F.col(partition_by))
    order = [c for c in (partition_by, "level", "event_ts") if c in logs.columns]
    if order:
        logs = logs.sortWithinPartitions(*order)
    writer = logs.write.format(format)
    if mode == "replace":
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        writer = writer.mode(mode)
    if partition_by is not None:
        writer = writer.partitionBy(partition_by)
    if format == "csv":
        writer = writer.options(**CSV_OPTIONS)
    writer.save(path)


def replace_days(
    logs: DataFrame, path: str, days: Iterable[str | date], format: str = "parquet", rebalance: bool = True
) -> None:
    """Makes the given days of clean logs in ``path`` what ``logs`` holds of them; other days are left alone.

    Rows of other days in ``logs`` are not written. A day of which ``logs`` holds nothing is removed. Running it again
    changes nothing. The new files of all days take their place when all are written; then empty days go.
    """
    wanted = sorted({date.fromisoformat(str(day)) for day in days})
    if not wanted:
        return
    own = ensure_event_time(logs).filter(F.col("day").isin(*wanted))
    seen = Observation()
    own = own.observe(seen, *[F.max(F.col("day") == F.lit(day)).alias(str(day)) for day in wanted])
    write_clean_logs(own, path, format, rebalance=rebalance, mode="replace")
    spark = logs.sparkSession
    for day in wanted:
        if not seen.get[str(day)]:
            folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path.rstrip('/')}/day={day}")
            folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(folder, True)


def read_clean_logs(
    spark: SparkSession, path: str, format: str = "parquet", schema: StructType = CLEAN_SCHEMA
) -> DataFrame:
    """Reads :func:`write_clean_logs` output with a fixed schema."""
    _check_format(format)
    reader = spark.read.schema(schema).format(format)
    if format == "csv":
        reader = reader.options(**CSV_OPTIONS)
    logs = reader.load(path)
    if format == "csv" and "message" in logs.columns:
        # A message is never missing, so a NULL can only be the text that spells one.
        message = F.coalesce(F.col("message"), F.lit(CSV_OPTIONS["nullValue"]))
        logs = logs.withColumn("message", message)
    # Spark puts the columns that come from folder names last.
    return logs.select(*schema.names)


def store_result(result: DataFrame, location: str, name: str | None = None) -> str:
    """Keeps a query's result as CSV in its own folder below ``location``; returns the folder.

    Nested and binary columns are stored as their text. A column name that occurs again gets the
    first number from 2 on that makes a name no column has.
    """
    path = f"{location.rstrip('/')}/{name or uuid.uuid4().hex}"
    numbered = result.toDF(*[str(i) for i in range(len(result.columns))])
    taken = {name.lower() for name in result.columns}
    met: set[str] = set()
    columns = []
    for i, field in enumerate(result.schema.fields):
        cell = F.col(str(i))
        name_here = field.name
        if name_here.lower() in met:
            numbered_names = (f"{field.name}_{k}" for k in count(2))
            name_here = next(n for n in numbered_names if n.lower() not in taken)
            taken.add(name_here.lower())
        met.add(name_here.lower())
        columns.append(
            (cell.cast("string") if isinstance(field.dataType, _STORED_AS_TEXT) else cell).alias(name_here)
        )
    numbered.select(*columns).write.mode("errorifexists").options(**CSV_OPTIONS).csv(path)
    return path


def read_result(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """Reads :func:`store_result` output.

    A cell may hold line feeds, which a parsed message cannot, so each file is read by one task;
    every task of the query wrote its own.
    """
    return spark.read.schema(schema).options(**CSV_OPTIONS, multiLine=True).csv(path)


def _check_format(format: str) -> None:
    if format not in ("parquet", "csv"):
        raise ValueError(f"clean logs are stored as parquet or csv, not {format!r}")

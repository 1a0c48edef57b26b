"""Log lines derived from the given tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumberline.functions.parsing import log_line
from lumberline.schema import ERROR_ID_FIRST, IDS_PER_LEVEL, WARNING_ID_FIRST
from lumberline.sources.raw import render_log_lines


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def event_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events`` as log rows: errors as ERROR, signups as WARNING, the rest as INFO."""
    events = read_table(spark, sf_dir, "events")
    kind, user = F.col("event_type"), F.col("user_id")
    is_error, is_warning = kind == "error", kind == "signup"
    id_number = user % IDS_PER_LEVEL
    return events.select(
        F.when(is_error, "ERROR").when(is_warning, "WARNING").otherwise("INFO").alias("level"),
        F.concat(kind, F.lit(" by user "), user).alias("message"),
        F.when(is_error, F.concat(F.lit("E"), id_number + ERROR_ID_FIRST))
        .when(is_warning, F.concat(F.lit("W"), id_number + WARNING_ID_FIRST))
        .alias("id"),
        F.col("ts").alias("event_ts"),
    )


def event_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as one raw log line."""
    return render_log_lines(event_rows(spark, sf_dir))


def document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document twice: as it stands, and as the message of a log line.

    The first kind is free text, which mostly does not follow the line grammar.
    """
    documents = read_table(spark, sf_dir, "documents")
    texts = documents.select("doc_id", "lang", F.explode(F.split("text", "\n")).alias("text"))
    as_log = F.concat(
        F.lit("2024-03-01 12:00:00, "), "lang", F.lit(": "), "text",
        F.lit(", (doc_"), "doc_id", F.lit(")"),
    )
    return texts.select(F.explode(F.array(F.col("text"), as_log)).alias("value"))


def odd_time_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as an ERROR line whose time often is none, such as month 14 or day 33."""
    events = read_table(spark, sf_dir, "events")
    number, user = F.col("event_id"), F.col("user_id")

    def two_digits(value: Column) -> Column:
        return F.lpad(value.cast("string"), 2, "0")

    time = F.concat(
        F.lit("2024-"), two_digits(1 + number % 14), F.lit("-"), two_digits(1 + user % 33),
        F.lit(" "), two_digits(user % 24), F.lit(":"), two_digits(number % 63), F.lit(":"),
        two_digits(user % 60),
    )
    line = log_line(time, F.lit("ERROR"), F.col("event_type"), F.concat(F.lit("U"), user))
    return events.select(line.alias("value"))


def wrong_clock_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line, and once more with a clock that is 75 years ahead."""
    rows = event_rows(spark, sf_dir)
    ahead = rows.withColumn("event_ts", F.expr("event_ts + INTERVAL '75' YEAR"))
    return render_log_lines(rows.unionByName(ahead))

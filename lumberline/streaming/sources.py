"""Log lines as they arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def stream_raw_logs(
    spark: SparkSession,
    path: str | None = None,
    kafka: dict[str, str] | None = None,
    recursive: bool = False,
    **options: str,
) -> DataFrame:
    """A streaming ``value, arrived`` per line of the files that appear in ``path``, or per Kafka message.

    ``arrived`` is the time a file was written, or the time of the message.

    Give one of ``path`` and ``kafka`` (the connector's options; it needs Spark's Kafka package).
    Further options, such as ``maxFilesPerTrigger``, go to the file source.
    """
    if (path is None) == (kafka is None):
        raise ValueError("give either a path or Kafka options")
    if kafka is not None:
        return message_lines(spark.readStream.format("kafka").options(**kafka).load())
    reader = spark.readStream.option("recursiveFileLookup", str(recursive).lower())
    arrived = F.col("_metadata.file_modification_time").alias("arrived")
    return reader.options(**options).text(path).select("value", arrived)


def message_lines(messages: DataFrame) -> DataFrame:
    """Kafka messages as lines: the text of ``value``, and its ``timestamp`` as the arrival.

    A message without a value stays NULL and is no log line. A line feed at the end, with which many
    producers close a message, is no part of the line; broken UTF-8 becomes U+FFFD.
    """
    text = F.make_valid_utf8(F.col("value").cast("string"))
    return messages.select(F.regexp_replace(text, r"\r?\n\z", "").alias("value"), F.col("timestamp").alias("arrived"))

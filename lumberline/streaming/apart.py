"""Counts of a stream in one pass, with the rows that are not counted kept apart."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from lumberline.functions.parsing import instant, wall_clock
from lumberline.operators.parse import parse_logs
from lumberline.streaming.logs import AHEAD

#: What can become of a log row: counted in its bucket; for a clock ahead of its arrival; after its bucket was
#: closed; without a real time.
COUNTED, AHEAD_OF_ARRIVAL, LATE, UNTIMED = KINDS = ("counted", "ahead", "late", "untimed")

_ROWS_SCHEMA = (
    "batch bigint, kind string, bucket timestamp_ntz, level string, "
    "row struct<timestamp: string, level: string, message: string, id: string, arrived: timestamp>, n bigint"
)
#: Marks are microseconds since 1970.
_MARK_SCHEMA = "batch bigint, mark bigint"


def stream_counts_apart(
    lines: DataFrame,
    out: str,
    checkpoint: str,
    bucket: str = "1 hour",
    delay: str = "1 hour",
    ahead: str = AHEAD,
    trigger: dict | None = None,
) -> StreamingQuery:
    """Starts counting a stream of lines by bucket and level, without losing any log row.

    Every log row is in exactly one of four kinds: counted; ahead, if its time is more than ``ahead`` after its
    arrival; late, if its bucket was closed by an earlier batch, the newest time counted then being ``delay`` beyond the
    bucket's end; untimed, if its time is no real one. A batch reads its lines once: one aggregate
    gives the counts of its buckets and, beside them, the rows of the other kinds, alike ones as one with their number.

    A batch's results lie in a folder of its own, which a second run of the batch replaces. How far time has come
    is written after them, below the checkpoint, so that a batch that is run again judges its rows as it did before, and one
    that is known there is not run again. :func:`read_stream_counts` and :func:`read_stream_rows` see whole batches only.
    """
    marks = _marks(checkpoint)

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        if _is_done(spark, marks, number):
            return
        before = _mark_before(spark, marks, number)
        closed = F.timestamp_micros(F.lit(before).cast("long")) - F.expr(f"INTERVAL {delay}")
        logs = batch.withColumn("event_ts", instant(F.col("timestamp")))
        # A window of its own column, since rows without a time have none.
        window = F.window(F.coalesce("event_ts", F.lit(0).cast("timestamp")), bucket)
        logs = logs.withColumn("window", window).withColumn("kind", _kind(closed, ahead))
        seen = Observation()
        newest = F.max(F.when(F.col("kind") == COUNTED, F.unix_micros("event_ts")))
        logs = logs.observe(seen, newest.alias("newest"))
        counted = F.col("kind") == COUNTED
        row = F.struct("timestamp", "level", "message", "id", "arrived")
        grouped = logs.groupBy(
            "kind", F.when(counted, wall_clock(F.col("window.start"))).alias("bucket"),
            F.when(counted, F.col("level")).alias("level"), F.when(~counted, row).alias("row"),
        ).agg(F.count("*").alias("n"))
        grouped.write.mode("overwrite").partitionBy("kind").parquet(_batch_folder(out, number))
        mark = max((m for m in (before, seen.get["newest"]) if m is not None), default=None)
        row = spark.createDataFrame([(mark,)], "mark bigint")
        row.coalesce(1).write.mode("overwrite").parquet(f"{marks}/batch={number}")

    writer = parse_logs(lines, keep=("arrived",)).writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint)
    if trigger:
        writer = writer.trigger(**trigger)
    return writer.start()


def read_stream_counts(
    spark: SparkSession, out: str, checkpoint: str, bucket: str = "1 hour", delay: str | None = None
) -> DataFrame:
    """``bucket, level, count`` of all whole batches; with ``delay`` only of buckets that are closed.

    ``bucket`` and ``delay`` are those of :func:`stream_counts_apart`.
    """
    rows = _whole_batches(spark, out, checkpoint).filter(F.col("kind") == COUNTED)
    if delay is not None:
        newest = _newest(spark, _marks(checkpoint))
        end = F.col("bucket") + F.expr(f"INTERVAL {bucket}")
        closed = wall_clock(F.timestamp_micros(F.lit(newest).cast("long")) - F.expr(f"INTERVAL {delay}"))
        rows = rows.filter(end <= closed)
    return rows.groupBy("bucket", "level").agg(F.sum("n").alias("count"))


def read_stream_rows(spark: SparkSession, out: str, checkpoint: str, kind: str) -> DataFrame:
    """The log rows of one of the kinds that are not counted, each as often as it came, and its ``batch``."""
    if kind not in KINDS or kind == COUNTED:
        raise ValueError(f"rows are kept of {', '.join(KINDS[1:])}, not of {kind!r}")
    rows = _whole_batches(spark, out, checkpoint).filter(F.col("kind") == kind)
    return rows.select("row.*", "batch", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("copy")).drop("copy")


def _kind(closed: Column, ahead: str) -> Column:
    wrong = F.coalesce(F.col("event_ts") > F.col("arrived") + F.expr(f"INTERVAL {ahead}"), F.lit(False))
    late = F.coalesce(F.col("window.end") <= closed, F.lit(False))
    return (
        F.when(F.col("event_ts").isNull(), UNTIMED).when(wrong, AHEAD_OF_ARRIVAL).when(late, LATE).otherwise(COUNTED)
    )


def _batch_folder(out: str, number: int) -> str:
    return f"{out.rstrip('/')}/batch={number}"


def _marks(checkpoint: str) -> str:
    # Beside the folders that Spark keeps in a checkpoint.
    return f"{checkpoint.rstrip('/')}/lumberline-marks"


def _exists(spark: SparkSession, path: str) -> bool:
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(found)


def _is_done(spark: SparkSession, marks: str, number: int) -> bool:
    return _exists(spark, f"{marks}/batch={number}/_SUCCESS")


def _mark_before(spark: SparkSession, marks: str, number: int) -> int | None:
    """How far time had come before a batch; a mark is never below the one before it."""
    if _is_done(spark, marks, number - 1):
        return spark.read.schema("mark bigint").parquet(f"{marks}/batch={number - 1}").first()[0]
    if not _exists(spark, marks):
        return None
    earlier = spark.read.schema(_MARK_SCHEMA).parquet(marks).filter(F.col("batch") < number)
    return earlier.agg(F.max("mark")).first()[0]


def _newest(spark: SparkSession, marks: str) -> int | None:
    if not _exists(spark, marks):
        return None
    return spark.read.schema(_MARK_SCHEMA).parquet(marks).agg(F.max("mark")).first()[0]


def _whole_batches(spark: SparkSession, out: str, checkpoint: str) -> DataFrame:
    """The stored rows of batches whose mark is written."""
    marks = _marks(checkpoint)
    if not _exists(spark, marks):
        return spark.createDataFrame([], _ROWS_SCHEMA)
    # Batches end one after the other.
    last = spark.read.schema(_MARK_SCHEMA).parquet(marks).agg(F.max("batch")).first()[0]
    return spark.read.schema(_ROWS_SCHEMA).parquet(out).filter(F.col("batch") <= F.lit(-1 if last is None else last))

from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.errors import AnalysisException

import lumberline as ll

NOW = {"availableNow": True}
FIRST = [
    "2024-01-01 00:10:00, ERROR: a, (E1)",
    "2024-01-01 00:50:00, ERROR: b, (E2)",
    "2024-01-01 01:30:00, INFO: c",
    "junk",
    "",
    "9999-99-99 99:99:99, ERROR: no time, (E3)",
    "2024-01-01 03:30:00, INFO: d",
]
SECOND = [
    "2024-01-01 00:20:00, ERROR: too late, (E1)",
    "2024-01-01 03:40:00, INFO: in time",
    "2024-01-01 06:00:00, INFO: e",
]


def add_file(folder, name, lines):
    Path(folder).mkdir(exist_ok=True)
    (Path(folder) / name).write_text("\n".join(lines))


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_stream_parse_equals_batch_and_resumes(spark, folder):
    raw, out, state = folder("raw"), folder("out"), folder("state")
    for name, lines in (("1.log", FIRST), ("2.log", SECOND)):
        add_file(raw, name, lines)
        query = ll.stream_parse_to_json(ll.stream_raw_logs(spark, raw), out, state, NOW)
        query.awaitTermination()
        batch = ll.parse_logs(ll.read_raw_logs(spark, raw))
        assert rows(ll.read_parsed_logs(spark, out)) == rows(batch)


def count_stream(spark, raw, out, state):
    counts = ll.stream_level_counts(ll.stream_raw_logs(spark, raw), "1 hour", "1 hour")
    writer = counts.writeStream.format("json").option("path", out)
    writer = writer.option("checkpointLocation", state).outputMode("append")
    writer.trigger(**NOW).start().awaitTermination()
    return rows(spark.read.schema(counts.schema).json(out))


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_stream_counts_closed_buckets_and_drops_late_rows(spark, folder, zone):
    raw, out, state = folder("raw"), folder("out"), folder("state")
    previous = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        add_file(raw, "1.log", FIRST)
        # The newest time is 03:30, so with an hour's delay buckets up to 02:30 are closed.
        closed = [(datetime(2024, 1, 1, 0), "ERROR", 2), (datetime(2024, 1, 1, 1), "INFO", 1)]
        assert count_stream(spark, raw, out, state) == closed
        add_file(raw, "2.log", SECOND)
        assert count_stream(spark, raw, out, state) == [
            *closed, (datetime(2024, 1, 1, 3), "INFO", 2),
        ]
    finally:
        spark.conf.set("spark.sql.session.timeZone", previous)


def test_closed_buckets_equal_batch(spark, folder):
    raw = folder("raw")
    add_file(raw, "1.log", FIRST)
    batch = rows(ll.level_timeseries(ll.parse_logs(ll.read_raw_logs(spark, raw))))
    stream = count_stream(spark, raw, folder("out"), folder("state"))
    assert stream == [r for r in batch if r[0].hour < 2]


def test_buckets_need_not_be_whole_seconds(spark, folder):
    raw = folder("raw")
    times = [f"2024-01-01 00:00:{s:02d}, INFO: x" for s in range(0, 60, 5)]
    add_file(raw, "1.log", [*times, "2024-01-01 01:00:00, INFO: end"])
    counts = ll.stream_level_counts(ll.stream_raw_logs(spark, raw), "7500 milliseconds", "0 seconds")
    writer = counts.writeStream.format("parquet").option("path", folder("out"))
    writer = writer.option("checkpointLocation", folder("state")).outputMode("append")
    writer.trigger(**NOW).start().awaitTermination()
    stream = rows(spark.read.schema(counts.schema).parquet(folder("out")))
    batch = rows(ll.level_timeseries(ll.parse_logs(ll.read_raw_logs(spark, raw)), "7500 milliseconds"))
    assert stream == batch[:-1] and any(r[0].microsecond for r in stream)


def test_nested_folders(spark, folder):
    add_file(folder("raw"), "1.log", FIRST)
    add_file(folder("raw") + "/nested", "2.log", SECOND)
    for recursive, messages in ((False, 5), (True, 8)):
        out = folder(f"out-{recursive}")
        lines = ll.stream_raw_logs(spark, folder("raw"), recursive=recursive)
        ll.stream_parse_to_json(lines, out, folder(f"state-{recursive}"), NOW).awaitTermination()
        assert ll.read_parsed_logs(spark, out).count() == messages


def test_kafka_needs_its_connector(spark):
    try:
        lines = ll.stream_raw_logs(spark, kafka={"kafka.bootstrap.servers": "h:1", "subscribe": "logs"})
    except AnalysisException as error:
        assert "kafka" in str(error)
    else:
        assert lines.isStreaming and lines.columns == ["value", "arrived"]


def test_messages_as_lines(spark):
    time = datetime(2024, 1, 1, 1)
    messages = spark.createDataFrame(
        [(b"2024-01-01 00:00:00, INFO: a\n", time), (None, time), (b"x\xff\r\n", time), (b"y\n\nz", None)],
        "value binary, timestamp timestamp",
    )
    lines = ll.message_lines(messages)
    assert [r.value for r in lines.collect()] == ["2024-01-01 00:00:00, INFO: a", None, "x\ufffd", "y\n\nz"]
    assert [r.message for r in ll.parse_logs(lines).collect()] == ["a"]


def test_a_wrong_clock_loses_no_row(spark, folder):
    raw, out, state = folder("raw"), folder("out"), folder("state")
    good = [[f"2024-01-0{d} 0{h}:10:00, INFO: x" for h in range(3)] for d in (1, 2, 3)]
    wrong = ["2098-01-01 00:00:00, ERROR: from the future, (E1)"]
    for k, lines in enumerate((good[0] + wrong, good[1], good[2])):
        add_file(raw, f"{k}.log", lines)
        closed = count_stream(spark, raw, out, state)
        ahead = ll.stream_ahead_of_arrival(ll.stream_raw_logs(spark, raw))
        writer = ahead.writeStream.format("json").option("path", folder("ahead"))
        writer = writer.option("checkpointLocation", folder("ahead-state"))
        writer.trigger(**NOW).start().awaitTermination()
    # The last bucket before the newest time, 03 02:10, less an hour is 00:00 of that day.
    assert [(r[0].day, r[0].hour, r[2]) for r in closed] == [
        (d, h, 1) for d in (1, 2, 3) for h in range(3) if (d, h) < (3, 1)
    ]
    (row,) = spark.read.json(folder("ahead")).collect()
    assert (row.timestamp, row.id) == ("2098-01-01 00:00:00", "E1")


def test_one_source_is_needed(spark):
    with pytest.raises(ValueError):
        ll.stream_raw_logs(spark)
    with pytest.raises(ValueError):
        ll.stream_raw_logs(spark, "path", kafka={"subscribe": "logs"})

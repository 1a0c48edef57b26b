from __future__ import annotations

from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import lumberline as ll


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_default_set(spark):
    logs = ll.synthesize_logs(spark)
    assert logs.dtypes == [
        ("file_index", "bigint"), ("line_no", "bigint"), ("level", "string"), ("message", "string"),
        ("id", "string"), ("event_ts", "timestamp_ntz"),
    ]
    assert dict(rows(logs.groupBy("level").count())) == {"ERROR": 1000, "WARNING": 2000, "INFO": 7000}
    assert dict(rows(logs.groupBy("file_index").count())) == {i: 2000 for i in range(1, 6)}
    assert rows(ll.count_by_id(logs, "ERROR")) == [(f"E{i}", 100) for i in range(2001, 2011)]
    assert rows(ll.count_by_id(logs, "WARNING")) == [(f"W{i}", 200) for i in range(1001, 1011)]
    assert logs.filter("level = 'INFO' AND id IS NOT NULL").count() == 0
    assert logs.select("level", "message").distinct().count() == 30
    assert logs.agg(F.max("event_ts")).first()[0] == datetime(2024, 1, 1, 2, 46, 39)


@pytest.mark.parametrize(
    "files, lines, per_part",
    [(1, 1, 10), (7, 13, 5), (7, 13, 1000), (3, 100, 33), (50, 3, 10), (0, 5, 5), (5, 0, 5)],
)
def test_every_shape_is_whole_and_the_same(spark, files, lines, per_part):
    logs = ll.synthesize_logs(spark, files, lines, lines_per_part=per_part)
    numbers = spark.range(files * lines).withColumnRenamed("id", "n")
    assert rows(logs) == (rows(ll.synthesize_for(numbers, lines)) if files * lines else [])


@pytest.mark.parametrize("files, lines, per_part", [(7, 13, 5), (7, 13, 1000), (50, 3, 10)])
def test_each_part_sits_in_one_task(spark, files, lines, per_part):
    logs = ll.synthesize_logs(spark, files, lines, lines_per_part=per_part)
    part = F.floor((F.col("line_no") - 1) / per_part).alias("part")
    placed = logs.select("file_index", part, F.spark_partition_id().alias("task")).distinct()
    assert placed.groupBy("file_index", "part").count().filter("count > 1").count() == 0
    assert placed.select("task").distinct().count() > 1


def test_counts_per_day_of_synthetic_rows(spark):
    logs = ll.synthesize_logs(spark, 1, 1000, step_seconds=3600)
    assert ll.trend_by_day_and_level(logs).agg(F.sum("count")).first()[0] == 1000
    assert ll.count_per_day(logs).count() == 42


def test_percentages(spark):
    logs = ll.synthesize_logs(spark, 1, 1000, error_pct=0, warning_pct=100)
    assert rows(logs.groupBy("level").count()) == [("WARNING", 1000)]
    calm = ll.synthesize_logs(spark, 1, 1000, error_pct=0, warning_pct=0)
    assert calm.filter("level <> 'INFO'").count() == 0
    for error_pct, warning_pct in ((-1, 0), (60, 50)):
        with pytest.raises(ValueError):
            ll.synthesize_logs(spark, error_pct=error_pct, warning_pct=warning_pct)


def test_seed_moves_the_levels(spark):
    def levels(seed):
        return [r.level for r in ll.synthesize_logs(spark, 1, 200, seed=seed).orderBy("line_no").collect()]

    assert levels(1) == levels(1) and levels(1) != levels(2)
    assert set(levels(-5)) == {"ERROR", "WARNING", "INFO"}


def test_time_steps(spark):
    def times(**options):
        logs = ll.synthesize_logs(spark, 1, 4, **options).orderBy("line_no")
        return [r.event_ts for r in logs.collect()]

    assert times(start="2024-02-28 23:59:58", step_seconds=1)[2] == datetime(2024, 2, 29)
    assert [t.second for t in times(step_seconds=0.5)] == [0, 0, 1, 1]
    assert len(set(times(step_seconds=0))) == 1
    with pytest.raises(ValueError):
        ll.synthesize_logs(spark, 10**6, 10**6, step_seconds=1)
    with pytest.raises(ValueError):
        ll.synthesize_logs(spark, step_seconds=-1)


def test_row_numbers_beyond_32_bits(spark):
    n = 5_000_000_000
    row = ll.synthesize_for(spark.range(n, n + 1).withColumnRenamed("id", "n")).first()
    assert (row.file_index, row.line_no) == (n // 2000 + 1, 1)
    assert row.event_ts == datetime(2182, 6, 11, 8, 53, 20)


def parts(path):
    """Lines of every file, by file index and part."""
    found = {}
    for file in Path(path).rglob("part-*.txt"):
        index, part = (int(p.split("=")[1]) for p in file.parts[-3:-1])
        assert (index, part) not in found, "one file per part"
        found[index, part] = file.read_text().splitlines()
    return found


@pytest.mark.parametrize("clustered", [True, False])
def test_one_ordered_file_per_index(spark, folder, clustered):
    logs = ll.synthesize_logs(spark)
    ll.write_raw_logs(logs, folder("raw"), clustered=clustered)
    files = parts(folder("raw"))
    assert sorted(files) == [(i, 0) for i in range(1, 6)]
    for (index, _), lines in files.items():
        ordered = logs.filter(F.col("file_index") == index).orderBy("line_no")
        assert lines == [r.value for r in ll.render_log_lines(ordered).collect()]


@pytest.mark.parametrize("clustered", [True, False])
def test_long_index_is_cut_into_ordered_parts(spark, folder, clustered):
    logs = ll.synthesize_logs(spark, 2, 2500, lines_per_part=1000)
    ll.write_raw_logs(logs, folder("raw"), lines_per_part=1000, clustered=clustered)
    files = parts(folder("raw"))
    assert {key: len(lines) for key, lines in files.items()} == {
        (i, p): 500 if p == 2 else 1000 for i in (1, 2) for p in (0, 1, 2)
    }
    joined = [line for key in sorted(files) for line in files[key]]
    ordered = logs.orderBy("file_index", "line_no")
    assert joined == [r.value for r in ll.render_log_lines(ordered).collect()]


def test_written_set_reads_back(spark, folder):
    logs = ll.synthesize_logs(spark)
    ll.write_raw_logs(logs, folder("raw"), clustered=True)
    lines = ll.read_raw_logs(spark, folder("raw"), recursive=True)
    assert lines.columns == ["value"]
    back = ll.with_event_time(ll.parse_logs(lines)).select("level", "message", "id", "event_ts")
    assert rows(back) == rows(logs.select(back.columns))

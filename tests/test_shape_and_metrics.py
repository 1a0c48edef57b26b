from __future__ import annotations

from datetime import date, datetime

import pytest

import lumberline as ll

ROWS = [
    ("2024-01-04 23:59:59", "ERROR", "before", "E1"),
    ("2024-01-05 00:00:00", "ERROR", "first", "E1"),
    ("2024-01-05 12:30:00", "error", "lower case", "E1"),
    ("2024-01-06 10:00:00", "ERROR", "middle", "E2"),
    ("2024-01-06 10:59:59", "ERROR", "no id", None),
    ("2024-01-07 23:59:59", "WARNING", "late", "W1"),
    ("2024-01-08 00:00:00", "ERROR", "end", "E1"),
    ("2024-01-08 00:00:01", "INFO", "info", None),
    ("9999-99-99 99:99:99", "ERROR", "no time", "E9"),
]


@pytest.fixture
def logs(spark):
    return spark.createDataFrame(ROWS, ll.LOG_SCHEMA)


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def messages(df):
    return [r.message for r in df.collect()]


def test_drop_levels(logs):
    assert messages(ll.drop_levels(logs)) == [r[2] for r in ROWS if r[1] != "INFO"]
    assert messages(ll.drop_levels(logs, ["ERROR", "INFO"])) == ["lower case", "late"]


def test_select_log_columns(logs):
    narrow = ll.select_log_columns(logs)
    assert narrow.columns == ["timestamp", "log_level"]
    assert rows(narrow) == sorted([r[:2] for r in ROWS], key=repr)


def test_filter_level_is_case_sensitive(logs):
    assert messages(ll.filter_level(logs, "error")) == ["lower case"]


@pytest.mark.parametrize(
    "start, end",
    [
        ("2024-01-05", "2024-01-08"),
        (date(2024, 1, 5), date(2024, 1, 8)),
        (datetime(2024, 1, 5), datetime(2024, 1, 8)),
    ],
)
def test_time_range_is_half_open(logs, start, end):
    kept = ["first", "lower case", "middle", "no id", "late"]
    assert messages(ll.filter_time_range(logs, start, end)) == kept
    assert messages(ll.filter_time_range(ll.with_event_time(logs), start, end)) == kept


def test_time_range_within_a_day(logs):
    timed = ll.with_event_time(logs)
    inside = ll.filter_time_range(timed, "2024-01-06 10:00:00", "2024-01-06 10:59:59")
    assert messages(inside) == ["middle"]


def test_time_range_refuses_zones(logs):
    with pytest.raises(ValueError):
        ll.filter_time_range(logs, "2024-01-05T00:00:00+02:00", "2024-01-06")


def test_count_by_id_groups_missing_ids(logs):
    assert rows(ll.count_by_id(logs, "ERROR")) == sorted(
        [("E1", 3), ("E2", 1), (None, 1), ("E9", 1)], key=repr
    )
    assert ll.count_by_id(logs, "ERROR").schema.simpleString() == "struct<id:string,count:bigint>"
    assert ll.count_by_id(logs, "TRACE").count() == 0


def test_counts_by_level_and_id(logs):
    assert rows(ll.counts_by_level_and_id(logs)) == sorted(
        [("ERROR", "E1", 3), ("ERROR", "E2", 1), ("ERROR", None, 1), ("ERROR", "E9", 1),
         ("WARNING", "W1", 1)],
        key=repr,
    )


def test_share_by_id(logs):
    shares = {r.id: (r["count"], r.share) for r in ll.share_by_id(logs, "ERROR").collect()}
    assert shares == {"E1": (3, 0.5), "E2": (1, 1 / 6), None: (1, 1 / 6), "E9": (1, 1 / 6)}
    assert ll.share_by_id(logs, "TRACE").count() == 0


def test_share_by_id_scans_once_and_uses_no_single_task_window(logs, spark, folder):
    ll.write_json_logs(logs, folder("json"))
    shares = ll.share_by_id(ll.read_parsed_logs(spark, folder("json")), "ERROR")
    shares.collect()
    final = shares._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and "Window" not in final


def test_count_per_day(logs):
    expected = [
        (date(2024, 1, 4), 1), (date(2024, 1, 5), 1), (date(2024, 1, 6), 2), (date(2024, 1, 8), 1),
    ]
    assert rows(ll.count_per_day(logs)) == expected
    assert rows(ll.count_per_day(ll.with_event_time(logs))) == expected
    assert rows(ll.count_per_day(logs, "WARNING")) == [(date(2024, 1, 7), 1)]


def test_level_timeseries(logs):
    hours = {(r.bucket, r.level): r["count"] for r in ll.level_timeseries(logs).collect()}
    assert hours[datetime(2024, 1, 6, 10), "ERROR"] == 2
    assert hours[datetime(2024, 1, 5, 12), "error"] == 1
    assert sum(hours.values()) == len(ROWS) - 1
    days = rows(ll.level_timeseries(ll.with_event_time(logs), "1 day"))
    assert (datetime(2024, 1, 6), "ERROR", 2) in days
    assert dict(ll.level_timeseries(logs).dtypes)["bucket"] == "timestamp_ntz"


def test_trend_by_day_and_level(logs):
    trend = rows(ll.trend_by_day_and_level(logs))
    assert (date(2024, 1, 8), "INFO", 1) in trend and (date(2024, 1, 6), "ERROR", 2) in trend
    assert sum(r[2] for r in trend) == len(ROWS) - 1


def test_counts_push_the_level_into_the_json_scan(logs, spark, folder, capsys):
    ll.write_json_logs(logs, folder("json"))
    ll.count_by_id(ll.read_parsed_logs(spark, folder("json")), "ERROR").explain("formatted")
    plan = capsys.readouterr().out
    assert "EqualTo(level,ERROR)" in plan
    assert "ReadSchema: struct<level:string,id:string>" in plan
    assert plan.count("Exchange (") == 1
    assert "partial_count" in plan

from __future__ import annotations

import gzip
import json
import uuid
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.errors import AnalysisException

import lumberline as ll

TS = "2024-01-02 03:04:05"
NASTY = [
    "", " ", " both ends ", 'say "hi"', '""', '"', "a,b", "back\\slash", "\\", "\\N", "\\\\N", "NULL", "null",
    "\ttab\t", "x\ry", "\r", "\u2028", "\u0085", "gr\u00fc\u00dfe \U0001f600", "#comment", "'", "x, (E1) ",
    '","', '\\"', 'a""b', "\x00", "\ufeff",
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def nasty_logs():
    return [(TS, "INFO", m, None) for m in NASTY] + [(TS, "ERROR", m, "E1") for m in NASTY]


def data_files(path, suffix=""):
    return sorted(f for f in Path(path).rglob("part-*" + suffix) if f.is_file())


def test_read_raw_logs(spark, tmp_path, folder):
    (tmp_path / "a.log").write_bytes(b"one\n\ntwo\r\nthree\rfour")
    (tmp_path / "_hidden").write_text("hidden")
    (tmp_path / ".hidden").write_text("hidden")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.log").write_text("nested\n")
    values = lambda df: sorted(r.value for r in df.collect())
    assert values(ll.read_raw_logs(spark, str(tmp_path))) == ["", "four", "one", "three", "two"]
    assert values(ll.read_raw_logs(spark, str(tmp_path), recursive=True)) == [
        "", "four", "nested", "one", "three", "two",
    ]
    assert values(ll.read_raw_logs(spark, str(tmp_path), line_sep="\n")) == [
        "", "one", "three\rfour", "two\r",
    ]


def test_empty_folder_parses_to_nothing(spark, tmp_path, folder):
    (tmp_path / "raw").mkdir()
    ll.raw_to_json(spark, folder("raw"), folder("json"))
    assert ll.read_parsed_logs(spark, folder("json")).count() == 0


def test_lines_without_any_id(spark, tmp_path, folder):
    (tmp_path / "raw").mkdir()
    lines = [f"{TS}, INFO: line {i}" for i in range(300)]
    (tmp_path / "raw" / "a.log").write_text("\n".join(lines))
    ll.raw_to_json(spark, folder("raw"), folder("json"))
    got = ll.read_parsed_logs(spark, folder("json"))
    assert got.columns == ll.LOG_SCHEMA.names
    assert rows(got) == sorted([(TS, "INFO", f"line {i}", None) for i in range(300)], key=repr)


def test_ids_only_after_many_lines_without(spark, tmp_path, folder):
    (tmp_path / "raw").mkdir()
    lines = [f"{TS}, INFO: x"] * 200 + ["junk"] + [f"{TS}, ERROR: y, (E7)"]
    (tmp_path / "raw" / "a.log").write_text("\n".join(lines))
    ll.raw_to_json(spark, folder("raw"), folder("json"))
    got = ll.read_parsed_logs(spark, folder("json"))
    assert rows(got.filter("id is not null")) == [(TS, "ERROR", "y", "E7")]
    assert got.count() == 201


def test_json_lines(spark, folder):
    logs = spark.createDataFrame([(TS, "ERROR", "m", "E1"), (TS, "INFO", "", None)], ll.LOG_SCHEMA)
    ll.write_json_logs(logs.coalesce(1), folder("json"))
    (file,) = data_files(folder("json"))
    assert file.read_text().splitlines() == [
        f'{{"timestamp":"{TS}","level":"ERROR","message":"m","id":"E1"}}',
        f'{{"timestamp":"{TS}","level":"INFO","message":""}}',
    ]
    with pytest.raises(AnalysisException, match="PATH_ALREADY_EXISTS"):
        ll.write_json_logs(logs, folder("json"))


def test_json_rows_as_text_are_the_same_lines(spark, folder):
    logs = spark.createDataFrame(nasty_logs(), ll.LOG_SCHEMA)
    ll.write_json_logs(logs, folder("json"))
    ll.to_json_rows(logs).write.text(folder("text"))
    lines = [
        sorted(line for f in data_files(folder(name)) for line in f.read_text().split("\n"))
        for name in ("json", "text")
    ]
    assert lines[0] == lines[1]


def test_compressed_raw_files(spark, tmp_path):
    with gzip.open(tmp_path / "a.log.gz", "wt") as file:
        file.write(f"{TS}, ERROR: zipped, (E1)\n")
    assert rows(ll.parse_logs(ll.read_raw_logs(spark, str(tmp_path)))) == [(TS, "ERROR", "zipped", "E1")]


def test_json_round_trip(spark, folder):
    logs = spark.createDataFrame(nasty_logs(), ll.LOG_SCHEMA)
    ll.write_json_logs(logs, folder("json"))
    assert rows(ll.read_parsed_logs(spark, folder("json"))) == sorted(nasty_logs(), key=repr)
    for file in data_files(folder("json")):
        for line in file.read_text().split("\n")[:-1]:
            assert list(json.loads(line)) in (ll.LOG_SCHEMA.names, ll.LOG_SCHEMA.names[:3])


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_clean_round_trip(spark, folder, format):
    logs = spark.createDataFrame(
        nasty_logs() + [("9999-99-99 99:99:99", "ERROR", "no time", None)], ll.LOG_SCHEMA
    )
    ll.write_clean_logs(logs, folder("clean"), format)
    got = ll.read_clean_logs(spark, folder("clean"), format)
    assert got.schema.names == ll.CLEAN_SCHEMA.names
    assert rows(got) == rows(ll.with_event_time(logs))


any_text = st.text(
    alphabet=st.one_of(
        st.sampled_from('\\N",\' \t\r#\x00\x0b\u2028'), st.characters(blacklist_categories=("Cs",))
    ),
    max_size=8,
).map(lambda t: t.replace("\n", ""))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(any_text, min_size=50, max_size=150))
def test_csv_keeps_any_message(spark, tmp_path_factory, texts):
    logs = spark.createDataFrame([(TS, "INFO", t, None) for t in texts], ll.LOG_SCHEMA)
    path = str(tmp_path_factory.mktemp("csv") / "clean")
    ll.write_clean_logs(logs, path, "csv")
    got = ll.read_clean_logs(spark, path, "csv")
    assert sorted(r.message for r in got.collect()) == sorted(texts)


def test_narrow_columns_as_csv(spark, folder):
    logs = spark.createDataFrame([(TS, "ERROR", "m", "E1")], ll.LOG_SCHEMA)
    narrow = ll.select_log_columns(logs).coalesce(1)
    ll.write_clean_logs(narrow, folder("csv"), "csv", partition_by=None)
    (file,) = data_files(folder("csv"), ".csv")
    assert file.read_text() == f"timestamp,log_level\n{TS},ERROR\n"


def test_unknown_clean_format(spark, folder):
    with pytest.raises(ValueError):
        ll.write_clean_logs(spark.createDataFrame([], ll.LOG_SCHEMA), folder("x"), "orc")


def spread_logs(spark, rows=40_000):
    """A third of all rows on one day, the rest over nine others."""
    return spark.range(0, rows, 1, 8).selectExpr(
        "concat('2024-01-', lpad(if(id % 3 = 0, 1, 2 + id % 9), 2, '0'), ' 00:00:00') AS timestamp",
        "if(id % 10 = 0, 'ERROR', 'INFO') AS level",
        "concat('message ', sha2(cast(id AS string), 256)) AS message",
        "CAST(NULL AS string) AS id",
    )


def test_clean_files_per_day_are_few(spark, folder):
    ll.write_clean_logs(spread_logs(spark), folder("clean"))
    for day in Path(folder("clean")).glob("day=*"):
        assert len(data_files(day)) == 1
    assert ll.read_clean_logs(spark, folder("clean")).count() == 40_000


def test_hot_day_is_cut_over_several_tasks(spark, folder):
    names = (
        "spark.sql.adaptive.advisoryPartitionSizeInBytes",
        "spark.sql.adaptive.coalescePartitions.minPartitionSize",
    )
    spark.conf.set(names[0], "200kb")
    spark.conf.set(names[1], "100kb")
    try:
        ll.write_clean_logs(spread_logs(spark), folder("clean"))
    finally:
        for name in names:
            spark.conf.unset(name)
    assert len(data_files(Path(folder("clean")) / "day=2024-01-01")) > 1
    got = ll.read_clean_logs(spark, folder("clean"))
    assert got.select("message").distinct().count() == got.count() == 40_000


def test_without_adaptive_planner_no_day_goes_to_one_task(spark, folder):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        with pytest.raises(ValueError):
            ll.write_clean_logs(spread_logs(spark), folder("clean"))
        ll.write_clean_logs(spread_logs(spark), folder("clean"), rebalance=False)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert len(data_files(Path(folder("clean")) / "day=2024-01-01")) == 8
    assert ll.read_clean_logs(spark, folder("clean")).count() == 40_000


def test_time_range_prunes_days(spark, folder, capsys):
    ll.write_clean_logs(spread_logs(spark, 1000), folder("clean"))
    clean = ll.read_clean_logs(spark, folder("clean"))
    errors = ll.filter_time_range(ll.filter_level(clean, "ERROR"), "2024-01-03", "2024-01-05")
    errors.explain("formatted")
    plan = capsys.readouterr().out
    partition_filters = plan.split("PartitionFilters: ")[1].splitlines()[0]
    assert "(day" in partition_filters and "2024-01-03" in partition_filters
    assert "EqualTo(level,ERROR)" in plan and "Batched: true" in plan
    assert {str(r.day) for r in errors.collect()} <= {"2024-01-03", "2024-01-04"}


def test_store_result(spark, folder):
    result = spark.sql(
        "SELECT 1 AS n, CAST(NULL AS string) AS missing, '' AS empty, array(1, 2) AS list,"
        " TIMESTAMP_NTZ '2024-01-01 00:00:01.000002' AS at, DATE '2024-01-01' AS day, 'x' AS `a.b`,"
        " NULL AS nothing, TIMESTAMP '2024-01-01 00:00:01.5' AS moment"
    )
    first, second = (ll.store_result(result, folder("results")) for _ in range(2))
    assert first != second
    schema = (
        "n int, missing string, empty string, list string, at timestamp_ntz, day date, `a.b` string,"
        " nothing string, moment timestamp"
    )
    expected = rows(result.withColumn("list", result["list"].cast("string")))
    assert rows(ll.read_result(spark, first, schema)) == expected
    assert ll.store_result(result, folder("results"), "named").endswith("/named")


def test_stored_cells_may_hold_anything(spark, folder):
    cells = [*NASTY, "two\nlines", "\n", "\r\n", '"\n"', "a,\nb"]
    result = spark.createDataFrame([(i, c) for i, c in enumerate(cells) if c != "\\N"], "n int, cell string")
    path = ll.store_result(result, folder("results"))
    assert rows(ll.read_result(spark, path, result.schema)) == rows(result)


def test_store_result_with_repeated_names(spark, folder):
    path = ll.store_result(spark.sql("SELECT 1 AS id, 2 AS ID, 3 AS id, 4 AS n"), folder("results"))
    (file,) = data_files(path, ".csv")
    assert file.read_text() == "id,ID_2,id_3,n\n1,2,3,4\n"


def test_raw_to_clean(spark, tmp_path, folder):
    (tmp_path / "raw" / "nested").mkdir(parents=True)
    (tmp_path / "raw" / "nested" / "a.log").write_text(f"{TS}, INFO: x\n{TS}, ERROR: y, (E1)\njunk\n")
    ll.raw_to_clean(
        spark, folder("raw"), folder("clean"), "csv", without_levels=["INFO"], recursive=True
    )
    got = ll.read_clean_logs(spark, folder("clean"), "csv").select(*ll.LOG_SCHEMA.names)
    assert rows(got) == [(TS, "ERROR", "y", "E1")]


@pytest.mark.parametrize("format", ["parquet", "csv"])
@pytest.mark.parametrize("by", [None, "day", "level"])
def test_time_is_stored_whatever_the_folders_are_by(spark, folder, format, by):
    rows = [("2024-01-05 10:00:00", "ERROR", "a", "E1"), ("2024-01-06 11:00:00", "INFO", "b", None)]
    ll.write_clean_logs(spark.createDataFrame(rows, ll.LOG_SCHEMA), folder("clean"), format, by)
    logs = ll.read_clean_logs(spark, folder("clean"), format)
    assert sorted((str(r.day), r["count"]) for r in logs.groupBy("day").count().collect()) == [
        ("2024-01-05", 1), ("2024-01-06", 1),
    ]


@pytest.mark.parametrize("format", ["parquet", "csv"])
@pytest.mark.parametrize("partition_by", [None, "day", "level"])
def test_time_is_stored_whatever_the_folders(spark, folder, format, partition_by):
    lines = [(f"2024-01-0{1 + k % 3} 00:00:00", "ERROR" if k % 2 else "INFO", "m", None) for k in range(20)]
    logs = spark.createDataFrame(lines, ll.LOG_SCHEMA)
    ll.write_clean_logs(logs, folder("clean"), format, partition_by)
    clean = ll.read_clean_logs(spark, folder("clean"), format)
    assert rows(clean) == rows(ll.with_event_time(logs))
    assert rows(ll.count_per_day(clean)) == rows(ll.count_per_day(logs)) != []
    name = f"logs_{uuid.uuid4().hex}.clean"
    ll.register_logs(spark, name, folder("clean"), format, partition_by, ll.CLEAN_SCHEMA)
    assert rows(ll.count_per_day(spark.table(name))) == rows(ll.count_per_day(logs))


def test_stored_names_are_told_apart(spark, folder):
    result = spark.sql("SELECT 1 AS a, 2 AS a, 3 AS a_2, 4 AS A")
    path = ll.store_result(result, folder("results"))
    assert spark.read.option("header", True).csv(path).columns == ["a", "a_3", "a_2", "A_4"]

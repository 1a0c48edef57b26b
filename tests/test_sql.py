from __future__ import annotations

import uuid

import pytest
from pyspark.errors import AnalysisException, ParseException

import lumberline as ll

TS = "2024-01-02 03:04:05"
LOGS = [
    (TS, "ERROR", "The index updated itself", "E1"),
    (TS, "ERROR", "drop zone full", "E1"),
    (TS, "ERROR", "x", None),
    (TS, "WARNING", "y", "W1"),
    (TS, "INFO", "", None),
]


@pytest.fixture
def table(spark, folder):
    logs = spark.createDataFrame(LOGS, ll.LOG_SCHEMA)
    ll.write_json_logs(logs, folder("json"))
    name = f"logs_{uuid.uuid4().hex}.parsed_logs"
    ll.register_logs(spark, name, folder("json"))
    return name


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_registered_table(spark, table):
    assert rows(spark.table(table)) == sorted(LOGS, key=repr)
    assert spark.table(table).schema.names == ll.LOG_SCHEMA.names
    assert rows(ll.list_tables(spark, table.split(".")[0])) == [("parsed_logs",)]


def test_listing_leaves_out_temporary_views(spark, table):
    spark.range(1).createOrReplaceTempView("passing_view")
    assert rows(ll.list_tables(spark, table.split(".")[0])) == [("parsed_logs",)]


def test_registering_twice_is_an_error(spark, table, folder):
    with pytest.raises(AnalysisException):
        ll.register_logs(spark, table, folder("json"))


def test_dropping_the_table_leaves_the_files(spark, table, folder):
    spark.sql(f"DROP TABLE {table}")
    assert ll.read_parsed_logs(spark, folder("json")).count() == len(LOGS)


def test_odd_paths(spark, folder):
    path = folder("it's a `path`")
    ll.write_json_logs(spark.createDataFrame(LOGS, ll.LOG_SCHEMA), path)
    name = f"logs_{uuid.uuid4().hex}.odd"
    ll.register_logs(spark, name, path)
    assert spark.table(name).count() == len(LOGS)


@pytest.mark.parametrize("format", ["parquet", "csv"])
def test_partitioned_table_takes_in_new_days(spark, folder, format):
    def day(d):
        return spark.createDataFrame(
            [(f"2024-01-0{d} 00:00:00", "ERROR", "\\N", "E1"), (f"2024-01-0{d} 00:00:00", "INFO", "", None)],
            ll.LOG_SCHEMA,
        )

    name = f"logs_{uuid.uuid4().hex}.clean"
    ll.write_clean_logs(day(1), folder("clean"), format)
    ll.register_logs(spark, name, folder("clean"), format, partition_by="day")
    assert spark.table(name).count() == 2
    ll.write_clean_logs(day(2), folder("clean"), format, mode="append")
    ll.refresh_logs(spark, name, partitioned=True)
    assert spark.table(name).count() == 4
    assert rows(spark.table(name).select("id")) == sorted([("E1",)] * 2 + [(None,)] * 2, key=repr)
    assert ll.count_per_day(spark.table(name)).count() == 2


def test_refresh_takes_in_new_files(spark, table, folder):
    assert spark.table(table).count() == len(LOGS)
    ll.write_json_logs(spark.createDataFrame(LOGS, ll.LOG_SCHEMA), folder("json"), mode="append")
    ll.refresh_logs(spark, table)
    assert spark.table(table).count() == 2 * len(LOGS)


def test_dashboard_counts(spark, table):
    assert rows(ll.dashboard_counts(spark, table)) == sorted(
        [("ERROR", "E1", 2), ("ERROR", None, 1), ("WARNING", "W1", 1)], key=repr
    )


def test_quoted_names(spark, table):
    database, name = table.split(".")
    text = f"""SELECT id, COUNT(*) as count FROM "{database}"."{name}" WHERE level='ERROR' GROUP BY id;"""
    result = ll.run_query(spark, text, double_quoted_identifiers=True)
    assert rows(result) == sorted([("E1", 2), (None, 1)], key=repr)
    assert rows(ll.run_query(spark, 'SELECT "text"')) == [("text",)]
    text = f'SELECT * FROM "{database}"."{name}" LIMIT 10;'
    assert ll.run_query(spark, text, double_quoted_identifiers=True).count() == len(LOGS)


@pytest.mark.parametrize("text", [None, "", "  \n", ";", " ; "])
def test_empty_text_runs_nothing(spark, text):
    assert ll.run_query(spark, text) is None


@pytest.mark.parametrize(
    "text",
    [
        "SELECT count(*) AS n FROM {t}",
        "SELECT message FROM {t} WHERE message LIKE '%updated%'",
        "SELECT message AS `update`, 'insert into t' AS `delete` FROM {t}",
        "SELECT count(*) FROM {t} WHERE message = 'x; drop table {t}'",
        "SELECT 'reflect(' AS a, 'TRANSFORM (x) USING y' AS b, '\"class\":\"ScriptTransformation\"' AS c",
        "WITH e AS (SELECT * FROM {t} WHERE level = 'ERROR') SELECT id, count(*) FROM e GROUP BY id",
        "VALUES (1, 'a'), (2, 'b')",
        "TABLE {t}",
        "FROM {t} SELECT level",
        "(SELECT 1) UNION ALL (SELECT 2)",
        "/* drop */ SELECT 1 -- delete",
        "SELECT level, level FROM {t}",
        "SELECT transform(array(1, 2), x -> x + 1) AS a",
        "SELECT * FROM {t} ORDER BY level LIMIT 2;",
        "SELECT * FROM {t} WHERE id IN (SELECT id FROM {t} WHERE level = 'ERROR')",
        "SHOW TABLES",
        "DESCRIBE {t}",
        "desc {t};",
        "-- all of them\nSHOW TABLES",
        "/* a /* nested */ remark */ DESCRIBE {t}",
        "FROM {t} |> WHERE level = 'ERROR'",
    ],
)
def test_queries_run(spark, table, text):
    assert ll.run_query(spark, text.format(t=table)).count() > 0


@pytest.mark.parametrize(
    "text",
    [
        "INSERT INTO {t} VALUES ('a', 'b', 'c', 'd')",
        "WITH a AS (SELECT * FROM {t}) INSERT INTO {t} SELECT * FROM a",
        "FROM {t} INSERT INTO {t} SELECT *",
        "DELETE FROM {t}",
        "UPDATE {t} SET level = 'x'",
        "MERGE INTO {t} USING {t} s ON {t}.id = s.id WHEN MATCHED THEN DELETE",
        "DROP TABLE {t}",
        "drop database logs cascade",
        "TRUNCATE TABLE {t}",
        "ALTER TABLE {t} RENAME TO gone",
        "CREATE TABLE copy_of AS SELECT * FROM {t}",
        "CREATE OR REPLACE TEMP VIEW v AS SELECT 1",
        "CACHE TABLE {t}",
        "SET spark.sql.shuffle.partitions = 1",
        "RESET",
        "USE default",
        "ADD JAR 'x.jar'",
        "EXECUTE IMMEDIATE 'drop table {t}'",
        "BEGIN DROP TABLE {t}; END",
        "EXPLAIN SELECT 1",
        "REFRESH TABLE {t}",
        "SELECT reflect('java.lang.System', 'getProperty', 'user.dir')",
        "SELECT java_method('java.lang.System', 'getProperty', 'user.dir')",
        "SELECT 1 WHERE EXISTS (SELECT try_reflect('java.lang.System', 'getProperty', 'user.dir'))",
        "SELECT TRANSFORM (id) USING 'cat' AS (x) FROM {t}",
        "SELECT 1 WHERE 'E1' IN (SELECT TRANSFORM (id) USING 'cat' AS (x) FROM {t})",
        "WITH a AS (SELECT TRANSFORM (id) USING 'cat' AS (x) FROM {t}) SELECT 1",
        "MAP id USING 'cat' FROM {t}",
        "/* /* */ SHOW TABLES */ DROP TABLE {t}",
        "-- goes on \\\nSHOW TABLES\nDROP TABLE {t}",
    ],
)
def test_everything_else_is_refused_and_not_run(spark, table, folder, text):
    text = text.format(t=table)
    with pytest.raises(ll.QueryRefused) as refused:
        ll.run_query(spark, text)
    assert text in str(refused.value)
    assert spark.catalog.tableExists(table) and spark.table(table).count() == len(LOGS)


@pytest.mark.parametrize(
    "text",
    [
        "SELECT 1; SELECT 2",
        "SELECT 1) INSERT INTO {t} SELECT * FROM (SELECT 'a', 'b', 'c', 'd'",
        "SELECT * FROM {t} ORDER BY",
        "SELECT 1 AS a), b AS (SELECT 2",
        "WITH a AS (SELECT 1) SELEC * FROM a",
    ],
)
def test_broken_text_gives_the_engines_reason(spark, table, text):
    with pytest.raises(ParseException):
        ll.run_query(spark, text.format(t=table))
    assert spark.table(table).count() == len(LOGS)


def test_unknown_table_gives_the_engines_reason(spark):
    with pytest.raises(AnalysisException, match="TABLE_OR_VIEW_NOT_FOUND"):
        ll.run_query(spark, "SELECT * FROM no_such_table")


def test_refusal_restores_the_quoting_setting(spark, table):
    for text in ("DROP TABLE x", "SELECT 1"):
        try:
            ll.run_query(spark, text, double_quoted_identifiers=True)
        except ll.QueryRefused:
            pass
        assert spark.conf.get("spark.sql.ansi.doubleQuotedIdentifiers") == "false"


def test_files_are_no_tables(spark, table, folder):
    for text in ("SELECT * FROM {f}", "WITH a AS (SELECT * FROM {f}) SELECT 1", "DESCRIBE {f}"):
        with pytest.raises(AnalysisException):
            ll.run_query(spark, text.format(f=f"text.`{folder('json')}`"))
    assert spark.conf.get("spark.sql.runSQLOnFiles") == "true"


def test_result_belongs_to_the_callers_session(spark, table):
    result = ll.run_query(spark, f"SELECT level FROM {table}")
    result.createOrReplaceTempView("own_result")
    try:
        assert spark.table("own_result").join(spark.table(table), "level").count() == 11
        assert ll.run_query(spark, "SELECT * FROM own_result").count() == len(LOGS)
    finally:
        spark.catalog.dropTempView("own_result")


def test_order_survives(spark):
    result = ll.run_query(
        spark, "SELECT id % 7 AS k, id FROM range(0, 20000, 1, 16) ORDER BY k DESC, id"
    )
    got = [tuple(r) for r in result.collect()]
    assert got == sorted(got, key=lambda r: (-r[0], r[1])) and len(got) == 20_000


def test_whole_result_is_returned(spark):
    assert ll.run_query(spark, "SELECT id FROM range(12345)").count() == 12_345


def test_preview(spark, table):
    assert ll.preview_table(spark, table).count() == len(LOGS)
    assert ll.preview_table(spark, table, 2).count() == 2
    assert ll.preview_table(spark, None) is None and ll.preview_table(spark, "") is None


def test_stringify(spark):
    result = spark.sql(
        "SELECT 1 AS i, CAST(NULL AS int) AS n, true AS b, CAST(1.5 AS decimal(4,2)) AS d,"
        " TIMESTAMP_NTZ '2024-01-01 00:00:00' AS t, '' AS e, 'x' AS `a.b`, array(1, 2) AS l"
    )
    text = ll.stringify_result(result)
    assert rows(text) == [("1", "", "true", "1.50", "2024-01-01 00:00:00", "", "x", "[1, 2]")]
    assert text.columns == result.columns
    assert {t for _, t in text.dtypes} == {"string"}


def test_stringify_with_repeated_names(spark):
    text = ll.stringify_result(spark.sql("SELECT 1 AS id, CAST(NULL AS int) AS id"))
    assert text.columns == ["id", "id"] and rows(text) == [("1", "")]


def test_a_table_may_have_the_inner_name(spark):
    spark.range(3).createOrReplaceTempView("read_only_query")
    try:
        assert ll.run_query(spark, "SELECT * FROM read_only_query").count() == 3
        assert ll.run_query(spark, "WITH read_only_query AS (SELECT 1) TABLE read_only_query").count() == 1
    finally:
        spark.catalog.dropTempView("read_only_query")


def test_wrapping_does_not_hinder_the_planner(spark, table, capsys):
    ll.run_query(spark, f"SELECT id FROM {table} WHERE level = 'ERROR' ORDER BY id LIMIT 5").explain()
    plan = capsys.readouterr().out
    assert "EqualTo(level,ERROR)" in plan and "ReadSchema: struct<level:string,id:string>" in plan
    assert "TakeOrderedAndProject" in plan and "Exchange" not in plan


def test_check_copes_with_every_kind_of_plan(spark, table):
    spark.udf.register("shout", lambda s: s.upper())
    for text in (
        f"SELECT shout(level) FROM {table}",
        f"SELECT level, row_number() OVER (PARTITION BY level ORDER BY message) FROM {table}",
        f"SELECT * FROM (SELECT level, id FROM {table}) PIVOT (count(*) FOR level IN ('ERROR', 'INFO'))",
        f"SELECT * FROM {table} TABLESAMPLE (100 PERCENT)",
        f"SELECT a.level, w FROM {table} a LATERAL VIEW explode(split(message, ' ')) AS w",
        f"SELECT a.level, b.n FROM {table} a, LATERAL (SELECT length(a.message) AS n) b",
        f"SELECT a.id, b.id FROM {table} a FULL OUTER JOIN {table} b ON a.id = b.id",
        "SELECT X'00ff', 1.5BD, INTERVAL '1' DAY, TIMESTAMP '2024-01-01 00:00:00', CAST(NULL AS void)",
        "SELECT parse_json('{\"a\": 1}'), named_struct('a', map(1, array(2)))",
        "SELECT max_by(id, id) FILTER (WHERE id > 1) FROM range(5) GROUP BY id % 2 HAVING count(*) > 1",
    ):
        assert ll.run_query(spark, text).count() > 0


def test_cached_result(spark, table):
    name = f"Cached_{uuid.uuid4().hex}"
    counts = ll.count_by_id(spark.table(table), "ERROR")
    cached = ll.cache_result(spark, name, counts)
    assert rows(cached) == rows(counts)
    assert "In-memory table" not in counts._jdf.queryExecution().executedPlan().toString()
    assert rows(ll.run_query(spark, f"SELECT * FROM {name}")) == rows(counts)

    warnings = ll.count_by_id(spark.table(table), "WARNING")
    assert rows(ll.cache_result(spark, name, warnings)) == [("W1", 1)]
    other = ll.cache_result(spark, f"{name}_too", warnings)
    assert ll.drop_cached_result(spark, name) and not ll.drop_cached_result(spark, name)
    assert rows(other) == [("W1", 1)]

    # A result may be made from the one it takes the place of.
    again = ll.cache_result(spark, f"{name}_too", other.unionAll(other))
    assert rows(again) == [("W1", 1)] * 2


def test_cached_results_do_not_replace_other_tables(spark, table):
    for attempt in (
        lambda: ll.cache_result(spark, table, spark.range(1)), lambda: ll.drop_cached_result(spark, table)
    ):
        with pytest.raises(ValueError):
            attempt()
    assert spark.table(table).count() == len(LOGS)

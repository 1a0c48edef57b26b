"""The registered queries: each operator over the given tables, or over data derived from them."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

import lumberline as ll
from lumberline.datasets import (
    document_lines,
    event_lines,
    event_rows,
    odd_time_lines,
    read_table,
    wrong_clock_lines,
)
from lumberline.scratch import scratch_path

RANGE_START, RANGE_END = "2024-01-05", "2024-01-08"
NAMED_DAYS = ("2024-01-05", "2024-01-06", "2024-01-07")
RANGE_START_TIME, RANGE_END_TIME = "2024-01-06 09:30:00", "2024-01-20 17:45:00"
STREAM_BUCKET, STREAM_DELAY = "1 day", "1 hour"

_made: dict[tuple[str, str, str], str] = {}


def _once(spark: SparkSession, sf_dir: str, what: str, make: Callable[[], str]) -> str:
    """The folder or table that ``make`` returned, made once per application."""
    key = (spark.sparkContext.applicationId, sf_dir, what)
    if key not in _made:
        _made[key] = make()
    return _made[key]


def _raw_folder(spark: SparkSession, sf_dir: str) -> str:
    """Every event as a line of a text file."""

    def make() -> str:
        path = scratch_path(spark, "raw")
        event_lines(spark, sf_dir).write.text(path)
        return path

    return _once(spark, sf_dir, "raw", make)


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.read_raw_logs(spark, _raw_folder(spark, sf_dir))


def _logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.parse_logs(_lines(spark, sf_dir))


def _document_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every line of every document, in a text file too; only a line feed ends a line."""

    def make() -> str:
        path = scratch_path(spark, "documents")
        document_lines(spark, sf_dir).write.text(path)
        return path

    return ll.read_raw_logs(spark, _once(spark, sf_dir, "documents", make), line_sep="\n")


def _odd_time_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event as a line whose time often is none, in a text file too."""

    def make() -> str:
        path = scratch_path(spark, "odd-times")
        odd_time_lines(spark, sf_dir).write.text(path)
        return path

    return ll.read_raw_logs(spark, _once(spark, sf_dir, "odd times", make))


def _columns(logs: DataFrame) -> DataFrame:
    return logs.select(*ll.LOG_SCHEMA.names)


def _json_folder(spark: SparkSession, sf_dir: str) -> str:
    path = scratch_path(spark, "json")
    ll.write_json_logs(_logs(spark, sf_dir), path)
    return path


def _clean_folder(spark: SparkSession, sf_dir: str, format: str) -> str:
    path = scratch_path(spark, format)
    ll.write_clean_logs(_logs(spark, sf_dir), path, format)
    return path


def _logs_table(spark: SparkSession, sf_dir: str) -> str:
    """``database.parsed_logs`` over the events' JSON lines."""

    def make() -> str:
        table = f"logs_{uuid.uuid4().hex}.parsed_logs"
        ll.register_logs(spark, table, _json_folder(spark, sf_dir))
        return table

    return _once(spark, sf_dir, "table", make)


# Sources and sinks


def read_raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lines(spark, sf_dir)


def json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.read_parsed_logs(spark, _json_folder(spark, sf_dir))


def raw_to_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "etl-json")
    ll.raw_to_json(spark, _raw_folder(spark, sf_dir), out)
    return ll.read_parsed_logs(spark, out)


def raw_to_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_path(spark, "etl-clean")
    ll.raw_to_clean(spark, _raw_folder(spark, sf_dir), out, without_levels=("INFO",))
    return _columns(ll.read_clean_logs(spark, out))


def parquet_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = ll.read_clean_logs(spark, _clean_folder(spark, sf_dir, "parquet"))
    in_range = ll.filter_time_range(ll.filter_level(logs, "ERROR"), RANGE_START, RANGE_END)
    return _columns(in_range)


def csv_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _columns(ll.read_clean_logs(spark, _clean_folder(spark, sf_dir, "csv"), "csv"))


def parquet_clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows with their times, stored in one folder."""
    path = scratch_path(spark, "parquet")
    ll.write_clean_logs(_logs(spark, sf_dir), path, partition_by=None)
    return ll.read_clean_logs(spark, path)


def csv_clean_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows with their times, in folders by level."""
    path = scratch_path(spark, "csv")
    ll.write_clean_logs(_logs(spark, sf_dir), path, "csv", partition_by="level")
    return ll.read_clean_logs(spark, path, "csv")


def list_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The listed tables of a database holding the logs in all three formats, with their rows."""
    database = f"logs_{uuid.uuid4().hex}"
    ll.register_logs(spark, f"{database}.parsed_logs", _json_folder(spark, sf_dir))
    for format in ("parquet", "csv"):
        folder = _clean_folder(spark, sf_dir, format)
        ll.register_logs(spark, f"{database}.clean_{format}", folder, format, partition_by="day")
    listed = ll.list_tables(spark, database)
    counts = None
    for name in ("parsed_logs", "clean_parquet", "clean_csv"):
        rows = spark.table(f"{database}.{name}").agg(F.count("*").alias("rows"))
        rows = rows.select(F.lit(name).alias("table_name"), "rows")
        counts = rows if counts is None else counts.unionAll(rows)
    return listed.join(counts, "table_name").select("table_name", "rows")


def stored_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = ll.count_by_id(_logs(spark, sf_dir), "ERROR")
    path = ll.store_result(counts, scratch_path(spark, "results"))
    return ll.read_result(spark, path, counts.schema)


def cached_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"error_counts_{uuid.uuid4().hex}"
    ll.cache_result(spark, name, ll.count_by_id(_logs(spark, sf_dir), "ERROR"))
    return ll.run_query(spark, f"SELECT id, count FROM {name}")


def replaced_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Days of clean files written again, twice, with their warnings alone; all others stay."""
    path = _clean_folder(spark, sf_dir, "parquet")
    again = ll.filter_level(ll.filter_time_range(_logs(spark, sf_dir), RANGE_START, RANGE_END), "WARNING")
    for _ in range(2):
        ll.write_clean_logs(again, path, mode="replace")
    return _columns(ll.read_clean_logs(spark, path))


def replaced_days_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with CSV, naming the days: one of them has no rows any more, and none of its old ones are left."""
    path = _clean_folder(spark, sf_dir, "csv")
    again = ll.filter_time_range(_logs(spark, sf_dir), NAMED_DAYS[0], NAMED_DAYS[-1])
    for _ in range(2):
        ll.replace_days(again, path, NAMED_DAYS, "csv")
    return _columns(ll.read_clean_logs(spark, path, "csv"))


def torn_lines_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON lines of which some are cut off and some glued together: the rows, and the broken lines as they are."""
    path = scratch_path(spark, "torn")
    line = F.to_json(F.struct(*ll.LOG_SCHEMA.names))
    number = F.crc32(line.cast("binary"))
    torn = F.when(number % 7 == 0, F.substring(line, 1, 40)).when(number % 7 == 1, F.concat(line, line)).otherwise(line)
    _logs(spark, sf_dir).select(torn.alias("value")).write.text(path)
    return ll.read_with_torn_lines(spark, path)


def catalog_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows by day of a table to which only some of the days written later were added."""
    path, table = scratch_path(spark, "days"), f"logs_{uuid.uuid4().hex}.clean_logs"
    logs = ll.with_event_time(_logs(spark, sf_dir))
    ll.write_clean_logs(logs.filter(F.col("day") < RANGE_START), path)
    ll.register_logs(spark, table, path, "parquet", partition_by="day")
    ll.write_clean_logs(logs.filter(F.col("day") >= RANGE_START), path, mode="replace")
    ll.refresh_logs(spark, table, days=NAMED_DAYS)
    return spark.table(table).groupBy("day", "level").count()


def remembered_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A count asked for three times: computed, answered from its table, and after a new file computed again."""
    path, database = _json_folder(spark, sf_dir), f"answers_{uuid.uuid4().hex}"
    answers, tables = None, []
    for asked in (1, 2, 3):
        if asked == 3:
            ll.write_json_logs(ll.filter_level(_logs(spark, sf_dir), "ERROR"), path, mode="append")
        found = ll.remembered(spark, ll.count_by_id(ll.read_parsed_logs(spark, path), "ERROR"), database)
        files = set(found.inputFiles())
        tables.append(files)
        known = F.lit("yes" if files in tables[:-1] else "no")
        rows = found.select(F.lit(asked).alias("asked"), known.alias("known"), "id", "count")
        answers = rows if answers is None else answers.unionByName(rows)
    return answers


def kept_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A query's result kept under an id and read back by it, with the types its manifest names."""
    location = scratch_path(spark, "kept")
    text = f"SELECT id, count(*) AS count, min(timestamp) AS first FROM {_logs_table(spark, sf_dir)} GROUP BY id"
    return ll.read_kept_result(spark, location, ll.run_query(spark, text, keep=location))


# Parsing, projections, filters


def parse_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.drop_unparsed(ll.parse_log_lines(_lines(spark, sf_dir)))


def parse_keeps_bad_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.parse_log_lines(_document_lines(spark, sf_dir))


def parse_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.parse_logs(_document_lines(spark, sf_dir))


def to_json_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.to_json_rows(_logs(spark, sf_dir))


def drop_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.drop_levels(_logs(spark, sf_dir))


def select_log_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.select_log_columns(_logs(spark, sf_dir))


def filter_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.filter_level(_logs(spark, sf_dir), "ERROR")


def filter_time_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.filter_time_range(_logs(spark, sf_dir), RANGE_START_TIME, RANGE_END_TIME)


def filter_level_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = ll.with_event_time(_logs(spark, sf_dir))
    in_range = ll.filter_time_range(ll.filter_level(logs, "ERROR"), RANGE_START, RANGE_END)
    return _columns(in_range)


def with_event_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.with_event_time(_logs(spark, sf_dir)).select("timestamp", "event_ts", "day")


def with_event_time_impossible(spark: SparkSession, sf_dir: str) -> DataFrame:
    logs = ll.parse_logs(_odd_time_lines(spark, sf_dir))
    timed = ll.with_event_time(logs).select("timestamp", "id", "event_ts", "day")
    return ll.stringify_result(timed)


# Aggregations


def count_by_id_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.count_by_id(_logs(spark, sf_dir), "ERROR")


def count_by_id_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.count_by_id(_logs(spark, sf_dir), "WARNING")


def count_by_id_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.count_by_id(_logs(spark, sf_dir), "INFO")


def counts_by_level_and_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.counts_by_level_and_id(_logs(spark, sf_dir))


def dashboard_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.dashboard_counts(spark, _logs_table(spark, sf_dir))


def share_by_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = ll.share_by_id(_logs(spark, sf_dir), "ERROR")
    return shares.withColumn("share", F.round("share", 6))


def count_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.count_per_day(_logs(spark, sf_dir))


def count_per_day_impossible(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.count_per_day(ll.parse_logs(_odd_time_lines(spark, sf_dir)))


def level_timeseries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.level_timeseries(_logs(spark, sf_dir))


def level_timeseries_quarter_hour(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.level_timeseries(_logs(spark, sf_dir), "15 minutes")


def error_series_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A level and a time range chosen, then counted by hour, over clean files."""
    logs = ll.read_clean_logs(spark, _clean_folder(spark, sf_dir, "parquet"))
    chosen = ll.filter_time_range(ll.filter_level(logs, "ERROR"), RANGE_START_TIME, RANGE_END_TIME)
    return ll.level_timeseries(chosen)


def trend_by_day_and_level(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.trend_by_day_and_level(_logs(spark, sf_dir))


# Joins by nearness in time


def _of_users(spark: SparkSession, sf_dir: str, level: str) -> DataFrame:
    """``who, event_ts, id`` of one level's rows, and ``until``: from one to a hundred hours later, by user."""
    logs = ll.with_event_time(ll.filter_level(_logs(spark, sf_dir), level))
    who = F.regexp_extract("message", r"user (\d+)$", 1).cast("bigint")
    hours = F.pow(who % 10 + 1, F.lit(2)).cast("int")
    return logs.select(who.alias("who"), "event_ts", "id", F.timestamp_add("HOUR", hours, "event_ts").alias("until"))


def latest_warning_before_error(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every error with the latest warning of its user."""
    errors, warnings = (_of_users(spark, sf_dir, level).drop("until") for level in ("ERROR", "WARNING"))
    return ll.as_of_join(errors, warnings, "event_ts", ["who"], bucket="1 day", prefix="warning_")


def next_error_after_warning(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Warnings with their user's next error, if it comes within half a day."""
    errors, warnings = (_of_users(spark, sf_dir, level).drop("until", "id") for level in ("ERROR", "WARNING"))
    return ll.as_of_join(
        warnings, errors, "event_ts", ["who"], tolerance="12 hours", direction="forward", strict=True, how="inner",
        bucket="1 day", prefix="error_")


def errors_in_warning_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of a warning's window and an error of the same user in it."""
    errors = _of_users(spark, sf_dir, "ERROR").select("who", "event_ts")
    windows = _of_users(spark, sf_dir, "WARNING").select("who", "event_ts", "until")
    return ll.interval_join(errors, windows, "event_ts", ("event_ts", "until"), ["who"], prefix="window_")


def errors_near_warnings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of an error and a warning, whoever's, at most two minutes apart."""
    errors, warnings = (_of_users(spark, sf_dir, level).select("who", "event_ts") for level in ("ERROR", "WARNING"))
    return ll.band_join(errors, warnings, "event_ts", "2 minutes", prefix="warning_")


def overlapping_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many windows of a user's warnings each window of the user's errors overlaps, where there are any."""
    errors, warnings = (_of_users(spark, sf_dir, level).drop("id") for level in ("ERROR", "WARNING"))
    pairs = ll.overlap_join(errors, warnings, ("event_ts", "until"), ("event_ts", "until"), ["who"], prefix="warning_")
    return pairs.groupBy("who", "event_ts").count()


# SQL surface


def catalog_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    database, name = _logs_table(spark, sf_dir).split(".")
    text = f"""SELECT id, COUNT(*) AS count FROM "{database}"."{name}" WHERE level='ERROR' GROUP BY id;"""
    return ll.run_query(spark, text, double_quoted_identifiers=True)


def preview_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows a preview has, and how many of them are the table's; which ones is chance."""
    table = _logs_table(spark, sf_dir)
    path = scratch_path(spark, "preview")
    ll.preview_table(spark, table).write.parquet(path)
    own = spark.table(table)
    shown = spark.read.schema(own.schema).parquet(path)

    def alike(a: str, b: str) -> list[Column]:
        return [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in own.columns]

    # Ten rows go to every task of the scan, and at most ten come back.
    known = own.alias("own").join(F.broadcast(shown.alias("asked")), alike("own", "asked"), "left_semi").distinct()
    known = known.withColumn("known", F.lit(True)).alias("known")
    # A preview of an empty table still gives a row of zeros.
    met = shown.alias("shown").join(F.broadcast(known), alike("shown", "known"), "left")
    return met.agg(F.count("*").alias("rows"), F.count("known.known").alias("rows_in_table"))


def stringify_result(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.stringify_result(_logs(spark, sf_dir).groupBy("id").count())


# SQL that run_query passes to Spark, and what the oracle runs over its own logs.
SQL_TEXTS = {
    "sql_join": """
        SELECT e.day, e.errors, coalesce(w.warnings, 0) AS warnings
        FROM (SELECT substr(timestamp, 1, 10) AS day, count(*) AS errors
              FROM {logs} WHERE level = 'ERROR' GROUP BY substr(timestamp, 1, 10)) e
        LEFT JOIN (SELECT substr(timestamp, 1, 10) AS day, count(*) AS warnings
                   FROM {logs} WHERE level = 'WARNING' GROUP BY substr(timestamp, 1, 10)) w
        ON e.day = w.day""",
    "sql_semi_anti_join": """
        SELECT h.hour, h.errors
        FROM (SELECT substr(timestamp, 1, 13) AS hour, count(*) AS errors
              FROM {logs} WHERE level = 'ERROR' GROUP BY substr(timestamp, 1, 13)) h
        WHERE NOT EXISTS (SELECT 1 FROM (SELECT DISTINCT substr(timestamp, 1, 13) AS hour
                                         FROM {logs} WHERE level = 'WARNING') w
                          WHERE w.hour = h.hour)
          AND h.hour IN (SELECT DISTINCT substr(timestamp, 1, 13) FROM {logs} WHERE level = 'INFO')""",
    "sql_window": """
        SELECT day, id, n, CAST(rank() OVER (PARTITION BY day ORDER BY n DESC) AS BIGINT) AS place
        FROM (SELECT substr(timestamp, 1, 10) AS day, id, count(*) AS n
              FROM {logs} WHERE level = 'ERROR' GROUP BY substr(timestamp, 1, 10), id) c""",
    "sql_rollup": """
        SELECT level, id, count(*) AS n FROM {logs} WHERE id IS NOT NULL
        GROUP BY ROLLUP (level, id)""",
    "sql_cube": """
        SELECT level, substr(timestamp, 1, 10) AS day, count(*) AS n FROM {logs}
        GROUP BY CUBE (level, substr(timestamp, 1, 10))""",
    "sql_grouping_sets": """
        SELECT level, id, count(*) AS n FROM {logs} WHERE id IS NOT NULL
        GROUP BY GROUPING SETS ((level), (id), ())""",
    "sql_distinct": """
        SELECT level, count(DISTINCT message) AS messages, count(DISTINCT id) AS ids
        FROM {logs} GROUP BY level""",
    "sql_top_k": """
        SELECT message, count(*) AS n FROM {logs} WHERE level = 'ERROR'
        GROUP BY message ORDER BY n DESC, message LIMIT 10""",
    "sql_set_operations": """
        (SELECT DISTINCT substr(timestamp, 1, 16) AS minute FROM {logs} WHERE level = 'ERROR'
         INTERSECT SELECT DISTINCT substr(timestamp, 1, 16) FROM {logs} WHERE level = 'INFO')
        UNION ALL
        (SELECT DISTINCT substr(timestamp, 1, 16) FROM {logs} WHERE level = 'WARNING'
         EXCEPT SELECT DISTINCT substr(timestamp, 1, 16) FROM {logs} WHERE level = 'INFO')""",
    "sql_functions": """
        WITH parts AS (
          SELECT lower(level) AS level, CAST(timestamp AS DATE) AS day,
                 CAST(extract(HOUR FROM CAST(timestamp AS TIMESTAMP)) AS BIGINT) AS hour,
                 CAST(coalesce(substr(id, 2), '0') AS BIGINT) AS id_number,
                 length(message) AS message_length
          FROM {logs} WHERE message LIKE '%user%')
        SELECT level, day, min(hour) AS first_hour, max(hour) AS last_hour,
               CAST(sum(id_number % 100) AS BIGINT) AS id_sum,
               CAST(sum(message_length) AS BIGINT) AS characters
        FROM parts GROUP BY level, day HAVING count(*) > 1""",
}


# The same over nested values: JSON texts, and arrays of a hundred turns of a conversation at most.
NESTED_SQL_TEXTS = {
    "sql_json": """
        SELECT event_type, key, count(*) AS n, CAST(sum(value) AS BIGINT) AS total, max(value) AS most
        FROM (SELECT event_type, explode(map_filter(from_json(props, 'MAP<STRING, BIGINT>'), (k, v) -> v % 2 = 0))
                     AS (key, value) FROM {events}) GROUP BY event_type, key""",
    "sql_nested": """
        WITH talks AS (
          SELECT conv_id, collect_list(struct(role, text)) AS turns FROM {conversations} WHERE role IS NOT NULL
          GROUP BY conv_id, turn DIV 100),
        roles AS (
          SELECT conv_id, map_from_entries(transform(array_distinct(transform(turns, t -> t.role)),
                   r -> struct(r, transform(filter(turns, t -> t.role = r), t -> coalesce(length(t.text), 0))))) AS lengths
          FROM talks),
        said AS (SELECT conv_id, role, texts FROM roles LATERAL VIEW explode(lengths) m AS role, texts)
        SELECT conv_id, role, CAST(sum(size(texts)) AS BIGINT) AS turns,
               CAST(sum(aggregate(texts, 0, (a, b) -> a + b)) AS BIGINT) AS characters
        FROM said GROUP BY conv_id, role""",
}


def _nested_sql_query(text: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        names = {}
        for table in ("events", "conversations"):
            names[table] = f"{table}_{uuid.uuid4().hex}"
            read_table(spark, sf_dir, table).createTempView(names[table])
        return ll.run_query(spark, text.format(**names))

    return query


def _sql_query(text: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return ll.run_query(spark, text.format(logs=_logs_table(spark, sf_dir)))

    return query


# Streaming


def stream_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ll.stream_raw_logs(spark, _raw_folder(spark, sf_dir))
    out, checkpoint = scratch_path(spark, "stream-json"), scratch_path(spark, "stream-state")
    ll.stream_parse_to_json(lines, out, checkpoint, {"availableNow": True}).awaitTermination()
    return ll.read_parsed_logs(spark, out)


def stream_level_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = ll.stream_raw_logs(spark, _raw_folder(spark, sf_dir))
    return _streamed(spark, ll.stream_level_counts(lines, STREAM_BUCKET, STREAM_DELAY))


def stream_wrong_clocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of events among lines of a far future, and how many of those came out apart."""

    def make() -> str:
        path = scratch_path(spark, "wrong-clocks")
        wrong_clock_lines(spark, sf_dir).write.text(path)
        return path

    folder = _once(spark, sf_dir, "wrong clocks", make)
    counts = _streamed(spark, ll.stream_level_counts(ll.stream_raw_logs(spark, folder), STREAM_BUCKET, STREAM_DELAY))
    ahead = _streamed(spark, ll.stream_ahead_of_arrival(ll.stream_raw_logs(spark, folder)))
    day = F.to_timestamp_ntz(F.substring("timestamp", 1, 10), F.lit("yyyy-MM-dd")).alias("bucket")
    return counts.unionByName(ahead.groupBy(day, "level").count())


def stream_late_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two thirds of the users' events, then the others', wrong clocks and impossible times: what becomes of each row.

    Counts by kind, day and level; a row of no real time has no day.
    """
    folder, out, state = (scratch_path(spark, f"late-{name}") for name in ("lines", "out", "state"))
    events, third = event_rows(spark, sf_dir), F.regexp_extract("message", r"user (\d+)$", 1).cast("bigint") % 3 == 0
    ahead = events.filter(third).withColumn("event_ts", F.expr("event_ts + INTERVAL '75' YEAR"))
    second = ll.render_log_lines(events.filter(third).unionByName(ahead)).unionByName(odd_time_lines(spark, sf_dir))
    for number, lines in enumerate((ll.render_log_lines(events.filter(~third)), second)):
        lines.write.text(f"{folder}/{number}")
        arrived = ll.stream_raw_logs(spark, folder, recursive=True)
        ll.stream_counts_apart(arrived, out, state, STREAM_BUCKET, STREAM_DELAY, trigger={"availableNow": True}).awaitTermination()
    found = ll.read_stream_counts(spark, out, state).select(
        F.lit("counted").alias("kind"), "bucket", "level", "count")
    for kind in ("ahead", "late", "untimed"):
        rows = ll.with_event_time(ll.read_stream_rows(spark, out, state, kind))
        counts = rows.groupBy(F.col("day").cast("timestamp_ntz").alias("bucket"), "level").count()
        found = found.unionByName(counts.withColumn("kind", F.lit(kind)))
    return found


def _streamed(spark: SparkSession, stream: DataFrame) -> DataFrame:
    out, checkpoint = scratch_path(spark, "stream-out"), scratch_path(spark, "stream-state")
    (
        stream.writeStream.format("parquet")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
        .awaitTermination()
    )
    return spark.read.schema(stream.schema).parquet(out)


# Synthesis


def _synthetic(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log rows made from the events' numbers, which count from 0."""
    return ll.synthesize_for(read_table(spark, sf_dir, "events").select(F.col("event_id").alias("n")))


def synthesize_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _synthetic(spark, sf_dir)


def render_log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ll.render_log_lines(event_rows(spark, sf_dir))


def write_raw_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "synthetic")
    ll.write_raw_logs(_synthetic(spark, sf_dir), path)
    return ll.parse_logs(ll.read_raw_logs(spark, path, recursive=True))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: query
    for query in (
        read_raw_logs,
        json_round_trip,
        raw_to_json,
        raw_to_clean,
        parquet_clean,
        csv_clean,
        parquet_clean_all,
        csv_clean_all,
        list_tables,
        stored_result,
        cached_result,
        replaced_days,
        replaced_days_csv,
        torn_lines_apart,
        catalog_days,
        remembered_result,
        kept_result,
        parse_log_lines,
        parse_keeps_bad_lines,
        parse_logs,
        to_json_rows,
        drop_info,
        select_log_columns,
        filter_level,
        filter_time_range,
        filter_level_range,
        with_event_time,
        with_event_time_impossible,
        count_by_id_error,
        count_by_id_warning,
        count_by_id_info,
        counts_by_level_and_id,
        dashboard_counts,
        share_by_id,
        count_per_day,
        count_per_day_impossible,
        level_timeseries,
        level_timeseries_quarter_hour,
        error_series_in_range,
        trend_by_day_and_level,
        latest_warning_before_error,
        next_error_after_warning,
        errors_in_warning_windows,
        errors_near_warnings,
        overlapping_windows,
        catalog_sql,
        preview_table,
        stringify_result,
        stream_parse,
        stream_level_counts,
        stream_wrong_clocks,
        stream_late_rows,
        synthesize_logs,
        render_log_lines,
        write_raw_logs,
    )
} | {name: _sql_query(text) for name, text in SQL_TEXTS.items()} | {
    name: _nested_sql_query(text) for name, text in NESTED_SQL_TEXTS.items()
}

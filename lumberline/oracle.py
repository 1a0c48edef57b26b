"""The registered queries once more, as SQL for another engine over the same tables."""

from __future__ import annotations

from lumberline.functions.synthesis import (
    ERROR_MESSAGES,
    INFO_MESSAGES,
    LEVEL_STRIDE,
    WARNING_MESSAGES,
)
from lumberline.schema import (
    DEFAULT_ERROR_PCT,
    DEFAULT_LINES_PER_FILE,
    DEFAULT_WARNING_PCT,
    ERROR_ID_FIRST,
    LINE_PATTERN,
    PREVIEW_ROWS,
    WARNING_ID_FIRST,
)
from lumberline.sources.synth import DEFAULT_SEED, DEFAULT_START
from lumberline.workload import (
    NAMED_DAYS,
    RANGE_END,
    RANGE_END_TIME,
    RANGE_START,
    RANGE_START_TIME,
    SQL_TEXTS,
    STREAM_DELAY,
)


def _fields(lines: str) -> str:
    return f"""
        SELECT regexp_extract(value, '{LINE_PATTERN}', 1) AS "timestamp",
               regexp_extract(value, '{LINE_PATTERN}', 2) AS level,
               regexp_extract(value, '{LINE_PATTERN}', 3) AS message,
               NULLIF(regexp_extract(value, '{LINE_PATTERN}', 4), '') AS id
        FROM {lines} WHERE regexp_matches(value, '{LINE_PATTERN}')"""


EVENTS = f"""
WITH raw AS (
  SELECT concat(strftime(ts, '%Y-%m-%d %H:%M:%S'), ', ',
    CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'signup' THEN 'WARNING' ELSE 'INFO' END,
    ': ', event_type, ' by user ', CAST(user_id AS VARCHAR),
    CASE event_type
      WHEN 'error' THEN concat(', (E', CAST({ERROR_ID_FIRST} + user_id % 10 AS VARCHAR), ')')
      WHEN 'signup' THEN concat(', (W', CAST({WARNING_ID_FIRST} + user_id % 10 AS VARCHAR), ')')
      ELSE '' END) AS value
  FROM events),
logs AS ({_fields("raw")}),
typed AS (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts FROM logs)
"""

DOCUMENTS = f"""
WITH texts AS (
  SELECT doc_id, lang, unnest(string_split(text, chr(10))) AS text FROM documents),
lines AS (
  SELECT text AS value FROM texts
  UNION ALL
  SELECT concat('2024-03-01 12:00:00, ', lang, ': ', text, ', (doc_', CAST(doc_id AS VARCHAR), ')')
  FROM texts),
logs AS ({_fields("lines")})
"""

ODD_TIMES = f"""
WITH raw AS (
  SELECT concat('2024-', lpad(CAST(1 + event_id % 14 AS VARCHAR), 2, '0'), '-',
    lpad(CAST(1 + user_id % 33 AS VARCHAR), 2, '0'), ' ',
    lpad(CAST(user_id % 24 AS VARCHAR), 2, '0'), ':', lpad(CAST(event_id % 63 AS VARCHAR), 2, '0'), ':',
    lpad(CAST(user_id % 60 AS VARCHAR), 2, '0'), ', ERROR: ', event_type,
    ', (U', CAST(user_id AS VARCHAR), ')') AS value
  FROM events),
logs AS ({_fields("raw")}),
typed AS (SELECT *, TRY_CAST("timestamp" AS TIMESTAMP) AS event_ts FROM logs)
"""


def _list(messages: tuple[str, ...]) -> str:
    return "[" + ", ".join(f"'{m}'" for m in messages) + "]"


SYNTHETIC = f"""
WITH draws AS (
  SELECT event_id AS n, (event_id * {LEVEL_STRIDE} + {DEFAULT_SEED}) % 100 + 1 AS draw,
         CAST((event_id // 100) % 10 AS INTEGER) + 1 AS pick, (event_id // 1000) % 10 AS id_number
  FROM events),
synthetic AS (
  SELECT n // {DEFAULT_LINES_PER_FILE} + 1 AS file_index,
         n % {DEFAULT_LINES_PER_FILE} + 1 AS line_no,
         CASE WHEN draw <= {DEFAULT_ERROR_PCT} THEN 'ERROR'
              WHEN draw <= {DEFAULT_ERROR_PCT + DEFAULT_WARNING_PCT} THEN 'WARNING'
              ELSE 'INFO' END AS level,
         CASE WHEN draw <= {DEFAULT_ERROR_PCT} THEN {_list(ERROR_MESSAGES)}[pick]
              WHEN draw <= {DEFAULT_ERROR_PCT + DEFAULT_WARNING_PCT}
                THEN {_list(WARNING_MESSAGES)}[pick]
              ELSE {_list(INFO_MESSAGES)}[pick] END AS message,
         CASE WHEN draw <= {DEFAULT_ERROR_PCT}
                THEN concat('E', CAST({ERROR_ID_FIRST} + id_number AS VARCHAR))
              WHEN draw <= {DEFAULT_ERROR_PCT + DEFAULT_WARNING_PCT}
                THEN concat('W', CAST({WARNING_ID_FIRST} + id_number AS VARCHAR)) END AS id,
         TIMESTAMP '{DEFAULT_START}' + to_seconds(n) AS event_ts
  FROM draws)
"""

# Errors and warnings of users, and windows of one to a hundred hours after them.
USERS = EVENTS + """, users AS (
  SELECT CAST(regexp_extract(message, 'user (\\d+)$', 1) AS BIGINT) AS who, level, event_ts, id FROM typed),
spans AS (SELECT *, event_ts + to_hours((who % 10 + 1) * (who % 10 + 1)) AS until FROM users),
errors AS (SELECT * FROM spans WHERE level = 'ERROR'),
warnings AS (SELECT * FROM spans WHERE level = 'WARNING')
"""

# Two arrivals of lines: of some users; of the others, once more 75 years ahead, and lines of odd times.
ARRIVALS = ODD_TIMES.replace("raw AS", "odd_raw AS").replace('"raw"', '"odd_raw"').replace("FROM raw", "FROM odd_raw").replace(
    "logs AS", "odd_logs AS").replace("FROM logs", "FROM odd_logs").replace("typed AS", "odd AS") + EVENTS.replace("WITH", ",") + f""",
users AS (SELECT *, CAST(regexp_extract(message, 'user (\\d+)$', 1) AS BIGINT) % 3 = 0 AS second FROM typed),
mark AS (SELECT max(event_ts) AS newest FROM users WHERE NOT second),
arrived AS (
  SELECT level, event_ts, false AS ahead, second FROM users
  UNION ALL SELECT level, event_ts + INTERVAL 75 YEAR, true, true FROM users WHERE second
  UNION ALL SELECT level, event_ts, false, true FROM odd),
judged AS (
  SELECT CASE WHEN event_ts IS NULL THEN 'untimed' WHEN ahead THEN 'ahead'
              WHEN second AND date_trunc('DAY', event_ts) + INTERVAL 1 DAY <= newest - INTERVAL {STREAM_DELAY} THEN 'late'
              ELSE 'counted' END AS kind,
         CAST(date_trunc('DAY', event_ts) AS TIMESTAMP) AS bucket, level
  FROM arrived, mark)
"""

_JSON_LINE = """concat('{"timestamp":"', "timestamp", '","level":"', level, '","message":"', message, '"',
        CASE WHEN id IS NULL THEN '' ELSE concat(',"id":"', id, '"') END, '}')"""
# crc32 of a line, modulo 7: bit by bit over its bytes.
_LINE_NUMBER = """xor(list_reduce(
        flatten([[('0x' || substr(hex(encode(line)), 2 * i + 1, 2))::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]
                 FOR i IN range(length(hex(encode(line))) // 2)]),
        lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END,
        4294967295::BIGINT), 4294967295) % 7"""

_COLUMNS = 'SELECT "timestamp", level, message, id'
_COUNT_BY_ID = "SELECT id, COUNT(*) AS count FROM logs WHERE level = '{}' GROUP BY id"
_IN_RANGE = (
    f"event_ts >= TIMESTAMP '{RANGE_START} 00:00:00' AND event_ts < TIMESTAMP '{RANGE_END} 00:00:00'"
)
_ALL_LOGS = f"{EVENTS} {_COLUMNS} FROM logs"
_ALL_CLEAN = f"{EVENTS} {_COLUMNS}, event_ts, CAST(event_ts AS DATE) AS day FROM typed"
_ERROR_COUNTS = EVENTS + _COUNT_BY_ID.format("ERROR")
_ERRORS_IN_RANGE = f"{EVENTS} {_COLUMNS} FROM typed WHERE level = 'ERROR' AND {_IN_RANGE}"
_LEVEL_AND_ID = f"""{EVENTS} SELECT level, id, COUNT(*) AS count FROM logs
    WHERE level IN ('ERROR', 'WARNING') GROUP BY level, id"""


def _timeseries(bucket: str) -> str:
    return f"{EVENTS} SELECT {bucket} AS bucket, level, COUNT(*) AS count FROM typed GROUP BY 1, level"


ORACLE: dict[str, str] = {
    "read_raw_logs": f"{EVENTS} SELECT value FROM raw",
    "json_round_trip": _ALL_LOGS,
    "raw_to_json": _ALL_LOGS,
    "raw_to_clean": f"{EVENTS} {_COLUMNS} FROM logs WHERE level <> 'INFO'",
    "parquet_clean": _ERRORS_IN_RANGE,
    "csv_clean": _ALL_LOGS,
    "parquet_clean_all": _ALL_CLEAN,
    "csv_clean_all": _ALL_CLEAN,
    "list_tables": f"""{EVENTS} SELECT table_name, (SELECT COUNT(*) FROM logs) AS "rows"
        FROM (VALUES ('parsed_logs'), ('clean_parquet'), ('clean_csv')) AS t(table_name)""",
    "stored_result": _ERROR_COUNTS,
    "cached_result": _ERROR_COUNTS,
    "replaced_days": f"""{EVENTS} {_COLUMNS} FROM typed WHERE NOT ({_IN_RANGE}) OR level = 'WARNING'""",
    "replaced_days_csv": f"""{EVENTS} {_COLUMNS} FROM typed WHERE CAST(event_ts AS DATE) <> DATE '{NAMED_DAYS[-1]}'""",
    "torn_lines_apart": f"""{EVENTS}, lines AS (SELECT *, {_JSON_LINE} AS line FROM logs),
        numbered AS (SELECT *, {_LINE_NUMBER} AS number FROM lines)
        {_COLUMNS}, NULL::VARCHAR AS torn FROM numbered WHERE number > 1
        UNION ALL SELECT NULL, NULL, NULL, NULL, CASE number WHEN 0 THEN substr(line, 1, 40) ELSE line || line END
        FROM numbered WHERE number <= 1""",
    "catalog_days": f"""{EVENTS} SELECT CAST(event_ts AS DATE) AS day, level, COUNT(*) AS count FROM typed
        WHERE CAST(event_ts AS DATE) <= DATE '{NAMED_DAYS[-1]}' GROUP BY 1, level""",
    "remembered_result": f"""{EVENTS}, counts AS ({_COUNT_BY_ID.format("ERROR")})
        SELECT asked, CASE asked WHEN 2 THEN 'yes' ELSE 'no' END AS known, id, CASE asked WHEN 3 THEN 2 ELSE 1 END * count AS count
        FROM counts, (VALUES (1), (2), (3)) AS t(asked)""",
    "kept_result": f"""{EVENTS} SELECT id, COUNT(*) AS count, min("timestamp") AS first FROM logs GROUP BY id""",
    "parse_log_lines": _ALL_LOGS,
    "parse_keeps_bad_lines": f"""{DOCUMENTS} {_COLUMNS} FROM logs UNION ALL
        SELECT NULL, NULL, NULL, NULL FROM lines WHERE NOT regexp_matches(value, '{LINE_PATTERN}')""",
    "parse_logs": f"{DOCUMENTS} {_COLUMNS} FROM logs",
    "to_json_rows": f"""{EVENTS} SELECT concat('{{"timestamp":"', "timestamp", '","level":"', level,
        '","message":"', message, '"', CASE WHEN id IS NULL THEN '' ELSE concat(',"id":"', id, '"') END,
        '}}') AS json_data FROM logs""",
    "drop_info": f"{EVENTS} {_COLUMNS} FROM logs WHERE level <> 'INFO'",
    "select_log_columns": f'{EVENTS} SELECT "timestamp", level AS log_level FROM logs',
    "filter_level": f"{EVENTS} {_COLUMNS} FROM logs WHERE level = 'ERROR'",
    "filter_time_range": f"""{EVENTS} {_COLUMNS} FROM typed
        WHERE event_ts >= TIMESTAMP '{RANGE_START_TIME}' AND event_ts < TIMESTAMP '{RANGE_END_TIME}'""",
    "filter_level_range": _ERRORS_IN_RANGE,
    "with_event_time": f"""{EVENTS} SELECT "timestamp", event_ts, CAST(event_ts AS DATE) AS day
        FROM typed""",
    "with_event_time_impossible": f"""{ODD_TIMES} SELECT "timestamp", id,
        COALESCE(CAST(event_ts AS VARCHAR), '') AS event_ts,
        COALESCE(CAST(CAST(event_ts AS DATE) AS VARCHAR), '') AS day FROM typed""",
    "count_by_id_error": _ERROR_COUNTS,
    "count_by_id_warning": EVENTS + _COUNT_BY_ID.format("WARNING"),
    "count_by_id_info": EVENTS + _COUNT_BY_ID.format("INFO"),
    "counts_by_level_and_id": _LEVEL_AND_ID,
    "dashboard_counts": _LEVEL_AND_ID,
    "share_by_id": f"""{EVENTS} SELECT id, COUNT(*) AS count,
        ROUND(CAST(COUNT(*) AS DOUBLE) / CAST(SUM(COUNT(*)) OVER () AS DOUBLE), 6) AS share
        FROM logs WHERE level = 'ERROR' GROUP BY id""",
    "count_per_day": f"""{EVENTS} SELECT CAST(event_ts AS DATE) AS day, COUNT(*) AS count
        FROM typed WHERE level = 'ERROR' GROUP BY CAST(event_ts AS DATE)""",
    "count_per_day_impossible": f"""{ODD_TIMES} SELECT CAST(event_ts AS DATE) AS day, COUNT(*) AS count
        FROM typed WHERE event_ts IS NOT NULL GROUP BY CAST(event_ts AS DATE)""",
    "level_timeseries": _timeseries("date_trunc('HOUR', event_ts)"),
    "level_timeseries_quarter_hour": _timeseries("time_bucket(INTERVAL 15 MINUTES, event_ts)"),
    "error_series_in_range": f"""{EVENTS} SELECT date_trunc('HOUR', event_ts) AS bucket, level,
        COUNT(*) AS count FROM typed WHERE level = 'ERROR'
        AND event_ts >= TIMESTAMP '{RANGE_START_TIME}' AND event_ts < TIMESTAMP '{RANGE_END_TIME}'
        GROUP BY 1, level""",
    "trend_by_day_and_level": f"""{EVENTS} SELECT CAST(event_ts AS DATE) AS day, level,
        COUNT(*) AS count FROM typed GROUP BY CAST(event_ts AS DATE), level""",
    "latest_warning_before_error": f"""{USERS} SELECT e.who, e.event_ts, e.id, w.event_ts AS warning_event_ts, w.id AS warning_id
        FROM errors e ASOF LEFT JOIN warnings w ON e.who = w.who AND e.event_ts >= w.event_ts""",
    "next_error_after_warning": f"""{USERS} SELECT w.who, w.event_ts, e.event_ts AS error_event_ts
        FROM warnings w ASOF JOIN errors e ON w.who = e.who AND w.event_ts < e.event_ts
        WHERE e.event_ts - w.event_ts <= INTERVAL 12 HOUR""",
    "errors_in_warning_windows": f"""{USERS} SELECT e.who, e.event_ts, w.event_ts AS window_event_ts, w.until AS window_until
        FROM errors e JOIN warnings w ON e.who = w.who AND e.event_ts >= w.event_ts AND e.event_ts < w.until""",
    "errors_near_warnings": f"""{USERS} SELECT e.who, e.event_ts, w.who AS warning_who, w.event_ts AS warning_event_ts
        FROM errors e JOIN warnings w
        ON e.event_ts >= w.event_ts - INTERVAL 2 MINUTE AND e.event_ts <= w.event_ts + INTERVAL 2 MINUTE""",
    "overlapping_windows": f"""{USERS} SELECT e.who, e.event_ts, COUNT(*) AS count
        FROM errors e JOIN warnings w ON e.who = w.who AND e.event_ts < w.until AND w.event_ts < e.until
        GROUP BY e.who, e.event_ts""",
    "catalog_sql": _ERROR_COUNTS,
    "preview_table": f"""{EVENTS} SELECT least(COUNT(*), {PREVIEW_ROWS}) AS "rows",
        least(COUNT(*), {PREVIEW_ROWS}) AS rows_in_table FROM logs""",
    "stringify_result": f"""{EVENTS} SELECT COALESCE(id, '') AS id, CAST(COUNT(*) AS VARCHAR) AS count
        FROM logs GROUP BY COALESCE(id, '')""",
    "stream_parse": _ALL_LOGS,
    "stream_level_counts": f"""{EVENTS}, days AS (
        SELECT date_trunc('DAY', event_ts) AS bucket, level, COUNT(*) AS count
        FROM typed GROUP BY 1, level)
        SELECT CAST(bucket AS TIMESTAMP) AS bucket, level, count FROM days
        WHERE bucket + INTERVAL 1 DAY <= (SELECT MAX(event_ts) FROM typed) - INTERVAL {STREAM_DELAY}""",
    "stream_wrong_clocks": f"""{EVENTS}, days AS (
        SELECT CAST(date_trunc('DAY', event_ts) AS TIMESTAMP) AS bucket, level, COUNT(*) AS count
        FROM typed GROUP BY 1, level)
        SELECT bucket, level, count FROM days
        WHERE bucket + INTERVAL 1 DAY <= (SELECT MAX(event_ts) FROM typed) - INTERVAL {STREAM_DELAY}
        UNION ALL
        SELECT CAST(date_trunc('DAY', event_ts + INTERVAL 75 YEAR) AS TIMESTAMP), level, COUNT(*)
        FROM typed GROUP BY 1, level""",
    "stream_late_rows": f"{ARRIVALS} SELECT kind, bucket, level, COUNT(*) AS count FROM judged GROUP BY kind, bucket, level",
    "sql_json": """
        SELECT event_type, key, COUNT(*) AS n, CAST(sum(value) AS BIGINT) AS total, max(value) AS most
        FROM (SELECT event_type, key, CAST(json_extract(props, '$."' || key || '"') AS BIGINT) AS value
              FROM (SELECT event_type, props, unnest(json_keys(props)) AS key FROM events))
        WHERE value % 2 = 0 GROUP BY event_type, key""",
    "sql_nested": """
        SELECT conv_id, role, COUNT(*) AS turns, CAST(sum(coalesce(length(text), 0)) AS BIGINT) AS characters
        FROM conversations WHERE role IS NOT NULL GROUP BY conv_id, role""",
    "synthesize_logs": f"""{SYNTHETIC} SELECT file_index, line_no, level, message, id, event_ts
        FROM synthetic""",
    "render_log_lines": f"{EVENTS} SELECT value FROM raw",
    "write_raw_logs": f"""{SYNTHETIC} SELECT strftime(event_ts, '%Y-%m-%d %H:%M:%S') AS "timestamp",
        level, message, id FROM synthetic""",
} | {name: EVENTS + text.format(logs="logs") for name, text in SQL_TEXTS.items()}

# A query that begins with its own WITH cannot follow another one.
ORACLE["sql_functions"] = (
    EVENTS.rstrip() + ", " + SQL_TEXTS["sql_functions"].format(logs="logs").strip().removeprefix("WITH ")
)

"""Schemas and fixed values of the log data model."""

from __future__ import annotations

from pyspark.sql.types import (
    DateType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)

RAW_SCHEMA = StructType([StructField("value", StringType(), False)])

LOG_SCHEMA = StructType(
    [
        StructField("timestamp", StringType(), False),
        StructField("level", StringType(), False),
        StructField("message", StringType(), False),
        StructField("id", StringType(), True),
    ]
)

EVENT_TIME_FIELDS = [
    StructField("event_ts", TimestampNTZType(), True),
    StructField("day", DateType(), True),
]

CLEAN_SCHEMA = StructType(LOG_SCHEMA.fields + EVENT_TIME_FIELDS)

# The line grammar and the layout of generated lines.
#   <yyyy-MM-dd HH:mm:ss>, <level>: <message>[, (<id>)]
TIMESTAMP_FORMAT = "yyyy-MM-dd HH:mm:ss"
TIMESTAMP_LENGTH = 19
DIGIT = r"\p{Nd}"
WORD = r"[\p{L}\p{N}_]"
TIMESTAMP_PATTERN = (
    rf"{DIGIT}{{4}}-{DIGIT}{{2}}-{DIGIT}{{2}} {DIGIT}{{2}}:{DIGIT}{{2}}:{DIGIT}{{2}}"
)
LINE_PATTERN = rf"^({TIMESTAMP_PATTERN}), ({WORD}+): (.*?)(?:, \(({WORD}+)\))?$"
ERROR_ID_PREFIX, ERROR_ID_FIRST = "E", 2001
WARNING_ID_PREFIX, WARNING_ID_FIRST = "W", 1001
IDS_PER_LEVEL = 10
DEFAULT_FILES, DEFAULT_LINES_PER_FILE = 5, 2000
DEFAULT_ERROR_PCT, DEFAULT_WARNING_PCT = 10, 20
PREVIEW_ROWS = 10

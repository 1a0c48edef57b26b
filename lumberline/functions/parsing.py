"""Column expressions for one log line. Batch and stream share them.

Regular expressions see only what they must: one checks the start of the line, one the id after the
last ", (". The message is cut out by byte positions that those two fix, since finding bytes is far
cheaper than matching or counting characters. Everything is a built-in expression, so no row leaves
the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lumberline.schema import TIMESTAMP_FORMAT, TIMESTAMP_LENGTH, TIMESTAMP_PATTERN, WORD

LINE_START = rf"^{TIMESTAMP_PATTERN}, {WORD}++: "
ID_TAIL = rf"^({WORD}+)\)\n?\z"

# 1-based position of the level: timestamp, then ", ".
_LEVEL_START = TIMESTAMP_LENGTH + 3
_TO_THE_END = 2**31 - 1
# ", (" and ")" around the id.
_ID_BRACKETS = 4


def is_log_line(value: Column) -> Column:
    """True where the line follows the grammar; NULL for a NULL line.

    A line may carry one trailing line feed (message queues keep it); any other breaks it.
    """
    before_line_feed = F.octet_length(F.substring_index(value, "\n", 1))
    one_line = ~value.contains("\n") | (before_line_feed + 1 == F.octet_length(value))
    return value.rlike(LINE_START) & one_line


def line_head(value: Column) -> Column:
    """Timestamp and level: what comes before the first ": "."""
    return F.substring_index(value, ": ", 1)


def id_suffix(value: Column) -> Column:
    """The id at the end of the line, or the empty text; an id itself is never empty."""
    tail = F.substring_index(value, ", (", -1)
    may_have_id = value.endswith(")") | value.endswith(")\n")
    return F.when(may_have_id, F.regexp_extract(tail, ID_TAIL, 1)).otherwise("")


def log_fields(value: Column, head: Column, suffix: Column) -> dict[str, Column]:
    """The four fields of a line, given its :func:`line_head` and :func:`id_suffix`.

    Meaningful only where :func:`is_log_line` holds. Broken bytes in a message become U+FFFD.
    """
    message_start = F.octet_length(head) + 3
    suffix_length = F.when(suffix != "", F.octet_length(suffix) + _ID_BRACKETS).otherwise(0)
    line_feed = F.when(value.endswith("\n"), 1).otherwise(0)
    message_length = F.octet_length(value) - (message_start - 1) - suffix_length - line_feed
    message = F.substring(value.cast("binary"), message_start, message_length).cast("string")

    return {
        "timestamp": F.substring(head, 1, TIMESTAMP_LENGTH),
        "level": F.substring(head, _LEVEL_START, _TO_THE_END),
        "message": F.make_valid_utf8(message),
        "id": F.when(suffix != "", suffix),
    }


def event_time(timestamp: Column) -> Column:
    """Wall-clock time without a zone; NULL where the text is no real time."""
    return timestamp.try_cast("timestamp_ntz")


def instant(timestamp: Column) -> Column:
    """The same wall-clock reading taken as UTC, which is what watermarks accept.

    The explicit zone keeps the result the same under any session time zone.
    """
    return F.concat(timestamp, F.lit("Z")).try_cast("timestamp")


def wall_clock(moment: Column) -> Column:
    """Inverse of :func:`instant`."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(moment), epoch)


def timestamp_text(event_ts: Column) -> Column:
    return F.date_format(event_ts, TIMESTAMP_FORMAT)


def log_line(timestamp: Column, level: Column, message: Column, log_id: Column) -> Column:
    """Line text; the id suffix only where there is an id."""
    suffix = F.coalesce(F.concat(F.lit(", ("), log_id, F.lit(")")), F.lit(""))
    return F.concat(timestamp, F.lit(", "), level, F.lit(": "), message, suffix)

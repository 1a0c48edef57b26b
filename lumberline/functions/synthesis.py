"""Arithmetic that turns a row number into the fields of a log row.

The values depend on the row number alone, never on how rows are spread over tasks, so a lost task
is recomputed to the same rows and any SQL engine can reproduce them.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from lumberline.schema import (
    ERROR_ID_FIRST,
    ERROR_ID_PREFIX,
    IDS_PER_LEVEL,
    WARNING_ID_FIRST,
    WARNING_ID_PREFIX,
)

LEVEL_STRIDE = 7919

INFO_MESSAGES = (
    "worker joined the pool",
    "batch accepted",
    "cache warmed",
    "report rendered",
    "route table reloaded",
    "heartbeat received",
    "snapshot stored",
    "index segment merged",
    "token renewed",
    "queue drained",
)
WARNING_MESSAGES = (
    "queue is three quarters full",
    "clock drift above one second",
    "retrying a slow upstream",
    "certificate ends within a week",
    "replica lags behind",
    "fallback locale in use",
    "thread pool nearly exhausted",
    "unknown option ignored",
    "large response truncated by peer",
    "lease renewed late",
)
ERROR_MESSAGES = (
    "upstream refused the connection",
    "checksum mismatch in segment",
    "worker lost its lease",
    "payload could not be decoded",
    "volume is read-only",
    "quota exceeded for tenant",
    "handshake failed",
    "index segment missing",
    "transaction rolled back",
    "mail relay unreachable",
)


def div(left: Column, right: int) -> Column:
    return F.call_function("div", left, F.lit(right))


def synthetic_fields(
    n: Column, seed: int, error_pct: int, warning_pct: int, start: str, step_micros: int
) -> dict[str, Column]:
    """Level, message, id and time of row number ``n`` (counted from 0)."""
    draw = F.pmod(n * LEVEL_STRIDE + F.lit(seed).cast("bigint"), F.lit(100)) + 1
    is_error = draw <= error_pct
    is_warning = draw <= error_pct + warning_pct

    pick = div(n, 100)
    id_number = F.pmod(div(n, 1000), F.lit(IDS_PER_LEVEL))
    seconds = div(n * F.lit(step_micros).cast("bigint"), 1_000_000)
    return {
        "level": F.when(is_error, "ERROR").when(is_warning, "WARNING").otherwise("INFO"),
        "message": F.when(is_error, _choice(ERROR_MESSAGES, pick))
        .when(is_warning, _choice(WARNING_MESSAGES, pick))
        .otherwise(_choice(INFO_MESSAGES, pick)),
        "id": F.when(is_error, F.concat(F.lit(ERROR_ID_PREFIX), id_number + ERROR_ID_FIRST)).when(
            is_warning, F.concat(F.lit(WARNING_ID_PREFIX), id_number + WARNING_ID_FIRST)
        ),
        "event_ts": F.timestamp_add("SECOND", seconds, F.lit(start).cast("timestamp_ntz")),
    }


def _choice(messages: tuple[str, ...], pick: Column) -> Column:
    index = F.pmod(pick, F.lit(len(messages))).cast("int") + 1
    return F.element_at(F.array(*[F.lit(m) for m in messages]), index)

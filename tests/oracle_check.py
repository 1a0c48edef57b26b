"""Runs every registered query on Spark and its SQL on DuckDB and compares all rows.

    python -m tests.oracle_check [folder] [query ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb

DEFAULT_FOLDER = "/root/testdata/sf0.01"

TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for file in sorted(Path(folder).glob("*.parquet")):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection


def canonical(rows) -> list[tuple]:
    """Rows as sorted tuples of text, so that NULLs sort too."""
    return sorted(tuple("\0" if v is None else repr(v) for v in row) for row in rows)


def compare(spark, connection, query, sql: str, folder: str) -> str:
    """Empty if columns and rows agree, else what differs."""
    got = query(spark, folder)
    columns = sorted(got.columns)
    expected = connection.sql(sql)
    if columns != sorted(expected.columns):
        return f"columns {columns} against {sorted(expected.columns)}"
    types = [(c, str(got.schema[c].dataType.simpleString())) for c in columns]
    their_types = dict(zip(expected.columns, map(str, expected.types)))
    unlike = [(c, t, their_types[c]) for c, t in types if TYPES.get(t) != their_types[c]]
    if unlike:
        return f"types {unlike}"
    quoted = ", ".join(f'"{c}"' for c in columns)
    ours = canonical(got.select(*[f"`{c}`" for c in columns]).collect())
    theirs = canonical(expected.project(quoted).fetchall())
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        return f"{len(ours)} rows against {len(theirs)}; {pairs}"
    return ""


def main(arguments: list[str]) -> int:
    import __spark_entry__ as driver
    from tests.conftest import local_session

    folder = arguments[0] if arguments else DEFAULT_FOLDER
    names = arguments[1:] or list(driver.queries())
    spark, connection = local_session(), connect(folder)
    oracle, failed = driver.oracle_sql(), 0
    for name in names:
        began = time.monotonic()
        query = driver.queries()[name]
        if name in oracle:
            problem = compare(spark, connection, query, oracle[name], folder)
        else:
            problem = "" if query(spark, folder).count() else "no rows"
        failed += bool(problem)
        print(f"{name:32} {'FAILED ' + problem if problem else 'ok':8} {time.monotonic() - began:.1f} s")
    return failed


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))

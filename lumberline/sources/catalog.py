"""Catalog tables over stored logs, and named cached results."""

from __future__ import annotations

import uuid
from collections.abc import Iterable
from datetime import date

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import StructType

from lumberline.schema import CLEAN_SCHEMA, LOG_SCHEMA
from lumberline.sources.parsed import CSV_OPTIONS

# Properties of a cached result's view: its table, and the table before it.
_CACHED_RESULT, _BEFORE = "lumberline.cached_result", "lumberline.cached_before"
# How the names of these tables begin; they are not listed.
_VERSION = "lumberline_cached_"


def register_logs(
    spark: SparkSession,
    table: str,
    path: str,
    format: str = "json",
    partition_by: str | None = None,
    schema: StructType | None = None,
) -> None:
    """Makes stored logs a table ``database.name``; creates the database if need be.

    The schema is fixed, not inferred, so a folder without a single id still has the column. The
    table only points at ``path``: dropping it leaves the files alone.
    """
    if schema is None:
        schema = LOG_SCHEMA if partition_by is None else CLEAN_SCHEMA
    database = table.rpartition(".")[0]
    if database:
        spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    options = CSV_OPTIONS if format == "csv" else {}
    clauses = [f"USING {_identifier(format)}"]
    if options:
        pairs = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in options.items())
        clauses.append(f"OPTIONS ({pairs})")
    if partition_by is not None:
        clauses.append(f"PARTITIONED BY ({_identifier(partition_by)})")
    clauses.append(f"LOCATION {_literal(path)}")
    spark.sql(
        f"CREATE TABLE IDENTIFIER(:table) ({columns}) {' '.join(clauses)}", args={"table": table}
    )
    if partition_by is not None:
        spark.catalog.recoverPartitions(table)


def refresh_logs(
    spark: SparkSession, table: str, partitioned: bool = False, days: Iterable[str | date | None] | None = None
) -> None:
    """Takes in files and day folders added since :func:`register_logs`.

    With ``partitioned`` all folders are listed. ``days`` names the days that a write has made, so that only these
    are added, in one statement and without listing anything; None is the folder of rows without a day. A day
    that the table knows stays, and its new files are found when it is next read.
    """
    if days is not None:
        found = [f"PARTITION ({_identifier('day')} = {_day(day)})" for day in dict.fromkeys(days)]
        if found:
            spark.sql(f"ALTER TABLE IDENTIFIER(:table) ADD IF NOT EXISTS {' '.join(found)}", args={"table": table})
    elif partitioned:
        spark.catalog.recoverPartitions(table)
    spark.catalog.refreshTable(table)


def list_tables(spark: SparkSession, database: str) -> DataFrame:
    """Names of the tables of one database, in the catalog's order."""
    tables = spark.sql("SHOW TABLES IN IDENTIFIER(:db)", args={"db": database})
    shown = ~F.col("isTemporary") & ~F.col("tableName").startswith(_VERSION)
    return tables.filter(shown).select(F.col("tableName").alias("table_name"))


def cache_result(
    spark: SparkSession, name: str, result: DataFrame, properties: dict[str, str] | None = None
) -> DataFrame:
    """Keeps a result for reuse under ``name``, as a view of a table; an older result of that name is replaced.

    Meant for small, often asked results such as dashboard counts. The new table is written first and the view then
    points to it in one step, so there is a whole result of that name at all times. The table before it is kept until
    the next replacement, for those who still read it. A table or view that is no such result is not replaced.
    ``properties`` are kept with the result.
    """
    older = _cached_versions(spark, name)
    *database, _ = _name_parts(spark, name)
    made = ".".join(map(_identifier, [*database, f"{_VERSION}{uuid.uuid4().hex}"]))
    result.writeTo(made).using("parquet").create()
    kept = {**(properties or {}), _CACHED_RESULT: made, _BEFORE: older[0] if older else ""}
    listed = ", ".join(f"{_literal(k)} = {_literal(v)}" for k, v in kept.items())
    spark.sql(
        f"CREATE OR REPLACE VIEW IDENTIFIER(:name) TBLPROPERTIES ({listed}) AS SELECT * FROM {made}", args={"name": name})
    for table in older[1:]:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": table})
    return spark.table(name)


def drop_cached_result(spark: SparkSession, name: str) -> bool:
    """Removes a cached result and its files; False if there is none of that name."""
    tables = _cached_versions(spark, name)
    if tables:
        spark.sql("DROP VIEW IDENTIFIER(:name)", args={"name": name})
    for table in tables:
        spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:table)", args={"table": table})
    return bool(tables)


def result_property(spark: SparkSession, name: str, key: str) -> str | None:
    """A property kept with a cached result; None if it or the result is missing."""
    return _properties(spark, name).get(key)


def _properties(spark: SparkSession, name: str) -> dict[str, str]:
    """The properties of a cached result; none where nothing has the name."""
    if not spark.catalog.tableExists(name):
        return {}
    shown = spark.sql("SHOW TBLPROPERTIES IDENTIFIER(:name)", args={"name": name})
    found = {r["key"]: r["value"] for r in shown.collect()}
    if _CACHED_RESULT not in found:
        raise ValueError(f"{name} is a table or view, not a cached result")
    return found


def _cached_versions(spark: SparkSession, name: str) -> list[str]:
    """The tables behind a cached result, the newest first."""
    found = _properties(spark, name)
    return [t for t in (found.get(_CACHED_RESULT), found.get(_BEFORE)) if t]


def _name_parts(spark: SparkSession, name: str) -> list[str]:
    parts = spark._jsparkSession.sessionState().sqlParser().parseMultipartIdentifier(name)
    return [parts.apply(i) for i in range(parts.size())]


def _day(day: str | date | None) -> str:
    return "NULL" if day is None else f"DATE{_literal(date.fromisoformat(str(day)).isoformat())}"


def _identifier(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"

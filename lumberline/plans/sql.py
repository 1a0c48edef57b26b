"""Read-only SQL over catalog tables."""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.errors import ParseException
from pyspark.sql import DataFrame, SparkSession, functions as F

from lumberline.schema import PREVIEW_ROWS
from lumberline.sources.results import keep_result

# Double quotes around names are part of Spark's ANSI dialect.
_DOUBLE_QUOTED_NAMES = ("spark.sql.ansi.enabled", "spark.sql.ansi.doubleQuotedIdentifiers")
# Files named in a query instead of tables.
_FILES_AS_TABLES = "spark.sql.runSQLOnFiles"

# Statements that only report on the catalog; every statement of these kinds is read-only.
_CATALOG_REPORTS = ("Show", "Describe")

# Expressions and operators that leave SQL: they call a JVM method or start a program.
_OUTSIDE_SQL = {
    "CallMethodViaReflection": "reflect",
    "ScriptTransformation": "TRANSFORM ... USING",
}


class QueryRefused(ValueError):
    """The text is not a read-only query; nothing was run."""


def run_query(
    spark: SparkSession, sql: str | None, double_quoted_identifiers: bool = False, keep: str | None = None
) -> DataFrame | str | None:
    """The whole result of a read-only SQL text; ``None`` for an empty text.

    With ``keep`` the result is stored below that location and its id is returned instead;
    :func:`~lumberline.read_kept_result` gives it back with the types it had.

    The text must parse to its end as a query, which no statement that writes, changes settings or
    runs a script does; then it runs as it is. ``SHOW`` and ``DESCRIBE`` run too. A text that is no
    statement at all gives the engine's complaint. Only tables and views can be read, not files by
    their path. ``double_quoted_identifiers`` reads the text in the ANSI dialect, where
    ``"db"."table"`` are names and not texts. The settings of ``spark`` are never changed.
    """
    text = (sql or "").strip().rstrip("; \t\r\n")
    if not text:
        return None
    settings = {_FILES_AS_TABLES: "false"}
    if double_quoted_identifiers:
        settings |= dict.fromkeys(_DOUBLE_QUOTED_NAMES, "true")
    own = _own_session(spark, settings)
    if _statement(own, text).startswith(_CATALOG_REPORTS):
        result = own.sql(text)
        return result if keep is None else keep_result(spark, result, keep, text)
    if not _is_query(own, text):
        raise QueryRefused(f"not a read-only query: {text}")
    result = own.sql(text)
    for name in _class_names(result):
        if name in _OUTSIDE_SQL:
            raise QueryRefused(f"{_OUTSIDE_SQL[name]} is not allowed in a query: {text}")
    result = _in_session(spark, result)
    return result if keep is None else keep_result(spark, result, keep, text)


def preview_table(spark: SparkSession, table: str | None, n: int = PREVIEW_ROWS) -> DataFrame | None:
    """Any ``n`` rows of a table; ``None`` if no table is chosen."""
    return spark.table(table).limit(n) if table else None


def stringify_result(result: DataFrame) -> DataFrame:
    """Every cell as text, NULL as the empty text, column names kept."""
    # By position, because a query may give two columns the same name.
    numbered = result.toDF(*[str(i) for i in range(len(result.columns))])
    return numbered.select(
        *[
            F.coalesce(F.col(str(i)).cast("string"), F.lit("")).alias(name)
            for i, name in enumerate(result.columns)
        ]
    )


def _is_query(spark: SparkSession, text: str) -> bool:
    # This statement takes a query and nothing else.
    try:
        return _statement(spark, f"DESCRIBE QUERY\n{text}") == "DescribeQueryCommand"
    except ParseException:
        return False


# Spark has no public way to do the following. All of it works on the JVM objects of a classic (not a
# Connect) session.


def _own_session(spark: SparkSession, settings: dict[str, str]) -> SparkSession:
    """A copy of a session, temporary views and settings included, with further settings."""
    own = SparkSession(spark.sparkContext, spark._jsparkSession.cloneSession())
    for name, value in settings.items():
        own.conf.set(name, value)
    return own


def _in_session(spark: SparkSession, result: DataFrame) -> DataFrame:
    """A result of another session as one of ``spark``."""
    dataset = spark._jvm.org.apache.spark.sql.classic.Dataset
    return DataFrame(dataset.ofRows(spark._jsparkSession, result._jdf.queryExecution().analyzed()), spark)


def _statement(spark: SparkSession, text: str) -> str:
    """The kind of statement that a text parses as; nothing is looked up or run."""
    # The parser goes by the settings of the thread's active session.
    sessions = spark._jvm.org.apache.spark.sql.classic.SparkSession
    before = sessions.getActiveSession()
    sessions.setActiveSession(spark._jsparkSession)
    try:
        plan = spark._jsparkSession.sessionState().sqlParser().parsePlan(text)
    finally:
        if before.isDefined():
            sessions.setActiveSession(before.get())
        else:
            sessions.clearActiveSession()
    return plan.getClass().getSimpleName()


def _class_names(result: DataFrame) -> Iterator[str]:
    """Class names of all operators and expressions of the analysed plan, subqueries included.

    Texts inside the query are escaped in the plan's JSON form and can never pass for a class name.
    """
    pending = [json.loads(result._jdf.queryExecution().analyzed().toJSON())]
    while pending:
        node = pending.pop()
        if isinstance(node, dict):
            if isinstance(node.get("class"), str):
                yield node["class"].rpartition(".")[2]
            pending += node.values()
        elif isinstance(node, list):
            pending += node

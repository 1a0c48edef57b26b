"""Results of queries: kept with a manifest, and answers that know when they are stale."""

from __future__ import annotations

import hashlib
import json
import uuid
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import CalendarIntervalType, DataType, NullType, StringType, StructType

from lumberline.sources.catalog import cache_result, drop_cached_result, result_property

_MANIFEST = "id string, text string, schema string, kept_at timestamp"
# Types that Parquet has no form for; they are stored as their texts.
_AS_TEXT = (CalendarIntervalType, NullType)


def keep_result(spark: SparkSession, result: DataFrame, location: str, text: str = "", id: str | None = None) -> str:
    """Stores a whole result below ``location`` and returns its id.

    Beside the rows there is a manifest with the id, the query's text, the schema and the time; it is written when the
    rows are there, and without it there is no such result, so none is ever kept half. Rows are stored as Parquet by
    position, so columns may share a name.
    """
    id = id or uuid.uuid4().hex
    manifest = f"{_manifests(location)}/{id}"
    numbered = result.toDF(*[f"c{i}" for i in range(len(result.columns))])
    cells = [
        F.col(f"c{i}").cast("string").alias(f"c{i}") if isinstance(field.dataType, _AS_TEXT) else F.col(f"c{i}")
        for i, field in enumerate(result.schema.fields)
    ]
    numbered.select(*cells).write.mode("errorifexists").parquet(_rows(location, id))
    row = (id, text, result.schema.json(), datetime.now(timezone.utc))
    spark.createDataFrame([row], _MANIFEST).coalesce(1).write.json(manifest, compression="none")
    return id


def kept_results(spark: SparkSession, location: str) -> DataFrame:
    """``id, text, schema, kept_at`` of every result kept below ``location``; the schema as JSON."""
    manifests = spark._jvm.org.apache.hadoop.fs.Path(_manifests(location))
    if not manifests.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(manifests):
        return spark.createDataFrame([], _MANIFEST)
    return spark.read.schema(_MANIFEST).option("recursiveFileLookup", "true").json(_manifests(location), mode="FAILFAST")


def read_kept_result(spark: SparkSession, location: str, id: str) -> DataFrame:
    """A result of :func:`keep_result` with the column names and types it had."""
    found = kept_results(spark, location).filter(F.col("id") == id).select("schema").first()
    if found is None:
        raise KeyError(f"no result {id!r} is kept in {location}")
    schema = StructType.fromJson(json.loads(found["schema"]))
    stored = StructType()
    for i, field in enumerate(schema.fields):
        stored.add(f"c{i}", StringType() if isinstance(field.dataType, _AS_TEXT) else field.dataType)
    rows = spark.read.schema(stored).parquet(_rows(location, id))
    return rows.select(*[_typed(F.col(f"c{i}"), f.dataType).alias(f.name) for i, f in enumerate(schema.fields)])


def _typed(cell: Column, kind: DataType) -> Column:
    if isinstance(kind, NullType):
        return F.lit(None)
    return cell.cast("interval") if isinstance(kind, CalendarIntervalType) else cell


def _manifests(location: str) -> str:
    return f"{location.rstrip('/')}/manifests"


def _rows(location: str, id: str) -> str:
    return f"{location.rstrip('/')}/results/{id}"


# Answers

# Values that change without any file changing.
_BY_THE_CLOCK = ("Current", "LocalTimestamp", "Now", "UnixTimestamp", "InputFile", "MonotonicallyIncreasing")
# What a plan may read besides files: rows that are part of the plan.
_IN_THE_PLAN = ("LocalRelation", "OneRowRelation", "Range")
_FINGERPRINT = "lumberline.fingerprint"


def remembered(spark: SparkSession, result: DataFrame, database: str = "default") -> DataFrame:
    """``result`` from a table of ``database`` if the same query was asked before and its files are unchanged since.

    Else it is computed and stored for the next time, in place of the stale answer. Queries are told apart by the
    hash of their plans, in which names and order of conditions do not matter, and by plan text and schema. The state of the
    files is one number over their paths, lengths and times, computed by Spark from fresh listings of the folders
    that the query reads, whatever part of them it needs. What depends on more than files (time, chance, other sources) is returned as it is and not stored.
    """
    folders = _folders(spark, result)
    if folders is None:
        return result
    name = answer_name(result, database)
    state = _state(spark, folders)
    if result_property(spark, name, _FINGERPRINT) == state:
        return spark.table(name)
    for folder in folders:
        # A listing that the session holds may be older than the state.
        spark.catalog.refreshByPath(folder)
    spark.sql("CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db)", args={"db": database})
    return cache_result(spark, name, _again(spark, result), {_FINGERPRINT: state})


def forget_answer(spark: SparkSession, result: DataFrame, database: str = "default") -> bool:
    """Removes the stored answer to a query; False if there is none."""
    return drop_cached_result(spark, answer_name(result, database))


def answer_name(result: DataFrame, database: str = "default") -> str:
    """The name under which :func:`remembered` keeps an answer."""
    plan = result._jdf.queryExecution().analyzed().canonicalized().toString()
    told = hashlib.sha256(f"{plan}\n{result.schema.json()}".encode()).hexdigest()
    return f"{database}.answer_{result.semanticHash() & 0xFFFFFFFF:08x}_{told[:24]}"


def _again(spark: SparkSession, result: DataFrame) -> DataFrame:
    """The same query planned anew, so that it lists its files as they are now."""
    dataset = spark._jvm.org.apache.spark.sql.classic.Dataset
    return DataFrame(dataset.ofRows(spark._jsparkSession, result._jdf.queryExecution().logical()), spark)


def _folders(spark: SparkSession, result: DataFrame) -> list[str] | None:
    """The folders and files that a query reads; None if it depends on anything else."""
    plan = result._jdf.queryExecution().analyzed()
    if not plan.deterministic() or any(_names_a_clock(node) for node in json.loads(plan.toJSON())):
        return None
    found, leaves = set(), plan.collectLeaves()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        kind = leaf.getClass().getSimpleName()
        if kind in _IN_THE_PLAN:
            continue
        relation = leaf.relation() if kind == "LogicalRelation" else None
        if relation is None or relation.getClass().getSimpleName() != "HadoopFsRelation":
            return None
        roots = relation.location().rootPaths()
        found.update(roots.apply(k).toString() for k in range(roots.size()))
    return sorted(found) or None


def _names_a_clock(node) -> bool:
    if isinstance(node, dict):
        name = node.get("class")
        if isinstance(name, str) and name.rpartition(".")[2].startswith(_BY_THE_CLOCK):
            return True
        return any(_names_a_clock(v) for v in node.values())
    return isinstance(node, list) and any(_names_a_clock(v) for v in node)


def _state(spark: SparkSession, folders: list[str]) -> str:
    """One text for the present files: how many, their bytes, and a sum over them that no order changes."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    files = reader.load(folders).select("path", "modificationTime", "length")
    one = F.xxhash64("path", F.unix_micros("modificationTime"), "length")
    told = files.agg(F.count("*"), F.sum("length"), F.bit_xor(one), F.sum(F.pmod(one, F.lit(1_000_003)))).first()
    return ":".join(map(str, told))

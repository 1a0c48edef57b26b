"""Every registered query against its SQL on the smallest tables, all rows compared."""

from __future__ import annotations

from types import SimpleNamespace

import pytest

import __spark_entry__ as driver
from lumberline.oracle import ORACLE
from lumberline.scratch import scratch_path, shared_dir
from lumberline.workload import QUERIES
from tests.oracle_check import compare, connect

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(FOLDER) as opened:
        yield opened


def test_entry(spark):
    assert driver.entry(spark).count() > 0


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    query, sql = driver.queries()[name], driver.oracle_sql().get(name)
    if sql is None:
        assert query(spark, FOLDER).count() > 0
    else:
        assert compare(spark, connection, query, sql, FOLDER) == ""


NOT_AT_SCALE = (
    "CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow", "RDDScan",
    "ExistingRDD",
)


@pytest.mark.parametrize("name", [n for n in QUERIES if n != "list_tables"])
def test_plan_holds_at_scale(spark, name):
    plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in NOT_AT_SCALE if node in plan] and "In-memory table" not in plan
    # A window must be spread by a key.
    assert "Window" not in plan or "hashpartitioning(day" in plan or "hashpartitioning(key0" in plan
    if "SinglePartition" in plan:
        # One partial sum per task, or ten rows.
        assert name in ("share_by_id", "preview_table")
    assert "CollectLimit" not in plan and "LocalLimit" not in plan


# Spark moves the left side's count above semi and anti joins; the adaptive planner can split that side.
@pytest.mark.parametrize(
    "name, whole_sides", [("sql_semi_anti_join", 1), ("sql_set_operations", 0), ("sql_join", 0)]
)
def test_rows_are_aggregated_before_they_are_joined(spark, name, whole_sides):
    """Joins of big tables shuffle; what they shuffle is counted or made distinct in the tasks first."""
    setting = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        plan = driver.queries()[name](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set(setting, before)
    assert "Broadcast" not in plan
    nodes = [line.lstrip(" :+-") for line in plan.splitlines()]
    below = [after for node, after in zip(nodes, nodes[1:]) if node.startswith("Exchange")]
    assert below and sum("Aggregate" not in node and "Limit" not in node for node in below) == whole_sides


def test_a_preview_does_not_shuffle_its_table(spark):
    """The ten rows go to the scan of the table."""
    plan = driver.queries()["preview_table"](spark, FOLDER)._jdf.queryExecution().executedPlan().toString()
    nodes = [line.lstrip(" :+-") for line in plan.splitlines()]
    (scan,) = [i for i, node in enumerate(nodes) if "FileScan json" in node]
    above = nodes[:scan]
    met = max(i for i, node in enumerate(above) if node.startswith("BroadcastHashJoin"))
    assert "LeftSemi" in above[met] and not [n for n in above[met:] if n.startswith("Exchange")]


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


class Session:
    """The two things the shared folder is chosen by."""

    def __init__(self, master, settings):
        self.conf = settings
        self.sparkContext = SimpleNamespace(master=master, applicationId=master)


def test_shared_folder():
    setting = {"spark.checkpoint.dir": "hdfs://host/shared/"}
    path = scratch_path(Session("yarn", setting), "x")
    assert path.startswith("hdfs://host/shared/lumberline/x-")
    assert path != scratch_path(Session("yarn", setting), "x")
    for cluster in ("yarn", "local-cluster[2,1,1024]", "spark://host:7077"):
        with pytest.raises(RuntimeError):
            scratch_path(Session(cluster, {}), "x")
    for local in ("local", "local[*]"):
        assert shared_dir(Session(local, {"spark.sql.warehouse.dir": "file:/w"})) == "file:/w/_scratch"

"""Paths in the shared folder that every executor can reach."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.

    Only a local session may go without the setting: there the driver and the tasks are one
    process, and a folder beside the tables of its warehouse serves.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    master = spark.sparkContext.master
    if master != "local" and not master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/_scratch"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A path below :func:`shared_dir` that nothing has used yet."""
    return f"{shared_dir(spark).rstrip('/')}/lumberline/{label}-{uuid.uuid4().hex}"

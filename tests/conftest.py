from __future__ import annotations

import tempfile

import pytest
from pyspark.sql import SparkSession


def local_session() -> SparkSession:
    spark = (
        SparkSession.builder.master("local[8]")
        .appName("lumberline-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lumberline-warehouse-"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@pytest.fixture(scope="session")
def spark():
    session = local_session()
    yield session
    session.stop()


@pytest.fixture
def folder(tmp_path):
    """A path as text that nothing has written to yet."""
    return lambda name: str(tmp_path / name)

"""What the operators share: written intermediate tables, partition counts, caches of a worker."""

from __future__ import annotations

import ctypes
import sys
import types
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lumberline.scratch import scratch_path

#: Names of columns that the operators add for their own use.
OWN = "_llm_"

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
LARGEST_LONG = 2**63 - 1


class Stored:
    """A table written below the shared folder, which cuts the lineage of what follows."""

    def __init__(self, df: DataFrame, label: str, partition_by: tuple[str, ...] = ()):
        self.spark = df.sparkSession
        self.path = scratch_path(self.spark, label)
        schema = df.schema
        with _free_shuffles(self.spark):
            df.write.partitionBy(*partition_by).parquet(self.path)
        self.rows = self.spark.read.schema(schema).parquet(self.path)

    def discard(self) -> None:
        """Removes the files, once nothing lazy refers to them any more."""
        jvm = self.spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(self.path)
        path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def _free_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of a job run inside are removed when it ends; only its result is needed."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(CLEANUP)
        else:
            spark.conf.set(CLEANUP, before)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def worker_cache(name: str, make: Callable[[], Any]) -> Any:
    """What ``make`` returned first in this Python worker, kept from task to task."""
    module = "lumberline_worker_cache"
    kept = sys.modules.setdefault(module, types.ModuleType(module)).__dict__
    if name not in kept:
        kept[name] = make()
    return kept[name]


def give_back() -> None:
    """Memory that this Python worker no longer uses goes back to the system, since workers live on from stage to stage."""
    pa.default_memory_pool().release_unused()
    # Other C libraries than glibc have no such function.
    worker_cache("trim", lambda: getattr(ctypes.CDLL(None), "malloc_trim", lambda pad: 0))(0)


def of(table: DataFrame, **columns: str) -> DataFrame:
    """Only the named columns, under the operator's own names, so that others cannot clash."""
    return table.select(*[table[c].alias(OWN + name) for name, c in columns.items()])


def text_key(text: Column) -> Column:
    """Tells rows of one id apart by their text."""
    return F.xxhash64(F.coalesce(text, F.lit("")))


def crc_mod(doc_id: Column, by: int) -> Column:
    """crc32 of an id as text, modulo ``by``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % by

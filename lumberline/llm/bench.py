"""Seconds of each operator's query: ``python -m lumberline.llm.bench [query …]`` prints one JSON line.

``BENCH_SF_DIR`` and ``BENCH_CPUS`` are those of ``bench.py``. Results are written, as a user would.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

from pyspark.sql import SparkSession

from lumberline.llm.queries import QUERIES
from lumberline.scratch import scratch_path


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = (
        SparkSession.builder.master(f"local[{os.environ.get('BENCH_CPUS', '8')}]")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "6g").config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="lumberline-bench-")).getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names or list(QUERIES):
        began = time.monotonic()
        QUERIES[name](spark, folder).write.parquet(scratch_path(spark, f"bench-{name}"))
        seconds[name] = round(time.monotonic() - began, 2)
    print(json.dumps({"metric": "operators", "value": round(sum(seconds.values()), 2), "unit": "sec", "queries": seconds, "sf": folder}))


if __name__ == "__main__":
    main(sys.argv[1:])

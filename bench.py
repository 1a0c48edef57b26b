"""Times every registered query, and parsing throughput on raw text files.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (task slots), BENCH_REPEATS (timed runs per query, the
median counts), BENCH_LINES (lines of the throughput part; 0 leaves it out). Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

import lumberline as ll
from lumberline.scratch import scratch_path
from lumberline.workload import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = int(os.environ.get("BENCH_CPUS", "8"))
REPEATS = int(os.environ.get("BENCH_REPEATS", "2"))
LINES = int(os.environ.get("BENCH_LINES", "2000000"))

# Fixed value: the line grammar in Python's notation, whose classes are Unicode ones.
LINE_GRAMMAR = r"(\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}), (\w+): (.*?)(?:, \((\w+)\))?$"
GRAMMAR = re.compile(LINE_GRAMMAR)


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("lumberline-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.sql.shuffle.partitions", str(CPUS))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def consume(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def run_uncached(spark: SparkSession, query: Callable[[SparkSession, str], DataFrame]) -> None:
    """A query that caches its result must not answer those after it."""
    spark.catalog.clearCache()
    consume(query(spark, SF_DIR))


def seconds(work: Callable[[], None], repeats: int = REPEATS) -> float:
    """Median of the timed runs, after one run to warm up."""
    work()
    times = []
    for _ in range(max(1, repeats)):
        began = time.perf_counter()
        work()
        times.append(time.perf_counter() - began)
    return round(statistics.median(times), 4)


def row_at_a_time(lines: DataFrame) -> DataFrame:
    """The same parse with one Python call per line, for comparison."""

    @F.udf(ll.LOG_SCHEMA)
    def fields(line: str):
        match = GRAMMAR.match(line)
        return match.groups() if match else None

    parsed = lines.select(fields("value").alias("log")).filter("log IS NOT NULL")
    return parsed.select("log.*")


def throughput(spark: SparkSession) -> dict[str, float]:
    files = CPUS
    path = scratch_path(spark, "bench-raw")
    logs = ll.synthesize_logs(spark, files, LINES // files)
    ll.write_raw_logs(logs, path, clustered=True)
    raw = ll.read_raw_logs(spark, path, recursive=True)
    stored = scratch_path(spark, "bench-json")
    ll.raw_to_json(spark, path, stored, recursive=True)
    clean = scratch_path(spark, "bench-clean")
    ll.raw_to_clean(spark, path, clean, recursive=True)

    def to_json(parse):
        return lambda: ll.write_json_logs(parse(raw), scratch_path(spark, "bench-json"))

    json_logs, clean_logs = ll.read_parsed_logs(spark, stored), ll.read_clean_logs(spark, clean)
    times = {
        "lines": files * (LINES // files),
        "parse": seconds(lambda: consume(ll.parse_logs(raw))),
        "parse_row_at_a_time": seconds(lambda: consume(row_at_a_time(raw)), 1),
        "parse_to_json": seconds(to_json(ll.parse_logs)),
        "parse_to_json_row_at_a_time": seconds(to_json(row_at_a_time), 1),
        "errors_by_id_from_raw": seconds(
            lambda: consume(ll.count_by_id(ll.parse_logs(raw), "ERROR"))
        ),
        "errors_by_id_from_json": seconds(lambda: consume(ll.count_by_id(json_logs, "ERROR"))),
        "errors_by_id_from_parquet": seconds(lambda: consume(ll.count_by_id(clean_logs, "ERROR"))),
        "both_pies_from_json": seconds(lambda: consume(ll.counts_by_level_and_id(json_logs))),
        "hourly_series_from_parquet": seconds(lambda: consume(ll.level_timeseries(clean_logs))),
    }
    times["parse_lines_per_second"] = round(times["lines"] / times["parse"])
    times["parse_speedup"] = round(times["parse_row_at_a_time"] / times["parse"], 2)
    times["parse_to_json_speedup"] = round(
        times["parse_to_json_row_at_a_time"] / times["parse_to_json"], 2
    )
    return times


def main() -> None:
    spark = session()
    times = {}
    for name, query in QUERIES.items():
        times[name] = seconds(lambda: run_uncached(spark, query))
        print(f"{name:32} {times[name]:.3f} s", file=sys.stderr)
    report = {
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": Path(SF_DIR).name.removeprefix("sf"),
        "cpus": CPUS,
    }
    if LINES:
        report["throughput"] = throughput(spark)
    print(json.dumps(report))
    spark.stop()


if __name__ == "__main__":
    main()

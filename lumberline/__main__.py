"""The jobs on the command line, for ``spark-submit`` or ``python -m lumberline``."""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession

import lumberline as ll
from lumberline import schema
from lumberline.streaming.apart import KINDS


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="lumberline", description=__doc__)
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, help: str, *positional: str) -> argparse.ArgumentParser:
        added = commands.add_parser(name, help=help)
        for argument in positional:
            added.add_argument(argument)
        return added

    for name, help in (
        ("parse", "raw text to JSON lines"),
        ("clean", "raw text to Parquet or CSV by day"),
        ("stream", "raw text files or Kafka messages to JSON lines as they arrive"),
        ("stream-counts", "counts by bucket and level; rows that are late, ahead or without a time apart"),
    ):
        job = command(name, help, "raw", "out")
        job.add_argument("--recursive", action="store_true", help="read subfolders too")
        if not name.startswith("stream"):
            modes = "errorifexists, append, overwrite (removes all that is there)"
            modes += ", replace (the days that RAW holds; others stay)" if name == "clean" else ""
            job.add_argument("--mode", default="errorifexists", help=modes)
        if name == "clean":
            job.add_argument("--format", default="parquet", choices=("parquet", "csv"))
            job.add_argument("--without-level", action="append", default=[], metavar="LEVEL")
        if name.startswith("stream"):
            job.add_argument("--checkpoint", required=True)
            job.add_argument("--once", action="store_true", help="stop when all present files are read")
            job.add_argument("--kafka", action="store_true", help="RAW is a topic; servers go in --option")
            job.add_argument(
                "--option", action="append", default=[], metavar="NAME=VALUE",
                help="of the source, such as maxFilesPerTrigger=1000 or kafka.bootstrap.servers=...",
            )
        if name == "stream-counts":
            job.add_argument("--bucket", default="1 hour")
            job.add_argument("--delay", default="1 hour")

    register = command("register", "make stored logs a catalog table", "table", "path")
    register.add_argument("--format", default="json", choices=("json", "parquet", "csv"))
    register.add_argument("--partition-by", default=None)

    days = command("add-days", "add days that were written to a table by day", "table")
    days.add_argument("day", nargs="+", help="as 2024-01-31, or none for rows without a day")
    apart = command("mend", "JSON lines to whole rows and broken lines, apart", "json", "out")
    apart.add_argument("--mode", default="errorifexists", help="errorifexists, append, overwrite")
    read = command("stream-result", "what stream-counts has found", "out")
    read.add_argument("--checkpoint", required=True)
    read.add_argument("--kind", default="counted", choices=KINDS)
    command("results", "list the results kept at a location", "location")
    command("result", "print a kept result", "location", "id")

    command("tables", "list the tables of a database", "database")
    command("preview", "some rows of a table", "table")
    command("counts", "errors and warnings by id", "table")
    query = command("query", "run read-only SQL", "sql")
    query.add_argument("--store", metavar="LOCATION", help="keep the whole result there as CSV")
    query.add_argument("--keep", metavar="LOCATION", help="keep it there with its types, and print its id")
    query.add_argument("--double-quoted-names", action="store_true")
    query.add_argument("--show", type=int, metavar="N", help="print N rows only")

    synth = command("synth", "write a synthetic set of raw logs", "out")
    synth.add_argument("--files", type=int, default=schema.DEFAULT_FILES)
    synth.add_argument("--lines-per-file", type=int, default=schema.DEFAULT_LINES_PER_FILE)
    synth.add_argument("--error-pct", type=int, default=schema.DEFAULT_ERROR_PCT)
    synth.add_argument("--warning-pct", type=int, default=schema.DEFAULT_WARNING_PCT)
    return parser


def show(result: DataFrame | None, rows: int | None = None) -> None:
    """Prints the whole result, a row per line; the driver holds one partition at a time."""
    if result is None:
        return
    texts = ll.stringify_result(result if rows is None else result.limit(rows))
    print("\t".join(texts.columns))
    for row in texts.toLocalIterator():
        print("\t".join(row))


def _lines(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = dict(pair.split("=", 1) for pair in args.option)
    if args.kafka:
        return ll.stream_raw_logs(spark, kafka={"subscribe": args.raw, **options})
    return ll.stream_raw_logs(spark, args.raw, recursive=args.recursive, **options)


def main(argv: list[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"lumberline {args.command}").getOrCreate()
    match args.command:
        case "parse":
            ll.raw_to_json(spark, args.raw, args.out, args.recursive, args.mode)
        case "clean":
            ll.raw_to_clean(
                spark, args.raw, args.out, args.format, args.without_level, args.recursive, args.mode
            )
        case "stream":
            trigger = {"availableNow": True} if args.once else None
            ll.stream_parse_to_json(_lines(spark, args), args.out, args.checkpoint, trigger).awaitTermination()
        case "stream-counts":
            trigger = {"availableNow": True} if args.once else None
            ll.stream_counts_apart(
                _lines(spark, args), args.out, args.checkpoint, args.bucket, args.delay, trigger=trigger
            ).awaitTermination()
        case "stream-result":
            if args.kind == "counted":
                show(ll.read_stream_counts(spark, args.out, args.checkpoint))
            else:
                show(ll.read_stream_rows(spark, args.out, args.checkpoint, args.kind))
        case "mend":
            ll.write_apart(ll.read_with_torn_lines(spark, args.json), args.out, args.mode)
        case "add-days":
            ll.refresh_logs(spark, args.table, days=[None if d == "none" else d for d in args.day])
        case "results":
            show(ll.kept_results(spark, args.location))
        case "result":
            show(ll.read_kept_result(spark, args.location, args.id))
        case "register":
            ll.register_logs(spark, args.table, args.path, args.format, args.partition_by)
        case "tables":
            show(ll.list_tables(spark, args.database))
        case "preview":
            show(ll.preview_table(spark, args.table))
        case "counts":
            show(ll.dashboard_counts(spark, args.table))
        case "query":
            result = ll.run_query(spark, args.sql, args.double_quoted_names, keep=args.keep)
            if isinstance(result, str):
                print(result)
            elif result is not None and args.store:
                print(ll.store_result(result, args.store))
            else:
                show(result, args.show)
        case "synth":
            logs = ll.synthesize_logs(
                spark, args.files, args.lines_per_file, args.error_pct, args.warning_pct
            )
            ll.write_raw_logs(logs, args.out, clustered=True)


if __name__ == "__main__":
    main()

"""Run a hop: ``spark-submit -m tidemark clean|analytic …`` or ``python -m tidemark …``."""

from __future__ import annotations

import argparse
from contextlib import ExitStack

from pyspark.sql import SparkSession

from tidemark.plans.feeds import DATE_PARTITION, FEEDS, needed_schema, raw_schema
from tidemark.plans.jobs import layer_path, run_clean_to_analytic, run_raw_to_clean
from tidemark.plans.pipelines import History
from tidemark.session import configure
from tidemark.sources.documents import landed
from tidemark.sources.layers import Layer, Table
from tidemark.sources.readers import read_raw, read_table
from tidemark.sources.writers import require_apart


def _history(spark: SparkSession, entries: list[str]) -> dict[str, History]:
    """``feed=table`` or ``feed=/path`` by feed. A view, or a table without dates, is a frame."""
    places = {}
    for entry in entries:
        feed, _, place = entry.partition("=")
        if feed not in FEEDS or not place:
            raise SystemExit(f"--history takes FEED=TABLE or FEED=PATH, not {entry!r}")
        if "/" in place:
            places[feed] = Layer(spark, place, DATE_PARTITION)
        else:
            database, _, name = place.rpartition(".")
            table = Table(spark, name, DATE_PARTITION, database or None)
            places[feed] = table if table.dated() else read_table(spark, name, database or None)
    return places


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tidemark")
    hops = parser.add_subparsers(dest="hop", required=True)
    clean = hops.add_parser("clean", help="raw JSON to the clean layer")
    clean.add_argument("--raw", required=True, help="directory of JSON-lines files")
    how = clean.add_mutually_exclusive_group()
    how.add_argument("--infer", action="store_true",
                     help="infer the schema of the raw files, which loses no field (default)")
    how.add_argument("--declared", action="store_true",
                     help="read the documented fields only, for one pass over the files less")
    how.add_argument("--schema", metavar="FILE",
                     help="parse once, keep every field, and add those that are new to this file")
    clean.add_argument("--variant", action="append", default=[], metavar="LEAF",
                       help="leaf that arrives as struct<int, double>")
    clean.add_argument("--key", action="append", default=[], metavar="COLUMN",
                       help="measure the documents of each value by its own history, e.g. lat, lon")
    clean.add_argument("--cast", choices=["cast", "try_cast"], default="try_cast",
                       help="whether values that do not fit fail or become NULL")
    clean.add_argument("--outer", action="store_true",
                       help="keep a row for documents without elements")
    analytic = hops.add_parser("analytic", help="clean layer to the analytic layer")
    analytic.add_argument("--clean", required=True, help="root of the clean layer")
    analytic.add_argument("--lookback", type=int, default=0, help="seconds to read again")
    analytic.add_argument("--by", choices=["mark", "changes"], default="mark",
                          help="take rows beyond the mark, or those of the clean layer's log")
    for hop in (clean, analytic):
        hop.add_argument("--dedupe", action="store_true", help="drop exact copies of rows")
        hop.add_argument("--log", type=int, default=0, metavar="RUNS",
                         help="runs whose rows are kept in the layer's log of changes")
        hop.add_argument("--out", required=True, help="root of the layer to write")
        hop.add_argument("--feed", action="append", choices=list(FEEDS))
        hop.add_argument("--history", action="append", default=[], metavar="FEED=PLACE",
                         help="table or directory whose newest row is the high-water mark")
        hop.add_argument("--compact", action="store_true",
                         help="bring the rows of each date together before writing")
        hop.add_argument("--overwrite", choices=["all", "touched"], default="all")
    return parser


def main(arguments: list[str] | None = None) -> None:
    """Parse the arguments, run the hop and print what it did for each feed."""
    args = _parser().parse_args(arguments)
    spark = configure(SparkSession.builder.appName(f"tidemark-{args.hop}").getOrCreate())
    feeds = [FEEDS[name] for name in args.feed or FEEDS]
    history = _history(spark, args.history)
    if args.hop == "clean":
        for spec in feeds:
            require_apart(args.raw, layer_path(args.out, spec))
        declared = args.declared or (args.variant and not args.infer and not args.schema)
        schema = needed_schema(feeds, raw_schema(args.variant)) if declared else None
        with ExitStack() as staged:
            if args.schema:
                lines = spark.read.text(args.raw)
                raw = staged.enter_context(landed(lines, raw_schema(args.variant), args.schema)).documents
            else:
                raw = read_raw(spark, args.raw, schema)
            results = run_raw_to_clean(
                raw, args.out, feeds, history, args.overwrite, args.compact, None, args.key,
                args.dedupe, args.cast, args.outer, args.log
            )
    else:
        results = run_clean_to_analytic(
            spark, args.clean, args.out, feeds, history, args.overwrite, args.lookback,
            args.compact or None, args.dedupe, args.by, args.log
        )
    for result in results:
        print(f"{result.feed}: newer than {result.mark}: "
              f"{'written' if result.written else 'nothing new'}")


if __name__ == "__main__":
    main()

"""Command line: ``python -m stratalake`` or spark-submit of this file."""

from __future__ import annotations

import argparse
import logging
from datetime import date, datetime

from pyspark.sql import SparkSession

from stratalake.plans import arrivals, bronze, count_words, full_run, gold, gold_delta, silver, silver_delta
from stratalake.plans.sizes import size_for
from stratalake.session import get_spark
from stratalake.sources.landing import FORMATS
from stratalake.sources.sinks import Target, bigquery_target
from stratalake.streaming.incremental import ingest_new_files
from stratalake.tables import TABLES

logger = logging.getLogger("stratalake")


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="stratalake", description=__doc__)
    parser.add_argument("--data-gb", type=float, help="input volume, to size shuffles (default: what lies in the input paths)")
    commands = parser.add_subparsers(dest="command", required=True)

    def command(name: str, text: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name, help=text)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    def landing_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--format", choices=FORMATS, default="csv")
        sub.add_argument("--ingested-at", type=datetime.fromisoformat)

    def gold_options(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--as-of", type=date.fromisoformat)
        sub.add_argument("--bigquery", metavar="PROJECT.DATASET")
        sub.add_argument("--staging-bucket")

    def ingest_options(sub: argparse.ArgumentParser, lineage: str) -> None:
        sub.add_argument("--table", choices=list(TABLES), required=True)
        sub.add_argument("--dead-letter")
        sub.add_argument("--strict", action="store_true")
        sub.add_argument("--lineage", choices=["landing", "file"], default=lineage)
        sub.add_argument("--check-header", action="store_true")
        sub.add_argument("--multi-line", action="store_true")
        landing_options(sub)

    sub = command("bronze", "ingest landing files of one table", "landing", "bronze")
    ingest_options(sub, "landing")
    sub.add_argument("--by-header", action="store_true")

    sub = command("bronze-arrivals", "ingest files that are not in the file table", "landing", "bronze")
    ingest_options(sub, "file")
    sub.add_argument("--by-header", action="store_true")
    sub.add_argument("--files-per-step", type=int, default=arrivals.FILES_PER_STEP)

    sub = command("silver", "clean and deduplicate one table", "bronze", "silver")
    sub.add_argument("--table", choices=list(TABLES), required=True)
    sub.add_argument("--earlier", help="previous Silver version to bring up to date")
    sub.add_argument("--since", type=date.fromisoformat, help="first batch it lacks")

    sub = command("silver-delta", "bring one versioned table up to date with Bronze", "bronze", "silver")
    sub.add_argument("--table", choices=list(TABLES), required=True)
    sub.add_argument("--rebuild", action="store_true")

    sub = command("bronze-new", "ingest files not read before, as a stream", "landing", "bronze", "progress")
    ingest_options(sub, "file")
    sub.add_argument("--files-per-step", type=int)

    sub = command("gold", "build aggregates", "silver", "gold")
    sub.add_argument("--job", choices=["all", *gold.JOBS], required=True)
    gold_options(sub)

    sub = command("gold-delta", "bring versioned aggregates up to date with Silver", "silver", "gold")
    sub.add_argument("--job", choices=["all", *gold.JOBS], required=True)
    sub.add_argument("--rebuild", action="store_true")
    gold_options(sub)

    sub = command("run", "all layers below one root", "root")
    sub.add_argument("--dead-letters", action="store_true")
    how = sub.add_mutually_exclusive_group()
    how.add_argument("--incremental", action="store_true", help="only what is new")
    how.add_argument("--at-once", action="store_true", help="publish whole versions")
    landing_options(sub)
    gold_options(sub)

    command("wordcount", "count words of text files", "texts", "output")
    command("merge-counts", "merge word count files", "partials", "output")
    return parser


def _targets(args: argparse.Namespace):
    if not args.bigquery:
        return None

    def targets(table: str) -> list[Target]:
        return [bigquery_target(f"{args.bigquery}.{table}", args.staging_bucket)]

    return targets


def _ingest_options(args: argparse.Namespace) -> dict:
    options = {"multi_line": args.multi_line}
    for name in ("check_header", "by_header"):
        if getattr(args, name, False):
            if args.format != "csv":
                raise SystemExit(f"--{name.replace('_', '-')} applies to csv only")
            options[name] = True
    return {
        "file_format": args.format,
        "dead_letter": args.dead_letter,
        "strict": args.strict,
        "lineage": args.lineage,
        "ingested_at": args.ingested_at,
        **options,
    }


def _inputs(args: argparse.Namespace) -> list[str]:
    """Paths that a command reads."""
    if args.command == "run":
        return [f"{args.root}/landing"]
    first = {"gold": "silver", "gold-delta": "silver", "wordcount": "texts", "merge-counts": "partials"}
    first |= {"silver": "bronze", "silver-delta": "bronze"}
    paths = [getattr(args, first.get(args.command, "landing")), getattr(args, "earlier", None)]
    return [path for path in paths if path]


def _execute(spark: SparkSession, args: argparse.Namespace) -> object:
    if args.command == "bronze":
        return bronze.ingest(spark, args.table, args.landing, args.bronze, **_ingest_options(args))
    if args.command == "bronze-arrivals":
        return arrivals.ingest_arrivals(
            spark, args.table, args.landing, args.bronze, files_per_step=args.files_per_step, **_ingest_options(args)
        )
    if args.command == "silver-delta":
        job = silver_delta.rebuild if args.rebuild else silver_delta.refresh
        return job(spark, args.table, args.bronze, args.silver)
    if args.command == "gold-delta":
        return {
            job: gold_delta.update(
                spark, args.silver, args.gold, job, as_of=args.as_of, targets=_targets(args), rebuild=args.rebuild
            )
            for job in (gold.JOBS if args.job == "all" else [args.job])
        }
    if args.command == "silver":
        return silver.refine(
            spark, args.table, args.bronze, args.silver, earlier=args.earlier, since=args.since
        )
    if args.command == "bronze-new":
        return ingest_new_files(
            spark,
            args.table,
            args.landing,
            args.bronze,
            args.progress,
            files_per_step=args.files_per_step,
            **_ingest_options(args),
        )
    if args.command == "gold":
        return gold.build(
            spark, args.silver, args.gold, args.job, as_of=args.as_of, targets=_targets(args)
        )
    if args.command == "run":
        return full_run.run(
            spark,
            full_run.Lake(args.root),
            file_format=args.format,
            dead_letters=args.dead_letters,
            ingested_at=args.ingested_at,
            as_of=args.as_of,
            targets=_targets(args),
            incremental=args.incremental,
            at_once=args.at_once,
        )
    if args.command == "wordcount":
        return count_words.count_words(spark, args.texts, args.output)
    return count_words.merge_word_counts(spark, args.partials, args.output)


def main(argv: list[str] | None = None) -> object:
    logging.basicConfig(level=logging.INFO)
    args = _parser().parse_args(argv)
    running = SparkSession.getActiveSession()
    spark = running or get_spark(f"stratalake_{args.command}", data_gb=args.data_gb)
    try:
        if running is None and args.data_gb is None:
            logger.info("%.3f GB of input", size_for(spark, *_inputs(args)))
        result = _execute(spark, args)
        logger.info("%s complete: %s", args.command, result)
        return result
    finally:
        if running is None:
            spark.stop()


if __name__ == "__main__":
    main()

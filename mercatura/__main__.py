"""Run the whole job from the command line or through spark-submit."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from mercatura.plans import job


def session() -> SparkSession:
    """The session spark-submit configured, or a new one with the defaults of the machine."""
    return SparkSession.builder.appName("mercatura").getOrCreate()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="mercatura", description=job.__doc__)
    parser.add_argument("data", help="folder with the CSV files")
    parser.add_argument("out", help="folder for tables, profiles, reports and plot data")
    parser.add_argument(
        "--file",
        action="append",
        default=[],
        metavar="TABLE=NAME",
        help="file name of a table, where it is not the usual one",
    )
    parser.add_argument("--delivered", default="delivered", help="status of a delivered order")
    parser.add_argument("--on-missing", choices=("error", "skip"), default="error")
    parser.add_argument("--no-clean", action="store_true", help="leave text NULLs as they are")
    parser.add_argument("--buckets", type=int, help="store the tables bucketed on order_id")
    parser.add_argument("--database", help="database of the bucketed tables")
    parser.add_argument(
        "--multi-line",
        action="append",
        default=[],
        metavar="TABLE",
        choices=list(job.DATA_FILES),
        help="table whose text holds line breaks; each of its files is then one task",
    )
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(argv)
    files = dict(job.DATA_FILES)
    for pair in args.file:
        table, found, name = pair.partition("=")
        if not found or table not in files:
            parser.error(f"--file takes TABLE=NAME with one of: {', '.join(files)}")
        files[table] = name
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    reports = job.run(
        session(),
        job.data_paths(args.data, files),
        args.out,
        delivered=args.delivered,
        on_missing=args.on_missing,
        clean=not args.no_clean,
        buckets=args.buckets,
        database=args.database,
        multi_line=args.multi_line,
    )
    job.show_summaries(reports)


if __name__ == "__main__":
    main()

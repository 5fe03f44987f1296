"""The refresh jobs as programs: ``python -m daybook.plans.cli <job> --db … --today …``.

Each job opens a session, runs one refresh, prints a line per load and ends with status 1
if a load failed, so a scheduler sees it.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys
from collections.abc import Callable

from pyspark.sql import SparkSession

from daybook.plans import attendance
from daybook.plans.jobs import LoadResult
from daybook.session import run_job


def base(spark: SparkSession, args: argparse.Namespace) -> list[LoadResult]:
    """Departments, shifts, people, cards and attendance out of landed pages."""
    return attendance.refresh_base_tables(spark, args.db, args.landing, args.today)


def cards(spark: SparkSession, args: argparse.Namespace) -> list[LoadResult]:
    """Today's card records, every half hour."""
    return [attendance.refresh_current_cards(spark, args.db, args.landing, args.today)]


def wide(spark: SparkSession, args: argparse.Namespace) -> list[LoadResult]:
    """The last days of the wide table, ending yesterday."""
    return [attendance.refresh_wide_table(spark, args.db, args.today, args.days)]


def backfill(spark: SparkSession, args: argparse.Namespace) -> list[LoadResult]:
    """A range of days of the wide table."""
    return [attendance.backfill_wide_table(spark, args.db, args.low, args.high)]


JOBS: dict[str, Callable[[SparkSession, argparse.Namespace], list[LoadResult]]] = {
    "base": base, "cards": cards, "wide": wide, "backfill": backfill,
}


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="python -m daybook.plans.cli", description=__doc__)
    jobs = top.add_subparsers(dest="job", required=True)
    for name, job in JOBS.items():
        one = jobs.add_parser(name, help=job.__doc__)
        one.add_argument("--db", required=True)
        one.add_argument("--buckets", type=int, help="buckets of a person, for large tables that are created")
        if name in ("base", "cards"):
            one.add_argument("--landing", required=True)
        if name == "backfill":
            one.add_argument("--low", type=dt.date.fromisoformat, required=True)
            one.add_argument("--high", type=dt.date.fromisoformat, required=True)
        else:
            one.add_argument("--today", type=dt.date.fromisoformat, required=True)
        if name == "wide":
            one.add_argument("--days", type=int, default=attendance.WIDE_DAYS)
    return top


def run(spark: SparkSession, args: argparse.Namespace) -> int:
    """Bring the tables into order, create those that are missing, run the job; its exit status."""
    for table, entries in attendance.recover_tables(spark, args.db).items():
        print(table, "recovered:", ", ".join(entries.values()))
    attendance.create_tables(spark, args.db, args.buckets)
    results = JOBS[args.job](spark, args)
    for r in results:
        print(r.table, "failed: " + r.info if r.failed else r.info)
    return int(any(r.failed for r in results))


def main(arguments: list[str] | None = None) -> int:
    args = parser().parse_args(arguments)
    return run_job(f"daybook-{args.job}", lambda spark: run(spark, args))


if __name__ == "__main__":
    sys.exit(main())

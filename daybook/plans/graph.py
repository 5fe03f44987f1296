"""Loads that depend on each other: base tables first, retries, and an end for what cannot run.

The driver threads only submit Spark jobs. Every load runs under a job tag of its own, so a
load that takes too long, or that is cancelled, has its Spark jobs interrupted and nothing
else is.
"""

from __future__ import annotations

import datetime as dt
import time
import uuid
from collections.abc import Callable
from concurrent.futures import FIRST_COMPLETED, Future, ThreadPoolExecutor, wait
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import SparkSession

from daybook.plans.jobs import CLOCK, FAILED, SUCCEEDED, LoadResult, record, run_load

#: Audit state of a load that was not run, as a table it needs was not loaded.
SKIPPED = "2"


@dataclass(frozen=True)
class Load:
    """How a table is loaded: the writer, the tables it needs, and what may go wrong.

    ``retries`` is how often the writer is run again after a failure, each time after twice
    the ``pause`` (seconds); it has to be safe to run again, as replacements are. ``limit`` is
    how many seconds one run may take.
    """

    writer: Callable[[], object]
    after: list[str] = field(default_factory=list)
    retries: int = 0
    pause: float = 0.0
    limit: float | None = None


def order(loads: dict[str, Load]) -> list[str]:
    """Table names so that each comes behind those it needs; by name where that leaves a choice."""
    unknown = sorted({t for load in loads.values() for t in load.after} - set(loads))
    if unknown:
        raise ValueError(f"needed, but not among the loads: {unknown}")
    done: list[str] = []
    left = dict(sorted(loads.items()))
    while left:
        ready = [name for name, load in left.items() if set(load.after) <= set(done)]
        if not ready:
            raise ValueError(f"these loads need each other: {sorted(left)}")
        done += ready
        for name in ready:
            del left[name]
    return done


def dependants(loads: dict[str, Load], table: str) -> set[str]:
    """All tables that need a table, directly or through others."""
    found: set[str] = set()
    new = {table}
    while new:
        new = {n for n, load in loads.items() if new & set(load.after)} - found
        found |= new
    return found


class Run:
    """One run of a set of loads. :meth:`cancel` may be called from another thread."""

    def __init__(self, spark: SparkSession, loads: dict[str, Load], at_once: int = 4):
        self.spark, self.loads, self.at_once = spark, loads, at_once
        self.sequence = order(loads)
        self.name = uuid.uuid4().hex[:12]
        self.results: dict[str, LoadResult] = {}
        self.attempts: dict[str, int] = {}
        self._cancelled: dict[str, str] = {}

    def tag(self, table: str) -> str:
        # A tag may hold no comma.
        return f"load-{self.name}-{table.replace(',', '_')}"

    def cancel(self, table: str, reason: str = "cancelled") -> None:
        """Interrupt a load's Spark jobs, or keep it from starting; its dependants are skipped."""
        if table not in self.results:
            self._cancelled.setdefault(table, reason)
            self.spark.sparkContext.cancelJobsWithTag(self.tag(table))

    def execute(self) -> list[LoadResult]:
        """Run all loads and return a report in the order of :func:`order`, failures included."""
        waiting, running = list(self.sequence), {}
        with ThreadPoolExecutor(max_workers=self.at_once) as threads:
            while waiting or running:
                for table in self._ready(waiting):
                    waiting.remove(table)
                    if reason := self._why_not(table):
                        self._skip(table, reason)
                    else:
                        target = inheritable_thread_target(self.spark)(self._load)
                        running[threads.submit(target, table)] = table
                if running:
                    for done in wait(running, timeout=0.2, return_when=FIRST_COMPLETED).done:
                        self._finish(running.pop(done), done)
        return [self.results[table] for table in self.sequence]

    def _ready(self, waiting: list[str]) -> list[str]:
        """Loads of which everything they need has ended; also those that cannot run any more."""
        ended = set(self.results)
        return [t for t in waiting if set(self.loads[t].after) <= ended or self._why_not(t)]

    def _why_not(self, table: str) -> str | None:
        if table in self._cancelled:
            return self._cancelled[table]
        lost = [t for t in self.loads[table].after if t in self.results and self.results[t].status != SUCCEEDED]
        return f"needs {', '.join(sorted(lost))}" if lost else None

    def _skip(self, table: str, reason: str) -> None:
        self.results[table] = LoadResult(table, dt.datetime.now().strftime(CLOCK), SKIPPED, reason, None)

    def _finish(self, table: str, done: Future) -> None:
        result = done.result()
        if table in self._cancelled and result.failed:
            result = LoadResult(table, result.start_time, FAILED, self._cancelled[table], None, result.error)
        self.results[table] = result

    def _load(self, table: str) -> LoadResult:
        """Run in a thread of its own: all attempts of one load."""
        load = self.loads[table]
        pause = load.pause
        for attempt in range(load.retries + 1):
            self.attempts[table] = attempt + 1
            result = self._attempt(table, load)
            if not result.failed or table in self._cancelled or attempt == load.retries:
                break
            time.sleep(pause)
            pause *= 2
        return result

    def _attempt(self, table: str, load: Load) -> LoadResult:
        """One run of the writer; beyond its limit its Spark jobs are interrupted until it ends."""
        if load.limit is None:
            return self._tagged(table, load)
        with ThreadPoolExecutor(max_workers=1) as thread:
            running = thread.submit(inheritable_thread_target(self.spark)(self._tagged), table, load)
            ended = wait([running], timeout=load.limit).done
            late = not ended
            while not ended:
                self.spark.sparkContext.cancelJobsWithTag(self.tag(table))
                ended = wait([running], timeout=0.5).done
            result = running.result()
        if late and result.failed:
            return LoadResult(table, result.start_time, FAILED, f"took more than {load.limit} s", None, result.error)
        return result

    def _tagged(self, table: str, load: Load) -> LoadResult:
        """The writer under its tag; tag and pool belong to the thread that submits the jobs."""
        self.spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        self.spark.sparkContext.addJobTag(self.tag(table))
        try:
            return run_load(table, load.writer)
        finally:
            self.spark.sparkContext.removeJobTag(self.tag(table))


def load_dependent(
    spark: SparkSession, audit_table: str, loads: dict[str, Load], at_once: int = 4
) -> list[LoadResult]:
    """Run loads in the order of their needs, several at once, and write one audit row for each.

    A load begins as soon as the tables it needs are there. If one of them failed, the load
    and everything behind it is skipped, and the rest goes on. Nothing is raised but for loads
    that need each other or an unknown table.
    """
    results = Run(spark, loads, at_once).execute()
    if results:
        record(spark, audit_table, results)
    return results

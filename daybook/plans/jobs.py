"""Audited loads, one table or many at a time."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from threading import Lock

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from daybook.operators import incremental, shape
from daybook.plans.config import ImportConfig, TableTask
from daybook.schemas import LOAD_AUDIT
from daybook.sources import jdbc

# Audit states and the message of a load that went well.
SUCCEEDED, FAILED = "1", "0"
SUCCESS_INFO = "update success"
CLOCK = "%Y-%m-%d %H:%M:%S"

_audit_lock = Lock()


@dataclass(frozen=True)
class LoadResult:
    table: str
    start_time: str
    status: str
    info: str
    end_time: str | None
    error: Exception | None = None

    @property
    def failed(self) -> bool:
        return self.status == FAILED

    def row(self) -> tuple:
        return (self.table, self.start_time, self.status, self.info, self.end_time)


def run_load(table: str, writer: Callable[[], object]) -> LoadResult:
    """Run a writer and report how it went; a failure is reported, not raised."""
    start = dt.datetime.now().strftime(CLOCK)
    try:
        writer()
    except Exception as error:  # noqa: BLE001  (the report carries it)
        return LoadResult(table, start, FAILED, str(error), None, error)
    return LoadResult(table, start, SUCCEEDED, SUCCESS_INFO, dt.datetime.now().strftime(CLOCK))


def create_audit_table(spark: SparkSession, audit_table: str) -> None:
    columns = ", ".join(f"{c} string" for c in LOAD_AUDIT.names)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {audit_table} ({columns}) USING parquet")


def record(spark: SparkSession, audit_table: str, results: list[LoadResult]) -> None:
    """Append one audit row per load in one write; one writer at a time."""
    with _audit_lock:
        rows = spark.createDataFrame([r.row() for r in results], LOAD_AUDIT)
        rows.coalesce(1).write.insertInto(audit_table)


def audited_load(
    spark: SparkSession, audit_table: str, table: str, writer: Callable[[], object]
) -> LoadResult:
    result = run_load(table, writer)
    record(spark, audit_table, [result])
    return result


def load_many(
    spark: SparkSession,
    audit_table: str,
    writers: dict[str, Callable[[], object]],
    at_once: int = 4,
) -> list[LoadResult]:
    """Run several loads side by side and return a report, failures included.

    The driver threads only submit Spark jobs, each in a scheduler pool of its own,
    so a long load does not starve the others under the FAIR scheduler.
    """

    def one(table: str, writer: Callable[[], object]) -> LoadResult:
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", table)
        return run_load(table, writer)

    with ThreadPoolExecutor(max_workers=at_once) as threads:
        target = inheritable_thread_target(spark)(one)
        running = [threads.submit(target, table, writer) for table, writer in writers.items()]
        results = [r.result() for r in running]
    if results:
        record(spark, audit_table, results)
    return results


def failed_tables(results: list[LoadResult]) -> list[str]:
    return [r.table for r in results if r.failed]


def import_tables(
    spark: SparkSession,
    config: ImportConfig,
    source: jdbc.Source,
    audit_table: str,
    today: dt.date,
    begin: str | None = None,
    finish: str | None = None,
    keys: dict[str, list[str]] | None = None,
    latest_by: dict[str, str] | None = None,
    metadata: DataFrame | None = None,
    at_once: int = 4,
) -> list[LoadResult]:
    """Import every configured table out of a source; see :class:`daybook.sources.jdbc.Source`.

    Full loads read without a condition and take the column comments of the source's owner
    out of its metadata, or out of ``metadata`` with the same columns. ``keys`` and
    ``latest_by`` name the key of a keyed target and the column by which a row wins. Delta loads read an explicit range if both
    ends are given, else what lies beyond the target's watermark (T0) or the day
    before (T1), and the database filters.
    """

    def condition(task: TableTask) -> str:
        if config.update_type.startswith("full"):
            return ""
        fields = list(task.source_delta_fields)
        if begin and finish:
            return jdbc.delta_condition(fields, begin, finish, source.kind)
        if config.delta_mode == "T1":
            return jdbc.delta_condition(fields, *jdbc.day_before(today), source.kind)
        marks = incremental.table_watermarks(spark, task.target_table, list(task.target_delta_fields))
        return " and ".join(
            jdbc.delta_condition([s], marks[t], None, source.kind)
            for s, t in zip(task.source_delta_fields, task.target_delta_fields)
        )

    def writer(task: TableTask) -> Callable[[], None]:
        def write() -> None:
            df = source.read(spark, task.source_table, condition(task))
            if config.update_type.startswith("full"):
                known = source.metadata(spark) if metadata is None else metadata
                rows = shape.column_comments(
                    known, task.source_table, source.owner, **source.comment_columns()
                ).collect()
                df = shape.with_comments(df, {r["column_name"]: r["comment"] for r in rows})
            incremental.load(
                df, task.target_table, config.update_type,
                task.partition_field, (keys or {}).get(task.target_table),
                (latest_by or {}).get(task.target_table),
            )
        return write

    return load_many(
        spark, audit_table, {t.target_table: writer(t) for t in config.tasks()}, at_once
    )

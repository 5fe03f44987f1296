"""The refresh jobs: base tables, later tables, current cards, the wide table.

Tables live in one database under the names below. Sources are folders of landed
pages under one root, one folder per table. A folder may hold its pages directly, or one
folder ``pull=<number>`` per pull: then the newest pull is read and no other. Every job
sizes its shuffles by the bytes it is going to read.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

from daybook import schemas
from daybook.functions.text import normalize_code
from daybook.operators import journal, tables, wide
from daybook.operators.filters import date_window, rename_headings, union_of_filters
from daybook.plans.jobs import LoadResult, audited_load, create_audit_table, load_many
from daybook.session import ensure_bucket_joins, ensure_skew_splits, estimated_bytes, size_shuffles
from daybook.sources.pages import newest_pull, read_pages

# Look-back of each refresh in days, and of rosters in months.
WIDE_DAYS = 50
ATTENDANCE_DAYS = 50
CARD_DAYS = 32
LATER_DAYS = 50
ROSTER_MONTHS = 2

ATTENDANCE, CARDS, SHIFTS = "day_attendance", "card_record", "shift"
SNAPSHOTS, DEPARTMENTS = "employee_snapshot", "department"
ORG_UNITS, ORG_FUNCTIONS, ORG_CATEGORIES = "org_unit", "org_function", "org_category"
WIDE, AUDIT = "wide_day_record", "load_audit"

TABLES: dict[str, tuple[T.StructType, str | None]] = {
    ATTENDANCE: (schemas.ATTENDANCE, "date"),
    CARDS: (schemas.CARD_RECORD, "signdate"),
    SHIFTS: (schemas.SHIFT, None),
    SNAPSHOTS: (schemas.EMPLOYEE_SNAPSHOT, "date"),
    DEPARTMENTS: (schemas.DEPARTMENT, None),
    ORG_UNITS: (schemas.ORG_UNIT, None),
    ORG_FUNCTIONS: (schemas.ORG_LOOKUP, None),
    ORG_CATEGORIES: (schemas.ORG_LOOKUP, None),
    WIDE: (
        T.StructType([
            T.StructField(c, T.BooleanType() if c == "isleave" else T.StringType())
            for c in schemas.wide_columns()
        ]),
        "date",
    ),
}


#: Large tables that the wide table joins by person and day; in buckets of a person they
#: are joined without a shuffle.
BY_PERSON = {ATTENDANCE: "empid", CARDS: "empid", SNAPSHOTS: "empid"}


def create_table(
    spark: SparkSession, table: str, schema: T.StructType, key: str | None,
    bucket_by: str | None = None, buckets: int | None = None,
) -> None:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    partitioned = f" PARTITIONED BY (`{key}`)" if key else ""
    bucketed = f" CLUSTERED BY (`{bucket_by}`) SORTED BY (`{bucket_by}`) INTO {buckets} BUCKETS" if buckets and bucket_by else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet{partitioned}{bucketed}")


def create_tables(spark: SparkSession, db: str, buckets: int | None = None) -> None:
    """Create what is missing; with ``buckets`` the large tables are co-located by person.

    Every refresh keeps the buckets. A bucket of one day should still make a file worth
    reading: with 50 GB a day and files of 100 MB, about 500.
    """
    for name, (schema, key) in TABLES.items():
        create_table(spark, f"{db}.{name}", schema, key, BY_PERSON.get(name), buckets)
    create_audit_table(spark, f"{db}.{AUDIT}")


def recover_tables(spark: SparkSession, db: str) -> dict[str, dict[str, str]]:
    """Finish or undo what a job that broke off has left in the partitioned tables, by table."""
    found = {
        f"{db}.{name}": journal.recover(spark, f"{db}.{name}")
        for name, (_, key) in TABLES.items() if key and spark.catalog.tableExists(f"{db}.{name}")
    }
    return {table: entries for table, entries in found.items() if entries}


def _landed(
    spark: SparkSession, landing: str, name: str, item: T.StructType, envelope: str = "post"
) -> DataFrame:
    """The pages of a table's newest pull."""
    return read_pages(spark, newest_pull(spark, f"{landing}/{name}"), item, envelope)


def _has_landed(spark: SparkSession, landing: str, name: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{landing}/{name}")
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def _prepare(spark: SparkSession, *inputs: DataFrame) -> None:
    """Settings that a job needs: shuffles as wide as its input, and skewed joins split."""
    size_shuffles(spark, estimated_bytes(*inputs))
    ensure_skew_splits(spark)
    ensure_bucket_joins(spark)


def refresh_base_tables(
    spark: SparkSession, db: str, landing: str, today: dt.date, at_once: int = 5
) -> list[LoadResult]:
    """Departments, shifts, today's employee snapshot, 32 days of cards, 50 of attendance.

    Shift codes are normalised in the dated tables; the shift table lists them as such.
    """

    def pages(name: str, item: T.StructType) -> DataFrame:
        return _landed(spark, landing, name, item)

    _prepare(spark, *[
        pages(n, s) for n, s in ((DEPARTMENTS, schemas.DEPARTMENT), (SNAPSHOTS, schemas.EMPLOYEE),
                                 (SHIFTS, schemas.SHIFT), (CARDS, schemas.CARD_RECORD),
                                 (ATTENDANCE, schemas.ATTENDANCE))
        if _has_landed(spark, landing, n)
    ])
    return load_many(spark, f"{db}.{AUDIT}", {
        f"{db}.{DEPARTMENTS}": lambda: tables.full_refresh(
            pages(DEPARTMENTS, schemas.DEPARTMENT), f"{db}.{DEPARTMENTS}"),
        f"{db}.{SNAPSHOTS}": lambda: tables.write_snapshot(
            pages(SNAPSHOTS, schemas.EMPLOYEE), f"{db}.{SNAPSHOTS}", today),
        f"{db}.{SHIFTS}": lambda: tables.full_refresh(
            pages(SHIFTS, schemas.SHIFT), f"{db}.{SHIFTS}"),
        f"{db}.{CARDS}": lambda: tables.replace_days(
            normalize_code(pages(CARDS, schemas.CARD_RECORD)),
            f"{db}.{CARDS}", "signdate", today, CARD_DAYS),
        f"{db}.{ATTENDANCE}": lambda: tables.replace_days(
            normalize_code(pages(ATTENDANCE, schemas.ATTENDANCE)),
            f"{db}.{ATTENDANCE}", "date", today, ATTENDANCE_DAYS),
    }, at_once)


def refresh_later_tables(
    spark: SparkSession,
    db: str,
    landing: str,
    today: dt.date,
    items: dict[str, T.StructType],
    pending: tuple[Column, ...],
    at_once: int = 6,
) -> list[LoadResult]:
    """Rosters by month; leave, overtime and card corrections by the partitions they
    touch; leave types in full; pending leave by its filters.

    ``items`` declares the row schema per table: ``roster``, ``leave``,
    ``overtime``, ``card_correction``, ``leave_type`` and ``pending_leave``.
    """

    def pages(name: str, envelope: str = "post") -> DataFrame:
        return _landed(spark, landing, name, items[name], envelope)

    def observed(name: str, key: str) -> Callable[[], bool]:
        return lambda: tables.replace_observed(pages(name), f"{db}.{name}", key, today, LATER_DAYS)

    _prepare(spark, *[
        pages(n, "get" if n == "pending_leave" else "post")
        for n in items if _has_landed(spark, landing, n)
    ])
    writers: dict[str, Callable[[], object]] = {
        "roster": lambda: tables.replace_months(
            pages("roster"), f"{db}.roster", "ym", today, ROSTER_MONTHS),
        "leave": observed("leave", "enddate"),
        "leave_type": lambda: tables.full_refresh(pages("leave_type"), f"{db}.leave_type"),
        "pending_leave": lambda: tables.full_refresh(
            rename_headings(union_of_filters(pages("pending_leave", "get"), *pending)),
            f"{db}.pending_leave"),
        "overtime": observed("overtime", "workdate"),
        "card_correction": observed("card_correction", "signdate"),
    }
    return load_many(
        spark, f"{db}.{AUDIT}", {f"{db}.{n}": w for n, w in writers.items()}, at_once
    )


def refresh_current_cards(
    spark: SparkSession, db: str, landing: str, today: dt.date
) -> LoadResult:
    """Today's card records as they come, meant to run every half hour.

    Their codes are normalised when the base refresh next covers the day.
    """
    if _has_landed(spark, landing, CARDS):
        _prepare(spark, _landed(spark, landing, CARDS, schemas.CARD_RECORD))
    return audited_load(
        spark, f"{db}.{AUDIT}", f"{db}.{CARDS}",
        lambda: tables.replace_current_day(
            _landed(spark, landing, CARDS, schemas.CARD_RECORD),
            f"{db}.{CARDS}", "signdate", today),
    )


def wide_window(
    spark: SparkSession, db: str, low: dt.date, high: dt.date, history: bool = False
) -> DataFrame:
    """The wide table of low..high out of the tables of a database."""

    def read(name: str) -> DataFrame:
        return spark.table(f"{db}.{name}")

    org = wide.org_dimension(read(ORG_UNITS), read(ORG_FUNCTIONS), read(ORG_CATEGORIES))
    return wide.wide_record(
        read(ATTENDANCE), read(CARDS), read(SHIFTS), read(SNAPSHOTS), read(DEPARTMENTS), org,
        window=(low, high),
        department_code="value30" if history else "empdept",
        values=schemas.HISTORY_VALUE_COUNT if history else schemas.VALUE_COUNT,
    )


def _wide_inputs(spark: SparkSession, db: str, low: dt.date, high: dt.date) -> list[DataFrame]:
    """The partitions of the three large tables that a window of the wide table reads."""
    return [
        date_window(spark.table(f"{db}.{name}"), low, high, key)
        for name, key in ((ATTENDANCE, "date"), (CARDS, "signdate"), (SNAPSHOTS, "date"))
    ]


def refresh_wide_table(
    spark: SparkSession, db: str, today: dt.date, days: int = WIDE_DAYS
) -> LoadResult:
    """Rebuild the last ``days`` days of the wide table, ending yesterday."""
    low, high = today - dt.timedelta(days=days), today - dt.timedelta(days=1)
    _prepare(spark, *_wide_inputs(spark, db, low, high))
    return audited_load(
        spark, f"{db}.{AUDIT}", f"{db}.{WIDE}",
        lambda: tables.replace_days(
            wide_window(spark, db, low, high), f"{db}.{WIDE}", "date", today, days),
    )


def backfill_wide_table(
    spark: SparkSession, db: str, low: dt.date, high: dt.date, mode: str = "replace"
) -> LoadResult:
    """Build a configured range, replacing it or (``append``) adding to it."""
    _prepare(spark, *_wide_inputs(spark, db, low, high))
    return audited_load(
        spark, f"{db}.{AUDIT}", f"{db}.{WIDE}",
        lambda: tables.backfill_days(
            wide_window(spark, db, low, high), f"{db}.{WIDE}", "date", low, high, mode),
    )


def refresh_narrow_view(spark: SparkSession, db: str, table: str) -> bool:
    return tables.full_refresh(wide.narrow_view(spark.table(f"{db}.{WIDE}")), table)

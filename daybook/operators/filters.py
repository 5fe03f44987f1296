"""Row filters and small projections."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.functions.dates import day_text

# Headings of the pending-leave form and the codes they are renamed to.
PENDING_LEAVE_HEADINGS = {
    "HR公司": "companycode",
    "HR部门": "deptcode",
    "HR科室": "officecode",
    "HR工号": "empnum",
    "提交人邮箱号": "mailnum",
    "开始时间": "start",
    "结束时间": "end",
    "请假类型代码": "leavecode",
}


def date_window(df: DataFrame, low: dt.date, high: dt.date, column: str = "date") -> DataFrame:
    """Rows whose day key lies in low..high, both included.

    The column stays bare, so a partition column prunes partitions.
    """
    return df.where(F.col(column).between(day_text(low), day_text(high)))


def look_back(df: DataFrame, today: dt.date, days: int, column: str = "date") -> DataFrame:
    """The last ``days`` days, ending yesterday."""
    return date_window(df, today - dt.timedelta(days=days), today - dt.timedelta(days=1), column)


def one_day(df: DataFrame, today: dt.date, day: dt.date | None = None, column: str = "date") -> DataFrame:
    """The given day, else yesterday."""
    return df.where(F.col(column) == day_text(day or today - dt.timedelta(days=1)))


def open_ended(df: DataFrame, today: dt.date, days: int = 50, column: str = "date") -> DataFrame:
    """From ``days`` days ago on, future rows included."""
    return df.where(F.col(column) >= day_text(today - dt.timedelta(days=days)))


def known_members(df: DataFrame, column: str = "empnum") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def rename_headings(df: DataFrame, headings: dict[str, str] = PENDING_LEAVE_HEADINGS) -> DataFrame:
    return df.withColumnsRenamed(headings)


def union_of_filters(df: DataFrame, *conditions: Column) -> DataFrame:
    """One pull per condition, appended: a row that meets two conditions comes twice.

    Each row is emitted as often as it meets a condition, in one pass over the input.
    Rows that meet none are filtered first, so the filter reaches the scan.
    """
    met = F.array_size(F.array_compact(F.array(*[F.when(c, F.lit(1)) for c in conditions])))
    return any_filter(df, *conditions).withColumn(
        "_copy", F.explode(F.array_repeat(F.lit(0), met))
    ).drop("_copy")


def any_filter(df: DataFrame, *conditions: Column) -> DataFrame:
    """Rows that meet at least one condition, once each."""
    either = conditions[0]
    for condition in conditions[1:]:
        either = either | condition
    return df.where(either)


def preview(df: DataFrame, *order: str, rows: int = 10) -> DataFrame:
    """The first rows in a given order (a top-k, not a full sort)."""
    return df.orderBy(*order).limit(rows)

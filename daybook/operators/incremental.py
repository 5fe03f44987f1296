"""Incremental loads: watermarks, delta ranges, resume, load modes."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import clean_text_columns
from daybook.operators import merge_on_read, statistics, tables
from daybook.operators.shape import cast_to_schema, vendor_names

# Update types and delta modes.
UPDATE_TYPES = ("full", "fullpart", "delta", "deltapart")
DELTA_MODES = ("T0", "T1")


def watermarks(target: DataFrame, columns: list[str]) -> dict[str, str | None]:
    """The largest value of each column as exact text, None for an empty target."""
    row = target.agg(*[F.max(c).cast("string").alias(c) for c in columns]).first()
    return {c: row[c] for c in columns}


def table_watermarks(spark: SparkSession, table: str, columns: list[str]) -> dict[str, str | None]:
    """The same of a catalog table: from its statistics if it is tracked, else by a scan."""
    if set(columns) <= set(statistics.tracked(spark, table)):
        return statistics.watermarks(spark, table, columns)
    return watermarks(spark.table(table), columns)


def watermark_text(target: DataFrame, column: str) -> DataFrame:
    """One row: the largest value of a column, in 24-hour form."""
    return target.where(F.col(column).isNotNull()).agg(
        F.date_format(F.max(column), "yyyy-MM-dd HH:mm:ss").alias("watermark")
    )


def newer_than_target(
    source: DataFrame, target: DataFrame, fields: list[tuple[str, str]],
    marks: dict[str, str | None] | None = None,
) -> DataFrame:
    """T0: source rows beyond the target's largest value, in every delta field.

    The watermark is one row, fetched first: as a literal of the column's own type
    it is pushed down to the source scan. An empty target loads everything. Known ``marks``,
    such as those of :func:`table_watermarks`, save the scan of the target.
    """
    if marks is None:
        marks = watermarks(target, [t for _, t in fields])
    conditions = [
        F.col(s) > F.lit(marks[t]).cast(target.schema[t].dataType)
        for s, t in fields if marks[t] is not None
    ]
    return source.where(_all(conditions)) if conditions else source


def within(source: DataFrame, fields: list[str], begin: dt.datetime, finish: dt.datetime) -> DataFrame:
    """Half-open range ``[begin, finish)`` in every delta field."""
    return source.where(_all([
        (F.col(f) >= _bound(source, f, begin)) & (F.col(f) < _bound(source, f, finish))
        for f in fields
    ]))


def previous_day(source: DataFrame, fields: list[str], today: dt.date) -> DataFrame:
    """T1: from yesterday 00:00 up to, not including, today 00:00."""
    midnight = dt.datetime.combine(today, dt.time())
    return within(source, fields, midnight - dt.timedelta(days=1), midnight)


def delta(
    source: DataFrame,
    target: DataFrame,
    fields: list[tuple[str, str]],
    mode: str,
    today: dt.date | None = None,
    begin: dt.datetime | None = None,
    finish: dt.datetime | None = None,
) -> DataFrame:
    """An explicit range if both ends are given, else the delta mode."""
    if begin is not None and finish is not None:
        return within(source, [s for s, _ in fields], begin, finish)
    if mode == "T0":
        return newer_than_target(source, target, fields)
    if mode == "T1":
        if today is None:
            raise ValueError("mode T1 needs today")
        return previous_day(source, [s for s, _ in fields], today)
    raise ValueError(f"delta mode is one of {DELTA_MODES}, not {mode!r}")


def not_yet_loaded(source: DataFrame, target: DataFrame, keys: list[str]) -> DataFrame:
    """Resume: source rows whose key the target does not hold; a null equals another null."""
    held = target.select(*[F.col(k).alias(f"_held_{k}") for k in keys]).distinct()
    same = _all([F.col(k).eqNullSafe(F.col(f"_held_{k}")) for k in keys])
    return source.join(held, same, "left_anti")


def partition_row_count(df: DataFrame, column: str, value: str) -> DataFrame:
    return df.where(F.col(column) == value).agg(F.count(F.lit(1)).alias("n_rows"))


def distinct_partitions(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).distinct()


def prepare(df: DataFrame, table: str) -> DataFrame:
    """Clean names and values, and cast to the target's schema (a key's bucket comes later)."""
    target = df.sparkSession.table(table).schema
    later = (tables.KEY_BUCKET, merge_on_read.SEQUENCE, merge_on_read.DELETED)
    own = T.StructType([f for f in target.fields if f.name not in later])
    return cast_to_schema(clean_text_columns(vendor_names(df)), own)


def load(
    df: DataFrame,
    table: str,
    update_type: str,
    partition_field: str | None = None,
    keys: list[str] | None = None,
    latest_by: str | None = None,
) -> None:
    """Save a frame by update type.

    ``full`` and ``fullpart`` create the table anew, ``delta`` and ``deltapart``
    clean, cast and append. With ``keys`` the table counts as keyed: ``full``
    replaces all rows and ``delta`` upserts. A keyed table holds a key once: of rows with
    the same key the one with the largest ``latest_by`` counts, and without that column a
    repeated key is an error.
    """
    if update_type not in UPDATE_TYPES:
        raise ValueError(f"update type is one of {UPDATE_TYPES}, not {update_type!r}")
    if update_type.endswith("part"):
        if not partition_field or keys:
            raise ValueError("a partitioned load needs a partition field and no keys")
        df = tables.with_derived_partitions(df, partition_field)
    if update_type == "full" and keys:
        tables.replace_all_rows(df, table, keys, latest_by)
    elif update_type == "full":
        tables.full_overwrite(df, table)
    elif update_type == "fullpart":
        tables.full_overwrite(df, table, tables.derived_partition_names(partition_field)[1])
    elif update_type == "delta" and merge_on_read.layout(df.sparkSession, table):
        merge_on_read.write(prepare(df, table), table, latest_by)
    elif keys:
        tables.upsert_table(prepare(df, table), table, keys, latest_by)
    else:
        tables.append(prepare(df, table), table)


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def _bound(source: DataFrame, field: str, moment: dt.datetime) -> Column:
    return F.lit(moment.isoformat(sep=" ")).cast(source.schema[field].dataType)

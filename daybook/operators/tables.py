"""Writing and maintaining catalog tables.

Partitioned writes are rebalanced by the partition key: AQE merges small pieces and
cuts an oversized day into several files, so one hot partition is never one task.
Partitions are replaced through the journal, so a job that breaks off is finished or
undone by the next one.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions import dates
from daybook.operators import journal, statistics
from daybook.operators.catalog import bucket_columns, partition_columns
from daybook.operators.filters import open_ended
from daybook.operators.keys import KEY_BUCKET, latest_per_key, repeated_key, with_key_bucket
from daybook.session import scratch_database

#: Table property with the number of buckets of a keyed table.
BUCKETS_PROPERTY = "daybook.key_buckets"


def align(df: DataFrame, table: str) -> DataFrame:
    """Project to the target's columns in the target's order; a missing one is an error."""
    target = df.sparkSession.table(table).columns
    missing = [c for c in target if c not in df.columns]
    if missing:
        raise ValueError(f"{table} needs columns the data lacks: {missing}")
    return df.select(*[F.col(f"`{c}`") for c in target])


# --- plain writes ------------------------------------------------------------

def append(df: DataFrame, table: str) -> bool:
    """Aligned append; a frame without columns is skipped, and False returned."""
    if not df.columns:
        return False
    keys = bucket_columns(df.sparkSession, table) or partition_columns(df.sparkSession, table)
    rows, written = statistics.observed(align(df, table), table)
    (rows.hint("rebalance", *keys) if keys else rows).write.insertInto(table)
    written(statistics.APPENDED)
    return True


def full_overwrite(df: DataFrame, table: str, partition_by: list[str] | None = None) -> bool:
    """Create the table anew from the frame's own schema."""
    if not df.columns:
        return False
    keys = partition_by or []
    rows = df.hint("rebalance", *keys) if keys else df
    rows.write.mode("overwrite").partitionBy(*keys).saveAsTable(table)
    return True


def bucketed_table(
    df: DataFrame, table: str, bucket_by: list[str], buckets: int, partition_by: list[str] | None = None
) -> None:
    """Create a table whose rows of one key lie in the same bucket of every partition.

    Tables with the same number of buckets of the same key are joined on it, and on more
    columns beside it, without a shuffle. Appends and replacements keep the buckets.
    """
    writer = df.hint("rebalance", *bucket_by).write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, *bucket_by).sortBy(*bucket_by).saveAsTable(table)


def full_refresh(df: DataFrame, table: str, staged: bool = False) -> bool:
    """Replace every row, keep the table and its schema.

    ``staged`` writes the rows aside first; it is needed when they are read from
    the table itself. The staged copy goes once the table is complete, so a refresh
    that breaks off leaves it to start again from.
    """
    if not df.columns:
        return False
    spark = df.sparkSession
    if staged:
        stage = scratch_database(spark, "stage")
        align(df, table).write.saveAsTable(f"{stage}.stage_rows")
        full_refresh(spark.table(f"{stage}.stage_rows"), table)
        spark.sql(f"DROP DATABASE {stage} CASCADE")
        return True
    keys = partition_columns(spark, table)
    if not keys:
        rows, written = statistics.observed(align(df, table), table)
        rows.write.insertInto(table, overwrite=True)
        written(statistics.REPLACED)
        return True
    journal.replace(_as_stored(df, table, keys), table, keys)
    return True


def replace_all_rows(
    df: DataFrame, table: str, keys: list[str] | None = None, latest_by: str | None = None
) -> bool:
    """Keyed full replace: the table holds the new set and nothing else.

    With ``keys`` a key is held once: the row with the largest ``latest_by`` stays, and
    without that column a repeated key is an error.
    """
    if keys and latest_by:
        df = latest_per_key(df, keys, latest_by)
    elif keys and (twice := repeated_key(df, keys)) is not None:
        raise ValueError(f"the new set holds the key {twice} more than once")
    if keys and (buckets := key_buckets(df.sparkSession, table)):
        df = with_key_bucket(df, keys, buckets)
    return full_refresh(df, table)


# --- partition replacement ---------------------------------------------------

def replace_partitions(
    df: DataFrame, table: str, key: str, window: list[str], if_filled: list[str] | None = None
) -> bool:
    """Replace the listed partitions by the frame's rows of those partitions.

    Partitions ``if_filled`` are replaced too where the frame has rows of them, else kept.

    A listed partition without new rows is emptied. The frame is computed once, and all
    partitions change together or not at all: see :mod:`daybook.operators.journal`.
    """
    if not df.columns:
        return False
    rows = df.where(F.col(key).isin([*window, *(if_filled or [])]))
    journal.replace(_as_stored(rows, table, [key]), table, [key], [(v,) for v in window])
    return True


def replace_days(df: DataFrame, table: str, key: str, today: dt.date, days: int) -> bool:
    """Replace the last ``days`` days, ending yesterday."""
    return replace_partitions(df, table, key, dates.last_n_day_texts(today, days))


def replace_one_day(
    df: DataFrame, table: str, key: str, today: dt.date, day: dt.date | None = None
) -> bool:
    """Replace the given day, else yesterday."""
    return replace_partitions(
        df, table, key, [dates.day_text(day or today - dt.timedelta(days=1))]
    )


def replace_current_day(df: DataFrame, table: str, key: str, today: dt.date) -> bool:
    return replace_partitions(df, table, key, [dates.day_text(today)])


def replace_months(
    df: DataFrame, table: str, key: str, today: dt.date, months_back: int = 2
) -> bool:
    """Replace the months from ``months_back`` ago to now, and next month if it has rows.

    Next month is written with the others but never emptied, so the source is read once.
    """
    window = dates.month_texts(dates.shift_month(today, -months_back), today)
    return replace_partitions(
        df, table, key, window, [dates.month_text(dates.shift_month(today, 1))]
    )


def replace_observed(df: DataFrame, table: str, key: str, today: dt.date, days: int = 50) -> bool:
    """Rows from ``days`` days ago on replace exactly the partitions they fall in."""
    if not df.columns:
        return False
    journal.replace(_as_stored(open_ended(df, today, days, key), table, [key]), table, [key], [])
    return True


def backfill_days(
    df: DataFrame, table: str, key: str, low: dt.date, high: dt.date, mode: str = "replace"
) -> bool:
    """Load low..high. ``replace`` may be run again; ``append`` adds the rows every time."""
    if mode == "append":
        return append(df.where(F.col(key).between(dates.day_text(low), dates.day_text(high))), table)
    return replace_partitions(df, table, key, dates.day_texts(low, high))


# The month-long ranges of a back-fill cover low..high without gap or overlap, so
# loading them one after the other is loading the days of low..high.
backfill_months = backfill_days


# --- snapshots ---------------------------------------------------------------

def stamp(df: DataFrame, day: dt.date, column: str = "date") -> DataFrame:
    return df.withColumn(column, F.lit(dates.day_text(day)))


def write_snapshot(df: DataFrame, table: str, day: dt.date, column: str = "date") -> bool:
    """Stamp the full set with one day and replace that day's partition."""
    return replace_partitions(stamp(df, day, column), table, column, [dates.day_text(day)])


def repeat_per_day(df: DataFrame, low: dt.date, high: dt.date, column: str = "date") -> DataFrame:
    """The same set once per day of low..high."""
    days = dates.date_series(F.lit(low), F.lit(high))
    return df.withColumn(column, F.explode(F.transform(days, dates.day_key)))


def backfill_snapshot(
    df: DataFrame, table: str, low: dt.date, high: dt.date, column: str = "date",
    mode: str = "replace",
) -> bool:
    """Write the same snapshot for every day of low..high in one job."""
    return backfill_days(repeat_per_day(df, low, high, column), table, column, low, high, mode)


# --- derived partitions ------------------------------------------------------

DERIVED = {"year": F.year, "month": F.month, "day": F.dayofmonth}


def derived_partition_names(spec: str) -> tuple[str, list[str]]:
    """``column-month`` to the source column and ``[year, month]``."""
    column, separator, grain = spec.rpartition("-")
    if not separator or grain not in DERIVED:
        raise ValueError(f"a partition field reads column-year, -month or -day, not {spec!r}")
    names = list(DERIVED)
    return column, names[: names.index(grain) + 1]


def with_derived_partitions(df: DataFrame, spec: str) -> DataFrame:
    column, names = derived_partition_names(spec)
    return df.withColumns({name: DERIVED[name](column) for name in names})


# --- keyed upsert ------------------------------------------------------------

def upsert(
    old: DataFrame, new: DataFrame, keys: list[str], latest_by: str | None = None
) -> DataFrame:
    """Old rows whose key is not among the new ones, and all new rows.

    Keys are unique in a keyed table; a null in a key equals another null. Where a batch
    may repeat a key, ``latest_by`` names the column whose largest value wins. The new
    keys are made distinct before they are shuffled, so a repeated key costs one row per
    task.
    """
    if latest_by:
        new = latest_per_key(new, keys, latest_by)
    fresh = new.select(*[F.col(k).alias(f"_new_{k}") for k in keys]).distinct()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in keys])
    return old.join(fresh, same, "left_anti").unionByName(new)


def keyed_table(df: DataFrame, table: str, keys: list[str], buckets: int) -> None:
    """Create a table partitioned by a hash bucket of its key.

    An upsert then rewrites the buckets that get new rows instead of the whole table. The
    bucket is a column of the table; its number is kept as a table property.
    """
    full_overwrite(with_key_bucket(df, keys, buckets), table, [KEY_BUCKET])
    df.sparkSession.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BUCKETS_PROPERTY}' = '{buckets}')")


def key_buckets(spark: SparkSession, table: str) -> int | None:
    """Number of buckets of a table made by :func:`keyed_table`, else None."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == BUCKETS_PROPERTY).collect()
    return int(rows[0]["value"]) if rows else None


def upsert_table(new: DataFrame, table: str, keys: list[str], latest_by: str | None = None) -> None:
    """Upsert into a catalog table.

    If the partition columns are part of the key, or the bucket of a keyed table, only the
    partitions that get new rows are rewritten; otherwise the new state is staged and
    swapped in. Without ``latest_by`` a repeated key in the batch is an error, as the
    table would hold it twice.
    """
    spark = new.sparkSession
    if latest_by is None and (twice := repeated_key(new, keys)) is not None:
        raise ValueError(f"the batch holds the key {twice} more than once; name a latest_by column")
    old, parts = spark.table(table), partition_columns(spark, table)
    if parts == [KEY_BUCKET] and (buckets := key_buckets(spark, table)):
        new, keys = with_key_bucket(new, keys, buckets), [*keys, KEY_BUCKET]
    if parts and set(parts) <= set(keys):
        touched = [tuple(r) for r in new.select(*parts).distinct().collect()]
        if not touched:
            return
        named = spark.createDataFrame(touched, new.select(*parts).schema).toDF(
            *[f"_touched_{p}" for p in parts]
        )
        same = reduce(
            lambda a, b: a & b, [F.col(p).eqNullSafe(F.col(f"_touched_{p}")) for p in parts]
        )
        old = old.join(named, same, "left_semi")
        journal.replace(_as_stored(upsert(old, new, keys, latest_by), table, parts), table, parts, [])
    else:
        full_refresh(upsert(old, new, keys, latest_by), table, staged=True)


# --- internals ---------------------------------------------------------------

def _as_stored(df: DataFrame, table: str, keys: list[str]) -> DataFrame:
    """The frame aligned to the table, with partition keys in the type the table has.

    So their text is the catalog's text. A blank text is stored as the null partition.
    """
    target = df.sparkSession.table(table).schema

    def stored(name: str) -> Column:
        value = F.col(f"`{name}`")
        if name not in keys:
            return value
        value = value.cast(target[name].dataType)
        if isinstance(target[name].dataType, T.StringType):
            value = F.when(value != "", value)
        return value.alias(name)

    rows = align(df, table)
    return rows.select(*[stored(c) for c in rows.columns])

"""Daily snapshots as intervals: a row is stored once for as long as it stays the same.

A snapshot table holds the full set once per pull. Here a row carries the first and the last
pull that held it unchanged. Pulls are numbered by their day, and intervals count pulls, not
days: a day without a pull neither ends an interval nor comes back when it is expanded. Equal
rows of one pull are one row with a number of copies, so bags survive.

The table keeps open intervals (those that the newest pull holds) apart from closed ones.
Adding a pull rewrites the open ones, as many rows as one pull has, and adds a partition of
those it closes; what was closed before is not read.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from daybook.operators import catalog, journal

FIRST, LAST, COPIES = "first_pull", "last_pull", "copies"
#: Partition of an interval: ``open``, or the day of the pull that no longer held it.
STATE, OPEN = "closed_by", "open"
PULL = "pull"


# --- frames --------------------------------------------------------------------

def pulls_of(snapshots: DataFrame, day: str = "date") -> DataFrame:
    """The days that have a pull, numbered from 1: one row per day, not per row of a pull."""
    return snapshots.select(day).distinct().where(F.col(day).isNotNull()).withColumn(
        PULL, F.row_number().over(Window.orderBy(day)).cast("long")
    )


def compress(snapshots: DataFrame, pulls: DataFrame, day: str = "date") -> DataFrame:
    """Snapshots to intervals: the rows' columns without the day, first_pull, last_pull, copies.

    Pulls in a row that hold a row equally often are one interval (gaps and islands).
    Rows of days that are not among the pulls are left out.
    """
    held = [c for c in snapshots.columns if c != day]
    counted = snapshots.groupBy(*held, day).agg(F.count(F.lit(1)).alias(COPIES)).join(
        F.broadcast(pulls), day
    )
    row = Window.partitionBy(*held, COPIES).orderBy(PULL)
    return (
        counted.withColumn("_island", F.col(PULL) - F.row_number().over(row))
        .groupBy(*held, COPIES, "_island")
        .agg(F.min(PULL).alias(FIRST), F.max(PULL).alias(LAST))
        .select(*held, FIRST, LAST, COPIES)
    )


def expand(intervals: DataFrame, pulls: DataFrame, day: str = "date") -> DataFrame:
    """Intervals back to one row per pull and copy."""
    held = [c for c in intervals.columns if c not in (FIRST, LAST, COPIES, STATE)]
    each = intervals.select(
        *held, F.explode(F.sequence(FIRST, LAST)).alias(PULL), COPIES
    ).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES))))
    return each.join(F.broadcast(pulls), PULL).select(*held, day)


def of_day(intervals: DataFrame, pulls: DataFrame, day_text: str, day: str = "date") -> DataFrame:
    """The snapshot of one day; nothing for a day without a pull. Only that day is expanded."""
    one = pulls.where(F.col(day) == day_text)
    met = intervals.join(F.broadcast(one), F.col(PULL).between(F.col(FIRST), F.col(LAST)))
    held = [c for c in intervals.columns if c not in (FIRST, LAST, COPIES, STATE)]
    return met.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col(COPIES)))).select(*held, day)


def join_as_of(
    facts: DataFrame, intervals: DataFrame, pulls: DataFrame, keys: list[str], day: str = "date"
) -> DataFrame:
    """Facts with the row of their key and day, if that day has a pull that holds one.

    The join is on the key, the pull's number lies within the interval: an interval is not
    expanded to days. Copies fan out like the rows they stand for.
    """
    numbered = facts.join(F.broadcast(pulls), day, "left").withColumnRenamed(PULL, "_pull")
    held = [c for c in intervals.columns if c not in (*keys, FIRST, LAST, COPIES, STATE)]
    side = intervals.select(
        *[F.col(k).alias(f"_key_{k}") for k in keys], *held, F.col(FIRST).alias("_first"),
        F.col(LAST).alias("_last"), F.sequence(F.lit(1).cast("long"), F.col(COPIES)).alias("_copies"),
    )
    same = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_key_{k}") for k in keys])
    joined = numbered.join(side, same & F.col("_pull").between(F.col("_first"), F.col("_last")), "left")
    return joined.withColumn("_copy", F.explode_outer("_copies")).select(*facts.columns, *held)


# --- tables --------------------------------------------------------------------

def create(snapshots: DataFrame, table: str, day: str = "date") -> None:
    """Make the interval table and ``<table>_pulls`` out of snapshots, which may be none."""
    spark = snapshots.sparkSession
    pulls = pulls_of(snapshots, day)
    pulls.coalesce(1).write.mode("overwrite").saveAsTable(f"{table}_pulls")
    pulls = spark.table(f"{table}_pulls")
    last = pulls.agg(F.max(PULL)).first()[0] or 0
    closing = pulls.select((F.col(PULL) - 1).alias(LAST), F.col(day).alias("_closed"))
    rows = compress(snapshots, pulls, day).join(F.broadcast(closing), LAST, "left")
    rows.select(
        *[c for c in snapshots.columns if c != day], FIRST, LAST, COPIES,
        F.when(F.col(LAST) == last, OPEN).otherwise(F.col("_closed").cast("string")).alias(STATE),
    ).hint("rebalance", STATE).write.mode("overwrite").partitionBy(STATE).saveAsTable(table)


def add_pull(snapshot: DataFrame, table: str, day_text: str, day: str = "date") -> int:
    """Add the full set of one more day, and return the pull's number.

    The newest day may be added again, as after a load that went wrong: it is taken back
    first. An older day is an error. A load that breaks off is finished or undone by the next.
    """
    spark = snapshot.sparkSession
    journal.recover(spark, table)
    known = spark.table(f"{table}_pulls").orderBy(F.col(PULL).desc()).limit(1).collect()
    newest, number = (str(known[0][day]), known[0][PULL]) if known else ("", 0)
    if day_text < newest:
        raise ValueError(f"{day_text} lies before the newest pull, {newest}")
    if day_text > newest:
        number += 1
    before = _before(spark, table, day_text, number)
    held = [c for c in spark.table(table).columns if c not in (FIRST, LAST, COPIES, STATE)]
    now = snapshot.groupBy(*held).agg(F.count(F.lit(1)).alias(COPIES)).withColumns(
        {FIRST: F.lit(number).cast("long"), LAST: F.lit(number).cast("long")}
    ).select(*held, FIRST, LAST, COPIES)
    # A row of the last pull that is among the new ones, as often, goes on.
    merged = before.unionByName(now).groupBy(*held, COPIES).agg(F.min(FIRST).alias(FIRST), F.max(LAST).alias(LAST))
    rows = merged.withColumn(STATE, F.when(F.col(LAST) == number, OPEN).otherwise(day_text))
    rows = rows.select(spark.table(table).columns)
    if day_text > newest:
        # The pull is known before its rows are: an interval can only count known pulls.
        pulls = spark.createDataFrame([(day_text, number)], f"`{day}` string, {PULL} long")
        kind = spark.table(f"{table}_pulls").schema[day].dataType
        pulls.withColumn(day, F.col(day).cast(kind)).write.insertInto(f"{table}_pulls")
    journal.replace(rows, table, [STATE], [(OPEN,), (day_text,)])
    return number


def _before(spark: SparkSession, table: str, day_text: str, number: int) -> DataFrame:
    """The intervals that the pull before ``number`` left open, also after ``number`` was added.

    Those that ``number`` closed are open again, those it went on with end one pull earlier,
    and those it began are not there.
    """
    rows = spark.table(table).where(F.col(STATE).isin(OPEN, day_text)).where(F.col(FIRST) < number)
    return rows.withColumn(LAST, F.lit(number - 1).cast("long")).drop(STATE)

"""HR tables derived from the test tables, so that the operators can be checked.

Misses are part of the data: people without a number, days before the first
snapshot, codes no department, shift or org unit has.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.functions.dates import date_series, day_key
from daybook.session import estimated_bytes

CARD_TYPES = ["click", "error"]
EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]
#: Bytes of stored people that one task repeats per day.
PEOPLE_BYTES = 512 * 1024


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A test table."""
    return spark.read.parquet(f"{sf}/{name}.parquet")


def text(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("string")


def money(column: Column | str) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(18,2)")


def attendance(spark: SparkSession, sf: str) -> DataFrame:
    """One fact per person and day, 55 values as text."""
    amount = "cast(value as decimal(18,2))"
    aggregates = {1: "count(1)", 2: f"sum({amount})", 3: f"min({amount})", 4: f"max({amount})",
                  5: "min(event_id)", 6: "max(event_id)", 30: "max(user_id % 26)"}
    aggregates |= {i: f"count_if(event_type = '{t}')" for i, t in enumerate(EVENT_TYPES, 7)}
    rows = table(spark, sf, "events").groupBy(
        text("user_id").alias("empid"), day_key("ts").alias("date")
    ).agg(
        F.expr("date_format(max(ts), 'yyyy-MM-dd HH:mm:ss') as updatetime"),
        *[F.expr(f"{v} as v{i}") for i, v in aggregates.items()],
    )
    return rows.selectExpr(
        "concat_ws('-', empid, substr(date, 1, 10)) as recordid", "empid", "updatetime", "date",
        *[
            f"cast({f'v{i}' if i in aggregates else f'(v5 + v6 * {i}) % 1000'} as string) as value{i}"
            for i in range(1, 56)
        ],
    )


def cards(spark: SparkSession, sf: str) -> DataFrame:
    """Card records; a person may have many a day."""
    return table(spark, sf, "events").where(F.col("event_type").isin(CARD_TYPES)).select(
        text("user_id").alias("empid"), day_key("ts").alias("signdate"),
        F.col("event_type").alias("shiftcode"),
    )


def shifts(spark: SparkSession, sf: str) -> DataFrame:
    """One shift per event type, but none for errors."""
    return (
        table(spark, sf, "events").where(F.col("event_type") != "error")
        .select(F.col("event_type").alias("shiftcode")).distinct()
        .withColumn("shiftname", F.concat("shiftcode", F.lit(" shift")))
    )


def people(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("c_custkey")
    entry = F.date_add(F.lit("2024-01-01").cast("date"), (key % 20).cast("int"))
    leave = F.date_add(F.lit("2024-01-15").cast("date"), (key % 10).cast("int"))
    return table(spark, sf, "customer").select(
        text("c_custkey").alias("empid"),
        F.when(F.col("c_acctbal") >= 0, text("c_custkey")).alias("empnum"),
        F.col("c_mktsegment").alias("emprank"),
        F.col("c_name").alias("empname"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", F.concat(F.lit("X"), text("c_nationkey")))
        .otherwise(text("c_nationkey")).alias("empdept"),
        F.when(F.col("c_acctbal") > 5000, "fixed").otherwise("flex").alias("atttype"),
        F.when(key % 5 != 0, day_key(entry)).alias("entrydate"),
        F.when(key % 3 == 0, day_key(leave)).alias("leavedate"),
        F.when(key % 2 == 0, "true").when(F.col("c_mktsegment") == "BUILDING", "n/a")
        .otherwise("false").alias("isleave"),
    )


def snapshots(spark: SparkSession, sf: str) -> DataFrame:
    """A full copy of the people per day, from the third day of the events on.

    People are few bytes in few files, their copies are not: people are dealt to tasks before
    they are repeated, by their size, so that no task makes and groups the days of them all.
    The keys of the days are made once, not for every copy.
    """
    low, high = F.date_add(F.to_date(F.min("ts")), 2), F.to_date(F.max("ts"))
    days = table(spark, sf, "events").agg(F.transform(date_series(low, high), day_key).alias("days"))
    each = people(spark, sf)
    parts = max(spark.sparkContext.defaultParallelism, -(-estimated_bytes(each) // PEOPLE_BYTES))
    # Dealt by place: the same rows to the same tasks, whatever columns are read of them.
    dealt = each.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(parts, "_place").drop("_place")
    return dealt.withColumn("date", F.explode(days.scalar()))


def departments(spark: SparkSession, sf: str) -> DataFrame:
    name, region = F.col("n_name"), F.col("n_regionkey")
    return table(spark, sf, "nation").select(
        text("n_nationkey").alias("deptcode"),
        name.alias("deptnamel1"),
        F.when(region % 2 == 0, "").otherwise(name).alias("deptnamel2"),
        F.when(region == 1, "").otherwise(F.concat(F.lit("sub_"), name)).alias("deptnamel3"),
        F.lit("").alias("deptnamel4"),
        F.lit(None).cast("string").alias("deptnamel5"),
    )


def org_units(spark: SparkSession, sf: str) -> DataFrame:
    key, region = text("n_nationkey"), F.col("n_regionkey")
    return table(spark, sf, "nation").select(
        F.when(region == 4, F.concat(F.lit("U"), key)).otherwise(key).alias("fnumber"),
        text(region + 1).alias("forgfunctionid"),
        text(region - 1).alias("freserveitemfirst"),
        F.concat(F.lit("L"), key).alias("flongnumber"),
        F.concat(F.lit("S"), key).alias("fsortcode"),
        F.concat(F.lit("root_"), "n_name").alias("fdisplayname_l2"),
    )


def org_functions(spark: SparkSession, sf: str) -> DataFrame:
    key = text("r_regionkey")
    return table(spark, sf, "region").select(
        key.alias("fid"), F.col("r_name").alias("fname_l2"), F.concat(F.lit("F"), key).alias("fnumber")
    )


def org_categories(spark: SparkSession, sf: str) -> DataFrame:
    key = text("r_regionkey")
    return table(spark, sf, "region").select(
        key.alias("fid"), F.lower("r_name").alias("fname_l2"),
        F.concat(F.lit("C"), key).alias("fnumber"),
    )

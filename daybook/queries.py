"""The registered queries: every operator over the test tables.

Queries that maintain a table create it in a database of their own, run the
operator, and return the table's final state.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas
from daybook.functions import dates, text
from daybook.operators import (
    catalog, filters, ids, incremental, intervals, journal, merge_on_read, shape, statistics, tables, wide,
)
from daybook.operators.joins import broadcast_when_small
from daybook.plans import graph, jobs
from daybook.plans import hr_views as hr
from daybook.session import ensure_bucket_joins, scratch_database, workspace
from daybook.sources import drift, jdbc, paged, pages, quarantine
from daybook.streaming.current_day import stream_current_day, stream_pulls

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

TODAY = dt.date(2024, 1, 25)
LATER_TODAY = dt.date(2024, 3, 1)
MONTH_TODAY = dt.date(1998, 8, 15)
EMPTIED_DAY = "2024-01-17T00:00:00"
EMPTIED_MONTH = "199807"
NO_PULL = dt.date(2024, 1, 28)


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


# --- the wide table ----------------------------------------------------------

def _org(spark: SparkSession, sf: str, label: str | None = None) -> DataFrame:
    return wide.org_dimension(
        hr.org_units(spark, sf), hr.org_functions(spark, sf), hr.org_categories(spark, sf), label
    )


def _wide(spark: SparkSession, sf: str, **options) -> DataFrame:
    return wide.wide_record(
        hr.attendance(spark, sf), hr.cards(spark, sf), hr.shifts(spark, sf),
        hr.snapshots(spark, sf), hr.departments(spark, sf), _org(spark, sf), **options,
    )


@query
def wide_record_current(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf)


@query
def wide_record_history(spark: SparkSession, sf: str) -> DataFrame:
    return _wide(spark, sf, department_code="value30", values=schemas.HISTORY_VALUE_COUNT)


@query
def wide_record_refresh(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'wide_refresh')}.wide"
    tables.full_overwrite(
        _wide(spark, sf).withColumn("empname", F.lit("stale")), target, ["date"]
    )
    window = (TODAY - dt.timedelta(days=50), TODAY - dt.timedelta(days=1))
    tables.replace_days(_wide(spark, sf, window=window), target, "date", TODAY, 50)
    return spark.table(target)


@query
def wide_record_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The wide table of tables in buckets of a person, which a refresh has written anew."""
    db = scratch_database(spark, "bucketed")
    ensure_bucket_joins(spark)
    sources = {"facts": (hr.attendance, "date"), "cards": (hr.cards, "signdate"), "people": (hr.snapshots, "date")}
    for name, (view, day) in sources.items():
        rows, stale = view(spark, sf), F.lit("stale")
        old = rows.withColumns({c: stale for c in rows.columns if c in ("value2", "shiftcode", "empname")})
        recent = F.col(day).between(dates.day_text(TODAY - dt.timedelta(days=50)), dates.day_text(TODAY - dt.timedelta(days=1)))
        tables.bucketed_table(
            rows.where(~recent).unionByName(old.where(recent)).select(rows.columns), f"{db}.{name}", ["empid"], 8, [day])
        tables.replace_days(rows, f"{db}.{name}", day, TODAY, 50)
    return wide.wide_record(
        spark.table(f"{db}.facts"), spark.table(f"{db}.cards"), hr.shifts(spark, sf),
        spark.table(f"{db}.people"), hr.departments(spark, sf), _org(spark, sf),
    )


@query
def org_dimension(spark: SparkSession, sf: str) -> DataFrame:
    return _org(spark, sf)


@query
def default_label_observed(spark: SparkSession, sf: str) -> DataFrame:
    return _org(spark, sf).select("fnumber", "systemcategory", "companycategory")


@query
def default_label_intended(spark: SparkSession, sf: str) -> DataFrame:
    return _org(spark, sf, "other").select("fnumber", "systemcategory", "companycategory")


@query
def employment_status_asof(spark: SparkSession, sf: str) -> DataFrame:
    return wide.with_status(hr.snapshots(spark, sf)).select(
        "empid", "date", "entrydate", "leavedate", "isleave"
    )


@query
def composite_key_left_join(spark: SparkSession, sf: str) -> DataFrame:
    facts = hr.attendance(spark, sf).select("empid", "date", "value1")
    return wide.join_cards(facts, hr.cards(spark, sf))


@query
def chained_lookup_join(spark: SparkSession, sf: str) -> DataFrame:
    facts = hr.attendance(spark, sf).select("empid", "date", "value1")
    shift, = broadcast_when_small(wide.shift_dimension(hr.shifts(spark, sf)))
    return wide.join_shifts(wide.join_cards(facts, hr.cards(spark, sf)), shift)


@query
def snapshot_join(spark: SparkSession, sf: str) -> DataFrame:
    facts = hr.attendance(spark, sf).select("empid", "date", "value1")
    return wide.join_snapshot(facts, hr.snapshots(spark, sf))


@query
def snapshot_join_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """The join of ``snapshot_join`` with people stored as intervals."""
    people = hr.snapshots(spark, sf)
    pulls = intervals.pulls_of(people)
    packed = intervals.compress(wide.people_of_days(people).select(
        F.col("_person").alias("empid"), F.col("_person_day").alias("date"), "empdept", *schemas.EMPLOYEE_COLUMNS), pulls)
    facts = hr.attendance(spark, sf).select("empid", "date", "value1")
    return intervals.join_as_of(facts, packed, pulls, ["empid"])


@query
def known_member_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.known_members(snapshot_join(spark, sf))


@query
def org_name_fallback(spark: SparkSession, sf: str) -> DataFrame:
    members = hr.people(spark, sf).select("empid", "empdept")
    records = members.join(
        wide.clean_departments(hr.departments(spark, sf)),
        F.col("empdept") == F.col("deptcode"), "left",
    ).select("empid", "deptcode", "deptnamel1", "deptnamel2")
    return wide.org_name_fallback(records, _org(spark, sf), root="root")


@query
def narrow_view(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'narrow')}.narrow"
    tables.full_overwrite(wide.narrow_view(_wide(spark, sf)), target)
    return spark.table(target)


# --- filters and small projections -------------------------------------------

@query
def date_window_filter(spark: SparkSession, sf: str) -> DataFrame:
    facts = filters.look_back(hr.attendance(spark, sf), TODAY, 50)
    signed = filters.look_back(hr.cards(spark, sf), TODAY, 50, column="signdate")
    return facts.select(F.lit("fact").alias("kind"), "empid", "date").unionByName(
        signed.select(F.lit("card").alias("kind"), "empid", F.col("signdate").alias("date"))
    )


@query
def one_day_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.one_day(_event_days(spark, sf), TODAY)


@query
def open_ended_filter(spark: SparkSession, sf: str) -> DataFrame:
    return filters.open_ended(_event_days(spark, sf), LATER_TODAY)


@query
def blank_to_null(spark: SparkSession, sf: str) -> DataFrame:
    people = hr.people(spark, sf).select("empid", "empdept")
    levels = people.join(
        hr.departments(spark, sf), F.col("empdept") == F.col("deptcode"), "left"
    )
    return levels.select(
        "empid", *[text.blank_to_null(F.col(c)).alias(c) for c in schemas.LEVEL_COLUMNS]
    )


@query
def normalize_code(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("event_type")
    coded = hr.table(spark, sf, "events").select(
        "event_id",
        F.when(kind == "click", "norm ").when(kind == "view", "Norm  ")
        .when(kind != "error", kind).alias("shiftcode"),
    )
    return text.normalize_code(coded)


def _pending(spark: SparkSession, sf: str) -> DataFrame:
    """Orders under the headings of the pending-leave form."""
    headings = list(filters.PENDING_LEAVE_HEADINGS)
    o = hr.table(spark, sf, "orders")
    columns = [
        F.lit("c1"), F.col("o_orderstatus"), F.col("o_orderpriority"), hr.text("o_custkey"),
        F.concat(F.lit("m"), hr.text("o_custkey")), dates.day_key("o_orderdate"),
        dates.day_key(F.date_add("o_orderdate", 3)), hr.text("o_orderkey"),
    ]
    return o.select(*[c.alias(h) for c, h in zip(columns, headings)], F.col("o_totalprice").alias("hours"))


@query
def rename_map(spark: SparkSession, sf: str) -> DataFrame:
    return filters.rename_headings(_pending(spark, sf)).drop("hours")


def _conditions():
    department = F.col("HR部门")
    return department == "P", (department != "F") & (F.col("hours") > 250000)


@query
def union_of_filters(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.union_of_filters(_pending(spark, sf), *_conditions())
    return filters.rename_headings(rows).select("leavecode", "deptcode", "hours")


@query
def or_filter(spark: SparkSession, sf: str) -> DataFrame:
    rows = filters.any_filter(_pending(spark, sf), *_conditions())
    return filters.rename_headings(rows).select("leavecode", "deptcode", "hours")


@query
def preview(spark: SparkSession, sf: str) -> DataFrame:
    return filters.preview(hr.table(spark, sf, "orders"), "o_orderkey")


# --- table maintenance ---------------------------------------------------------

def _event_days(spark: SparkSession, sf: str) -> DataFrame:
    return hr.table(spark, sf, "events").select(
        "event_id", "event_type", "value", dates.day_key("ts").alias("date")
    )


def _stale(events: DataFrame) -> DataFrame:
    """What an earlier load left behind: every event, with old values."""
    return events.withColumns({"event_type": F.lit("stale"), "value": F.lit(0.0)})


def _fresh(events: DataFrame) -> DataFrame:
    """The source as it is now: one day has no rows any more."""
    return events.where(F.col("date") != EMPTIED_DAY)


def _day_table(spark: SparkSession, sf: str, label: str) -> tuple[str, DataFrame]:
    """A table of stale events by day, and the fresh events."""
    target = f"{scratch_database(spark, label)}.events"
    events = _event_days(spark, sf)
    tables.full_overwrite(_stale(events), target, ["date"])
    return target, _fresh(events)


@query
def aligned_append(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "append")
    reordered = fresh.select("date", "value", F.lit("x").alias("extra"), "event_type", "event_id")
    tables.append(reordered, target)
    return spark.table(target)


@query
def full_overwrite(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'overwrite')}.target"
    tables.full_overwrite(hr.table(spark, sf, "part"), target)
    tables.full_overwrite(hr.table(spark, sf, "customer"), target)
    return spark.table(target)


@query
def full_refresh(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "refresh")
    tables.full_refresh(fresh, target)
    return spark.table(target)


@query
def full_refresh_typed_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Partition keys that come in other types than the table's, or blank."""
    target = f"{scratch_database(spark, 'refresh_typed')}.lines"
    lines = hr.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_linestatus", F.year("l_shipdate").alias("year"),
        F.col("l_returnflag").alias("flag"), F.to_date("l_shipdate").alias("shipped"),
    )
    columns = ["l_orderkey", "l_linenumber", "l_linestatus", "year", "flag"]
    tables.full_overwrite(lines.select(columns).withColumn("l_linestatus", F.lit("stale")), target, ["year", "flag"])
    fresh = lines.select(
        "l_orderkey", "l_linenumber", "l_linestatus", F.col("year").cast("decimal(12,2)").alias("year"),
        F.when(F.col("flag") == "N", "").otherwise(F.col("flag")).alias("flag"),
    )
    tables.full_refresh(fresh, target)
    return spark.table(target)


@query
def replace_all_rows(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'replace_all')}.customer"
    customers = hr.table(spark, sf, "customer")
    tables.full_overwrite(customers.withColumn("c_acctbal", F.lit(-1.0)), target)
    # A new set without one segment, so that rows of the old set have to go.
    tables.replace_all_rows(customers.where(F.col("c_mktsegment") != "BUILDING"), target)
    return spark.table(target)


@query
def partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "replace")
    tables.replace_days(fresh, target, "date", TODAY, 32)
    return spark.table(target)


@query
def partition_replace_recovered(spark: SparkSession, sf: str) -> DataFrame:
    """The window replaced by a job that broke off, behind one that broke off before it had rows."""
    target, fresh = _day_table(spark, sf, "recovered")
    window = [(d,) for d in dates.last_n_day_texts(TODAY, 32)]
    journal.stage(_stale(fresh).withColumn("event_type", F.lit("lost")), target, journal.begin(spark, target))
    entry = journal.begin(spark, target)
    rows = fresh.where(F.col("date").isin([d for d, in window])).select(spark.table(target).columns)
    staged = journal.stage(rows, target, entry)
    journal.prepare(spark, target, entry, ["date"], staged, window)
    journal.recover(spark, target)
    return spark.table(target)


@query
def partition_replace_one_day(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "one_day")
    tables.replace_one_day(fresh, target, "date", TODAY)
    return spark.table(target)


@query
def current_day_refresh(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "current_day")
    tables.replace_current_day(fresh, target, "date", TODAY)
    return spark.table(target)


@query
def current_day_refresh_stream(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "stream")
    item = fresh.schema
    landing = workspace(spark, "pulls")
    pages.land_pages(_stale(fresh), f"{landing}/pull=1", "event_id")
    pages.land_pages(fresh, f"{landing}/pull=2", "event_id")
    stream_current_day(
        spark, landing, item, target, "date", TODAY, workspace(spark, "stream-state")
    ).awaitTermination()
    return spark.table(target)


@query
def current_day_refresh_offsets(spark: SparkSession, sf: str) -> DataFrame:
    """The day refreshed by a stream of pulls, one of which lands late and one breaks off."""
    target, fresh = _day_table(spark, sf, "offsets")
    landing, state = workspace(spark, "offset-pulls"), workspace(spark, "offset-state")

    def land(pull: int, rows: DataFrame) -> None:
        pages.land_pages(rows, f"{landing}/pull={pull}", "event_id")

    def run() -> None:
        stream_pulls(spark, landing, fresh.schema, target, "date", TODAY, state).awaitTermination()

    land(3, _stale(fresh))
    run()
    land(7, fresh)
    land(8, _stale(fresh))
    catalog.delete(spark, f"{landing}/pull=8/_SUCCESS")
    run()
    land(5, _stale(fresh))
    run()
    return spark.table(target)


@query
def current_day_refresh_two_pulls(spark: SparkSession, sf: str) -> DataFrame:
    """The day refreshed after each of three pulls; only the newest one counts."""
    target, fresh = _day_table(spark, sf, "two_pulls")
    landing = workspace(spark, "two-pulls")
    for pull, rows in (("002", fresh), ("9", _stale(fresh)), ("010", fresh)):
        pages.land_pages(rows, f"{landing}/pull={pull}", "event_id")
        newest = pages.read_pages(spark, pages.newest_pull(spark, landing), fresh.schema)
        tables.replace_current_day(newest, target, "date", TODAY)
    return spark.table(target)


@query
def observed_partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "observed")
    tables.replace_observed(fresh, target, "date", LATER_TODAY)
    return spark.table(target)


@query
def month_partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'months')}.roster"
    roster = hr.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderstatus", dates.month_key("o_orderdate").alias("ym")
    )
    tables.full_overwrite(roster.withColumn("o_orderstatus", F.lit("stale")), target, ["ym"])
    fresh = roster.where(F.col("ym") != EMPTIED_MONTH)
    tables.replace_months(fresh, target, "ym", MONTH_TODAY)
    return spark.table(target)


@query
def range_backfill(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "range")
    tables.backfill_days(fresh, target, "date", dt.date(2024, 1, 10), dt.date(2024, 1, 20))
    return spark.table(target)


@query
def month_range_backfill(spark: SparkSession, sf: str) -> DataFrame:
    target, fresh = _day_table(spark, sf, "month_range")
    tables.backfill_months(fresh, target, "date", dt.date(2023, 11, 20), dt.date(2024, 1, 22))
    return spark.table(target)


def _snapshot_table(spark: SparkSession, sf: str, label: str) -> tuple[str, DataFrame]:
    """A snapshot table with stale copies of yesterday and today, and the people now."""
    target = f"{scratch_database(spark, label)}.snapshot"
    people = hr.people(spark, sf)
    stale = tables.repeat_per_day(people, TODAY - dt.timedelta(days=1), TODAY)
    tables.full_overwrite(stale.withColumn("empname", F.lit("stale")), target, ["date"])
    return target, people


@query
def snapshot_stamp(spark: SparkSession, sf: str) -> DataFrame:
    target, people = _snapshot_table(spark, sf, "stamp")
    tables.write_snapshot(people, target, TODAY)
    return spark.table(target)


@query
def snapshot_backfill(spark: SparkSession, sf: str) -> DataFrame:
    target, people = _snapshot_table(spark, sf, "snapshots")
    tables.backfill_snapshot(people, target, TODAY, TODAY + dt.timedelta(days=6))
    return spark.table(target)


@query
def snapshot_intervals(spark: SparkSession, sf: str) -> DataFrame:
    """The days of ``snapshot_backfill`` but one, stored as intervals, the last two pull by pull."""
    days = snapshot_backfill(spark, sf).where(F.col("date") != dates.day_text(NO_PULL))
    target = f"{scratch_database(spark, 'intervals')}.staff"
    last = [dates.day_text(TODAY + dt.timedelta(days=d)) for d in (5, 6)]
    intervals.create(days.where(F.col("date") < last[0]), target)
    for day in last:
        intervals.add_pull(days.where(F.col("date") == day).drop("date"), target, day)
    return intervals.expand(spark.table(target), spark.table(f"{target}_pulls"))


def _derived(spark: SparkSession, sf: str, source: DataFrame, spec: str) -> DataFrame:
    grain = spec.rpartition("-")[2]
    target = f"{scratch_database(spark, 'derived_' + grain)}.target"
    _, names = tables.derived_partition_names(spec)
    tables.full_overwrite(tables.with_derived_partitions(source, spec), target, names)
    return spark.table(target)


@query
def derived_partitions_year(spark: SparkSession, sf: str) -> DataFrame:
    return _derived(spark, sf, hr.table(spark, sf, "lineitem"), "l_shipdate-year")


@query
def derived_partitions_month(spark: SparkSession, sf: str) -> DataFrame:
    return _derived(spark, sf, hr.table(spark, sf, "orders"), "o_orderdate-month")


@query
def derived_partitions_day(spark: SparkSession, sf: str) -> DataFrame:
    return _derived(spark, sf, hr.table(spark, sf, "events"), "ts-day")


@query
def upsert_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """All customers; those with orders get a new balance, and a null key meets a null key."""
    target = f"{scratch_database(spark, 'upsert')}.balance"
    key = F.nullif(F.col("c_custkey"), F.lit(10)).alias("c_custkey")
    customers = hr.table(spark, sf, "customer").select(key, F.col("c_acctbal").alias("balance"))
    tables.full_overwrite(customers, target)
    changes = (
        hr.table(spark, sf, "orders")
        .groupBy(F.nullif(F.col("o_custkey"), F.lit(10)).alias("c_custkey"))
        .agg(F.sum(hr.money("o_totalprice")).cast("double").alias("balance"))
    )
    tables.upsert_table(changes, target, ["c_custkey"])
    return spark.table(target)


@query
def upsert_merge_on_read(spark: SparkSession, sf: str) -> DataFrame:
    """The balances of ``upsert_by_key`` in three batches, the buckets compacted in between."""
    target = f"{scratch_database(spark, 'merge')}.balance"
    key = F.nullif(F.col("c_custkey"), F.lit(10)).alias("c_custkey")
    customers = hr.table(spark, sf, "customer").select(key, F.col("c_acctbal").alias("balance"))
    merge_on_read.create(customers, target, ["c_custkey"], buckets=8)
    changes = (
        hr.table(spark, sf, "orders")
        .groupBy(F.nullif(F.col("o_custkey"), F.lit(10)).alias("c_custkey"))
        .agg(F.sum(hr.money("o_totalprice")).cast("double").alias("balance"))
    )
    half = F.coalesce(F.col("c_custkey"), F.lit(0)) % 2 == 0
    merge_on_read.write(changes.withColumn("balance", F.lit(-1.0)), target, deleted=half)
    merge_on_read.compact(spark, target)
    merge_on_read.write(changes.where(half), target)
    merge_on_read.write(changes.where(~half), target)
    return merge_on_read.read(spark, target)


# --- incremental loads ---------------------------------------------------------

_CUT = "2000-01-01"


@query
def delta_watermark(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.watermark_text(hr.table(spark, sf, "events"), "ts")


@query
def partition_row_count(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.partition_row_count(
        _event_days(spark, sf), "date", dates.day_text(TODAY)
    )


@query
def distinct_partitions(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.distinct_partitions(_event_days(spark, sf), "date")


def _orders_before(spark: SparkSession, sf: str) -> DataFrame:
    return hr.table(spark, sf, "orders").where(F.col("o_orderdate") < F.lit(_CUT).cast("timestamp_ntz"))


@query
def delta_t0(spark: SparkSession, sf: str) -> DataFrame:
    return incremental.delta(
        hr.table(spark, sf, "orders"), _orders_before(spark, sf),
        [("o_orderdate", "o_orderdate")], "T0",
    )


@query
def delta_t0_from_statistics(spark: SparkSession, sf: str) -> DataFrame:
    """T0 beyond a target that has lost its last years and got some months of them back."""
    target = f"{scratch_database(spark, 'statistics')}.orders"
    orders = tables.with_derived_partitions(hr.table(spark, sf, "orders"), "o_orderdate-year")
    tables.full_overwrite(orders.where("year < 2000"), target, ["year"])
    statistics.track(spark, target, ["o_orderdate", "o_orderkey"])
    tables.replace_partitions(orders.where("year < 1998"), target, "year", [str(y) for y in range(1997, 2000)])
    tables.append(orders.where("year = 1998 and month(o_orderdate) <= 3"), target)
    marks = incremental.table_watermarks(spark, target, ["o_orderdate"])
    return incremental.newer_than_target(
        hr.table(spark, sf, "orders"), spark.table(target), [("o_orderdate", "o_orderdate")], marks
    )


@query
def delta_t1(spark: SparkSession, sf: str) -> DataFrame:
    events = hr.table(spark, sf, "events")
    return incremental.delta(events, events, [("ts", "ts")], "T1", today=TODAY)


@query
def delta_range(spark: SparkSession, sf: str) -> DataFrame:
    lines = hr.table(spark, sf, "lineitem")
    return incremental.delta(
        lines, lines, [("l_shipdate", "l_shipdate")], "",
        begin=dt.datetime(1997, 1, 1), finish=dt.datetime(1998, 1, 1),
    )


@query
def delta_resume_by_count(spark: SparkSession, sf: str) -> DataFrame:
    """By order and customer; one customer's key is null on both sides."""
    customer = {"o_custkey": F.nullif(F.col("o_custkey"), F.lit(10))}
    return incremental.not_yet_loaded(
        hr.table(spark, sf, "orders").withColumns(customer), _orders_before(spark, sf).withColumns(customer),
        ["o_orderkey", "o_custkey"],
    )


@query
def load_full(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'load_full')}.orders"
    incremental.load(_orders_before(spark, sf), target, "full")
    incremental.load(hr.table(spark, sf, "orders"), target, "full")
    return spark.table(target)


@query
def load_fullpart(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'load_fullpart')}.orders"
    incremental.load(hr.table(spark, sf, "orders"), target, "fullpart", "o_orderdate-year")
    return spark.table(target)


def _vendor_orders(orders: DataFrame) -> DataFrame:
    """Orders as a vendor system names and pads them."""
    return orders.select(
        F.col("o_orderkey").cast("string").alias("T$orderkey"),
        F.concat(F.lit("\t "), "o_orderstatus", F.lit(" \n")).alias("t$status"),
        F.when(F.col("o_orderpriority") == "5-LOW", " null ").otherwise(F.col("o_orderpriority"))
        .alias("order$priority"),
        F.col("o_orderdate").alias("T$DATE"),
    )


def _clean_orders(orders: DataFrame) -> DataFrame:
    return orders.select(
        F.col("o_orderkey").alias("orderkey"), F.col("o_orderstatus").alias("status"),
        F.col("o_orderpriority").alias("order_priority"), F.col("o_orderdate").alias("t_date"),
    )


@query
def load_delta(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'load_delta')}.orders"
    tables.full_overwrite(_clean_orders(_orders_before(spark, sf)), target)
    source = _vendor_orders(hr.table(spark, sf, "orders"))
    newer = incremental.newer_than_target(source, spark.table(target), [("T$DATE", "t_date")])
    incremental.load(newer, target, "delta")
    return spark.table(target)


@query
def load_delta_keyed(spark: SparkSession, sf: str) -> DataFrame:
    """A batch that repeats keys, into a keyed table of hash buckets: the newest row wins."""
    target = f"{scratch_database(spark, 'load_keyed')}.latest_order"
    orders = hr.table(spark, sf, "orders").select(
        F.col("o_custkey").alias("custkey"), F.col("o_orderkey").alias("orderkey"),
        F.col("o_orderstatus").alias("status"),
    )
    customers = hr.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("custkey"), F.lit(0).cast("bigint").alias("orderkey"),
        F.lit("none").alias("status"),
    )
    tables.keyed_table(customers, target, ["custkey"], buckets=8)
    incremental.load(orders, target, "delta", keys=["custkey"], latest_by="orderkey")
    return spark.table(target).drop(tables.KEY_BUCKET)


@query
def load_deltapart(spark: SparkSession, sf: str) -> DataFrame:
    target = f"{scratch_database(spark, 'load_deltapart')}.orders"
    old = tables.with_derived_partitions(_clean_orders(_orders_before(spark, sf)), "t_date-year")
    tables.full_overwrite(old, target, ["year"])
    source = _vendor_orders(hr.table(spark, sf, "orders"))
    newer = incremental.newer_than_target(source, spark.table(target), [("T$DATE", "t_date")])
    incremental.load(newer, target, "deltapart", "T$DATE-year")
    return spark.table(target)


# --- schema operators -----------------------------------------------------------

@query
def safe_union(spark: SparkSession, sf: str) -> DataFrame:
    left = hr.table(spark, sf, "events").select(F.col("event_id").alias("ID"), "ts", "user_id")
    right = hr.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("TS"),
        F.col("o_totalprice").alias("Price"),
    )
    return shape.safe_union(left, right)


@query
def safe_union_epoch(spark: SparkSession, sf: str) -> DataFrame:
    """Epochs of this decade, of the nineties and, 40 years earlier, before 1970."""
    left = hr.table(spark, sf, "events").select("event_id", F.explode(F.array(
        F.col("ts").cast("timestamp"), F.expr("timestamp(ts - interval 25 years)"),
        F.expr("timestamp(ts - interval 65 years)"),
    )).alias("at")).select(F.col("event_id").alias("id"), F.unix_millis("at").alias("ts"))
    right = hr.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.col("o_orderdate").alias("ts")
    )
    return shape.safe_union(left, right).withColumn("ts", F.date_format("ts", dates.TIME_FORMAT))


@query
def page_union_skip_empty(spark: SparkSession, sf: str) -> DataFrame:
    events = _event_days(spark, sf)
    empty = spark.createDataFrame([], T.StructType([]))
    by_type = [events.where(F.col("event_type") == t) for t in hr.EVENT_TYPES]
    by_type[1] = by_type[1].select(*reversed(events.columns))
    return shape.union_pages([empty, *by_type, empty])


@query
def sequential_id(spark: SparkSession, sf: str) -> DataFrame:
    return ids.sequential_id(hr.table(spark, sf, "events"), "row_id", "user_id", "event_id")


@query
def clean_schema_names(spark: SparkSession, sf: str) -> DataFrame:
    return shape.strip_names(hr.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("order,key"), F.col("o_orderstatus").alias("{status}"),
        F.col("o_totalprice").alias("price(total);"), F.col("o_orderdate").alias("order\tdate\n"),
    ))


@query
def lower_schema(spark: SparkSession, sf: str) -> DataFrame:
    source = hr.table(spark, sf, "customer")
    return shape.lower_names(source.toDF(*[c.upper() for c in source.columns]))


@query
def vendor_names(spark: SparkSession, sf: str) -> DataFrame:
    return shape.vendor_names(hr.table(spark, sf, "lineitem").select(
        F.col("l_shipdate").alias("T$DATE"), F.col("l_orderkey").alias("t$dates"),
        F.col("l_linenumber").alias("t$amt"), F.col("l_returnflag").alias("a$b"),
        F.col("l_linestatus").alias("amount$x"),
    ))


@query
def clean_string_values(spark: SparkSession, sf: str) -> DataFrame:
    return text.clean_text_columns(hr.table(spark, sf, "documents").select(
        "doc_id",
        "text",
        F.concat(F.lit("\t\u0001 "), "text", F.lit(" \u0001\r\n")).alias("padded"),
        F.when(F.col("lang") == "fr", " null\n").otherwise(F.col("source")).alias("source"),
    ))


@query
def raw_json_scrub(spark: SparkSession, sf: str) -> DataFrame:
    raw = F.concat(
        F.lit('{"t$user":" '), "lang", F.lit(' ","T$FULL":"'), "source",
        F.lit('  ","amt$x":"","t$body":" '), "text", F.lit('"}'),
    )
    return hr.table(spark, sf, "documents").select(
        "doc_id", text.scrub_json_text(raw).alias("scrubbed")
    )


@query
def cast_to_target(spark: SparkSession, sf: str) -> DataFrame:
    target = T.StructType([
        T.StructField("o_orderkey", T.StringType()),
        T.StructField("o_orderpriority", T.IntegerType()),
        T.StructField("o_orderdate", T.DateType()),
    ])
    return shape.cast_to_schema(hr.table(spark, sf, "orders"), target)


@query
def cast_by_type_map(spark: SparkSession, sf: str) -> DataFrame:
    return shape.cast_by_type_map(hr.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.to_date("l_shipdate").alias("shipped"), hr.money("l_extendedprice").alias("price"),
    ))


@query
def cast_by_type_name(spark: SparkSession, sf: str) -> DataFrame:
    lines = hr.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_returnflag"
    )
    return shape.cast_by_type_name(lines, {
        "l_orderkey": "string", "l_linenumber": "long", "l_quantity": "integer",
        "l_extendedprice": "decimal( 18, 2 )", "l_returnflag": "double",
    })


@query
def column_comments(spark: SparkSession, sf: str) -> DataFrame:
    """Every text is the comment of a column; a second column per document has none."""
    metadata = hr.table(spark, sf, "documents").select(
        F.upper("source").alias("table_name"), F.col("lang").alias("table_schema"),
        F.inline(F.array(
            F.struct(F.concat(F.lit("c"), hr.text("doc_id")).alias("column_name"),
                     F.col("text").alias("column_comment")),
            F.struct(F.concat(F.lit("n"), hr.text("doc_id")).alias("column_name"),
                     F.lit(None).cast("string").alias("column_comment")),
        )),
    )
    return shape.column_comments(metadata, "src1", owner="en")


# --- date ranges ------------------------------------------------------------------

def _order_spans(spark: SparkSession, sf: str) -> DataFrame:
    """First and last order day per customer."""
    return hr.table(spark, sf, "orders").groupBy("o_custkey").agg(
        F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high")
    )


@query
def date_series(spark: SparkSession, sf: str) -> DataFrame:
    length = F.substring("o_orderpriority", 1, 1).cast("int") - 2
    low = F.to_date("o_orderdate")
    days = hr.table(spark, sf, "orders").select(
        "o_orderkey", F.explode(dates.date_series(low, F.date_add(low, length))).alias("day")
    )
    return days.withColumn("day", dates.day_key("day"))


@query
def last_n_days(spark: SparkSession, sf: str) -> DataFrame:
    days = _order_spans(spark, sf).select(
        "o_custkey", F.explode(dates.last_n_days(F.col("high"), 32)).alias("day")
    )
    return days.withColumn("day", dates.day_key("day"))


@query
def month_series(spark: SparkSession, sf: str) -> DataFrame:
    return _order_spans(spark, sf).select(
        "o_custkey", F.explode(dates.month_series(F.col("low"), F.col("high"))).alias("ym")
    )


@query
def month_ranges(spark: SparkSession, sf: str) -> DataFrame:
    spans = _order_spans(spark, sf).select(
        "o_custkey", F.explode(dates.month_ranges(F.col("low"), F.col("high"))).alias("span")
    )
    return spans.select(
        "o_custkey", dates.date_text(F.col("span.start")).alias("start_date"),
        dates.date_text(F.col("span.end")).alias("end_date"),
    )


@query
def request_grid(spark: SparkSession, sf: str) -> DataFrame:
    """Request windows per company, a nation standing for one."""
    days = hr.table(spark, sf, "orders").join(
        hr.table(spark, sf, "customer"), F.col("o_custkey") == F.col("c_custkey")
    ).groupBy(F.col("c_nationkey").alias("company_id")).agg(
        F.to_date(F.min("o_orderdate")).alias("low"), F.to_date(F.max("o_orderdate")).alias("high")
    )
    grid = days.select(
        "company_id", F.explode(dates.request_windows(F.col("low"), F.col("high"))).alias("w")
    )
    return grid.select(
        "company_id", dates.day_key("w.from_date").alias("from_date"),
        dates.day_key("w.to_date").alias("to_date"),
    )


@query
def date_helpers(spark: SparkSession, sf: str) -> DataFrame:
    ts, day = F.col("ts"), F.to_date("ts")
    seconds = F.when(F.col("event_type") == "error", "").otherwise(
        hr.text(F.unix_seconds(ts.cast("timestamp")))
    )
    return hr.table(spark, sf, "events").select(
        "event_id",
        dates.date_text(day).alias("today"),
        dates.yesterday_text(day).alias("yesterday"),
        dates.tomorrow_text(day).alias("tomorrow"),
        dates.next_day_text(F.year(ts), F.month(ts), F.dayofmonth(ts)).alias("next_day"),
        dates.add_days_text(dates.day_key(ts), 59).alias("later_day"),
        dates.hour_text(ts).alias("hour"),
        dates.epoch_text(seconds).alias("clock"),
        dates.millis_between(ts, day).alias("millis"),
        F.date_format(
            dates.time_on_day(day, F.lit(7), F.lit(30), F.lit(5)), dates.TIME_FORMAT
        ).alias("start_time"),
    )


# --- sources ----------------------------------------------------------------------

def _event_items(spark: SparkSession, sf: str) -> DataFrame:
    return hr.table(spark, sf, "events").withColumn(
        "ts", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )


@query
def page_json_ingest(spark: SparkSession, sf: str) -> DataFrame:
    items = _event_items(spark, sf)
    landing = workspace(spark, "pages")
    pages.land_pages(items, landing, "event_id")
    return pages.read_pages(spark, landing, items.schema)


@query
def page_json_ingest_get(spark: SparkSession, sf: str) -> DataFrame:
    """The GET envelope, every row landed by two overlapping pulls."""
    items = _event_items(spark, sf)
    landing = workspace(spark, "get-pages")
    pages.land_pages(items, f"{landing}/first", "event_id", envelope="get")
    pages.land_pages(items, f"{landing}/second", "event_id", envelope="get", page_rows=700)
    return pages.read_pages(spark, f"{landing}/*", items.schema, envelope="get", distinct=True)


def _paged(spark: SparkSession, sf: str, envelope: str) -> DataFrame:
    items = _event_items(spark, sf).withColumn("date", F.substring("ts", 1, 10))
    landing = workspace(spark, f"paged-{envelope}")
    pages.land_requests(items, landing, "date", "event_id", envelope=envelope, page_rows=70)
    paged.register(spark)
    source = spark.read.format("paged").schema(items.schema).option("envelope", envelope)
    return source.option("page_rows", 70).option("group_pages", 3).load(landing)


@query
def paged_source(spark: SparkSession, sf: str) -> DataFrame:
    """Every day of the events, asked for page by page."""
    return _paged(spark, sf, "post")


@query
def paged_source_get(spark: SparkSession, sf: str) -> DataFrame:
    """The GET envelope; days outside the window are not asked for."""
    return _paged(spark, sf, "get").where(F.col("date").between("2024-01-10", "2024-01-20"))


@query
def page_count_check(spark: SparkSession, sf: str) -> DataFrame:
    """Pages whose count is right, too large, or not there; read back as declared and held."""
    items = _event_items(spark, sf)
    landing = workspace(spark, "page-counts")
    page = F.expr("(event_id - event_id % 500) div 500").alias("page")
    declared = F.expr("case page % 3 when 0 then size(items) when 1 then size(items) + 1 end")
    (
        items.groupBy(page).agg(F.array_sort(F.collect_list(F.struct(*items.columns))).alias("items"))
        .select(F.to_json(F.struct(declared.alias("count"), "items")).alias("value"))
        .write.text(landing)
    )
    return pages.page_counts(spark, landing, items.schema).groupBy("declared", "held", "complete").agg(
        F.count(F.lit(1)).alias("n_pages")
    )


PAGE = "(event_id - event_id % 500) div 500"


@query
def page_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    """One row per page: those of five kinds of pages that were loaded, and why the others were not."""
    items = _event_items(spark, sf)
    landing, side = workspace(spark, "quarantined-pages"), f"{scratch_database(spark, 'quarantine')}.side"
    target = side.replace(".side", ".events")
    quarantine.create_side_table(spark, side)
    whole = F.to_json(F.struct("page", F.size("items").alias("count"), "items"), {"ignoreNullFields": "false"})
    (
        items.groupBy(F.expr(PAGE).alias("page")).agg(F.array_sort(F.collect_list(F.struct(*items.columns))).alias("items"))
        .select(
            F.when(F.col("page") % 5 == 1, F.substring(whole, 1, 200))
            .when(F.col("page") % 5 == 2, F.regexp_replace(whole, '"count":', '"count":9'))
            .when(F.col("page") % 5 == 3, F.regexp_replace(whole, '"event_id":', '"event_id":"no ","was":'))
            .when(F.col("page") % 5 == 4, F.concat(F.lit('{"page":'), "page", F.lit(',"items":"none"}')))
            .otherwise(whole).alias("value")
        ).write.text(landing)
    )
    quarantine.load(
        spark, landing, items.schema, lambda rows: tables.full_overwrite(rows, target), side, "events", max_share=0.9
    )
    good = spark.table(target).groupBy(F.expr(PAGE).cast("long").alias("page")).agg(F.count(F.lit(1)).alias("n_rows"))
    bad = spark.table(side).select(
        F.regexp_extract("page", '"page":([0-9]+)', 1).cast("long").alias("page"), F.lit(0).cast("long").alias("n_rows"), "reason"
    )
    return good.withColumn("reason", F.lit("loaded")).unionByName(bad)


@query
def page_schema_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Three loads of events: the second brings new fields, the third loses one and retypes another."""
    items = _event_items(spark, sf)
    landing, target = workspace(spark, "drifting"), f"{scratch_database(spark, 'drift')}.events"
    kind = F.col("event_id") % 3
    first = items.where(kind == 0).select("event_id", "ts", "user_id")
    second = items.where(kind == 1).select("event_id", "ts", "user_id", "value", F.col("event_type").alias("kind"))
    third = items.where(kind == 2).select(
        "event_id", "value", F.when(F.col("user_id") % 2 == 0, F.concat(F.lit("u"), "user_id"))
        .otherwise(F.col("user_id").cast("string")).alias("user_id"))
    tables.full_overwrite(first.limit(0), target)
    for number, rows in enumerate((first, second, third)):
        pages.land_pages(rows, f"{landing}/{number}", "event_id")
        drift.load(spark, f"{landing}/{number}", target)
    return spark.table(target).withColumn("rescued", F.col("rescued")["user_id"])


@query
def landing_to_table(spark: SparkSession, sf: str) -> DataFrame:
    items = hr.table(spark, sf, "documents").select(
        F.col("doc_id").alias("doc,id"), F.col("text").alias("(text)"), F.col("lang").alias("lang;")
    )
    landing = workspace(spark, "landing")
    pages.land_pages(items, landing, "`doc,id`", page_rows=500)
    target = f"{scratch_database(spark, 'landing')}.documents"
    pages.landing_to_table(spark, landing, items.schema, target)
    return spark.table(target)


@query
def jdbc_slice_predicates(spark: SparkSession, sf: str) -> DataFrame:
    """Which slices of a JDBC read each row meets, by a decimal key: always exactly one."""
    met = [
        F.when(F.expr(p), F.lit(i))
        for i, p in enumerate(jdbc.slice_predicates("(nullif(o_custkey, 7) - 500 + 0.25)"))
    ]
    slices = F.array_compact(F.array(*met))
    return hr.table(spark, sf, "orders").select(
        "o_orderkey", F.size(slices).alias("n_slices"), F.element_at(slices, 1).alias("slice")
    )


@query
def jdbc_delta_condition(spark: SparkSession, sf: str) -> DataFrame:
    """The condition text a database gets for a delta range, run on the same rows here."""
    condition = jdbc.delta_condition(["ts"], *jdbc.day_before(TODAY))
    return hr.table(spark, sf, "events").where(condition)


TABLE_NAMES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


@query
def size_tier(spark: SparkSession, sf: str) -> DataFrame:
    counts = reduce(DataFrame.unionByName, [
        hr.table(spark, sf, name).agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("table_name", F.lit(name))
        for name in TABLE_NAMES
    ])
    return counts.withColumn("partitions", jdbc.size_tier(F.col("n_rows")))


# --- jobs ---------------------------------------------------------------------------

@query
def job_audit(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "audit")
    jobs.create_audit_table(spark, f"{db}.audit")
    orders = hr.table(spark, sf, "orders")

    def broken() -> None:
        raise ValueError("the source didn't answer")

    jobs.audited_load(spark, f"{db}.audit", "orders", lambda: tables.full_overwrite(orders, f"{db}.orders"))
    jobs.audited_load(spark, f"{db}.audit", "broken", broken)
    n_rows = spark.table(f"{db}.orders").agg(F.count(F.lit(1))).scalar()
    return spark.table(f"{db}.audit").select(
        "table_name", "status", "info", F.col("end_time").isNotNull().alias("ended"),
        F.when(F.col("table_name") == "orders", n_rows).alias("n_rows"),
    )


@query
def multi_table_load(spark: SparkSession, sf: str) -> DataFrame:
    db = scratch_database(spark, "many")
    jobs.create_audit_table(spark, f"{db}.audit")
    names = ["customer", "orders", "part", "lineitem"]

    def copy(name: str) -> Callable[[], object]:
        return lambda: tables.full_overwrite(hr.table(spark, sf, name), f"{db}.{name}")

    writers = {name: copy(name) for name in names}
    tables.full_overwrite(hr.table(spark, sf, "nation"), f"{db}.broken")
    writers["broken"] = lambda: tables.append(hr.table(spark, sf, "region"), f"{db}.broken")
    jobs.load_many(spark, f"{db}.audit", writers)
    counts = reduce(DataFrame.unionByName, [
        spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("n_rows"))
        .withColumn("table_name", F.lit(name))
        for name in names
    ])
    return spark.table(f"{db}.audit").select("table_name", "status").join(
        counts, "table_name", "left"
    )


@query
def dependent_loads(spark: SparkSession, sf: str) -> DataFrame:
    """Loads that need each other's tables: one base table fails, what needs it is skipped."""
    db = scratch_database(spark, "graph")
    jobs.create_audit_table(spark, f"{db}.audit")
    missing = hr.table(spark, sf, "part").select("p_partkey")

    def copy(name: str) -> Callable[[], object]:
        return lambda: tables.full_overwrite(hr.table(spark, sf, name), f"{db}.{name}")

    def joined(name: str, left: str, right: str, on: str) -> Callable[[], object]:
        return lambda: tables.full_overwrite(
            spark.table(f"{db}.{left}").join(spark.table(f"{db}.{right}"), F.expr(on)), f"{db}.{name}")

    tables.full_overwrite(hr.table(spark, sf, "part"), f"{db}.part")
    graph.load_dependent(spark, f"{db}.audit", {
        "open_items": graph.Load(joined("open_items", "items", "part", "l_partkey = p_partkey"), ["items", "part"]),
        "items": graph.Load(joined("items", "lineitem", "orders", "l_orderkey = o_orderkey"), ["lineitem", "orders"]),
        "buyers": graph.Load(joined("buyers", "orders", "customer", "o_custkey = c_custkey"), ["orders", "customer"]),
        "lineitem": graph.Load(copy("lineitem")), "orders": graph.Load(copy("orders")), "customer": graph.Load(copy("customer")),
        "part": graph.Load(lambda: tables.append(missing, f"{db}.part"), retries=1),
    })
    counts = reduce(DataFrame.unionByName, [
        spark.table(f"{db}.{name}").agg(F.count(F.lit(1)).alias("n_rows")).withColumn("table_name", F.lit(name))
        for name in ("lineitem", "orders", "customer", "items", "buyers")
    ])
    return spark.table(f"{db}.audit").select("table_name", "status").join(counts, "table_name", "left")

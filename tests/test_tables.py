import datetime as dt
from collections import Counter

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import catalog, tables

TODAY = dt.date(2024, 1, 10)


def key(day):
    return f"2024-01-{day:02d}T00:00:00"


def rows(spark, *items):
    return spark.createDataFrame(list(items), "id long, v string, date string")


def state(spark, table):
    return Counter((r["id"], r["v"], r["date"]) for r in spark.table(table).collect())


@pytest.fixture
def days(spark, db):
    """Old rows on the days 1 to 10."""
    table = f"{db}.days"
    tables.full_overwrite(rows(spark, *[(d, "old", key(d)) for d in range(1, 11)]), table, ["date"])
    return table


def test_window_replace(spark, days):
    fresh = rows(spark, (70, "new", key(7)), (71, "new", key(7)), (90, "new", key(9)), (10, "new", key(10)))
    for _ in range(2):
        tables.replace_days(fresh, days, "date", TODAY, 3)
        # Day 8 has no rows any more, day 10 is outside the window.
        assert state(spark, days) == Counter(
            [(d, "old", key(d)) for d in (1, 2, 3, 4, 5, 6, 10)]
            + [(70, "new", key(7)), (71, "new", key(7)), (90, "new", key(9))]
        )
    assert (key(8),) not in catalog.existing_partitions(spark, days)


def test_replace_with_nothing_empties_the_window(spark, days):
    tables.replace_days(rows(spark, (1, "x", key(1))).where("id > 5"), days, "date", TODAY, 2)
    assert {r["date"] for r in spark.table(days).collect()} == {key(d) for d in (1, 2, 3, 4, 5, 6, 7, 10)}


def test_replace_on_a_statically_empty_frame(spark, days):
    tables.replace_one_day(rows(spark, (1, "x", key(1))).where(F.lit(False)), days, "date", TODAY)
    assert (key(9),) not in catalog.existing_partitions(spark, days)
    assert spark.table(days).count() == 9


def test_one_day_and_current_day(spark, days):
    fresh = rows(spark, *[(d, "new", key(d)) for d in range(1, 11)])
    tables.replace_one_day(fresh, days, "date", TODAY)
    tables.replace_one_day(fresh, days, "date", TODAY, dt.date(2024, 1, 2))
    tables.replace_current_day(fresh, days, "date", TODAY)
    assert {r["id"] for r in spark.table(days).where("v = 'new'").collect()} == {2, 9, 10}


def test_observed_replace_keeps_days_without_rows(spark, days):
    fresh = rows(spark, (4, "new", key(4)), (6, "new", key(6)), (31, "new", key(31)))
    tables.replace_observed(fresh, days, "date", TODAY, days=5)
    assert {r["id"] for r in spark.table(days).where("v = 'new'").collect()} == {6, 31}
    assert spark.table(days).where("v = 'old'").count() == 9


def test_month_replace_takes_next_month_only_if_it_has_rows(spark, db):
    def months(table, next_month):
        old = [(i, "old", m) for i, m in enumerate(["202310", "202311", "202312", "202401", "202402"])]
        frame = spark.createDataFrame(old, "id long, v string, ym string")
        tables.full_overwrite(frame, table, ["ym"])
        new = [(9, "new", "202312")] + ([(8, "new", "202402")] if next_month else [])
        tables.replace_months(spark.createDataFrame(new, "id long, v string, ym string"), table, "ym", TODAY)
        return {(r["v"], r["ym"]) for r in spark.table(table).collect()}

    assert months(f"{db}.a", False) == {("old", "202310"), ("new", "202312"), ("old", "202402")}
    assert months(f"{db}.b", True) == {("old", "202310"), ("new", "202312"), ("new", "202402")}


def test_backfill_modes(spark, days):
    fresh = rows(spark, (2, "new", key(2)), (3, "new", key(3)), (9, "new", key(9)))
    low, high = dt.date(2024, 1, 2), dt.date(2024, 1, 4)
    for _ in range(2):
        tables.backfill_days(fresh, days, "date", low, high)
    assert spark.table(days).count() == 9
    for _ in range(2):
        tables.backfill_days(fresh, days, "date", low, high, mode="append")
    assert spark.table(days).count() == 13


def test_append_aligns_or_fails(spark, days):
    shuffled = rows(spark, (50, "new", key(5))).withColumn("extra", F.lit(1)).select("date", "extra", "v", "id")
    assert tables.append(shuffled, days)
    assert spark.table(days).where("v = 'new'").first()["id"] == 50
    with pytest.raises(ValueError, match="lacks"):
        tables.append(shuffled.drop("v"), days)


def test_frame_without_columns_is_skipped(spark, days):
    empty = spark.createDataFrame([], T.StructType([]))
    before = state(spark, days)
    assert not tables.append(empty, days)
    assert not tables.full_overwrite(empty, days)
    assert not tables.full_refresh(empty, days)
    assert not tables.replace_days(empty, days, "date", TODAY, 3)
    assert state(spark, days) == before


def test_full_refresh(spark, db, days):
    fresh = rows(spark, (3, "new", key(3)), (12, "new", key(12)))
    tables.full_refresh(fresh, days)
    assert state(spark, days) == Counter([(3, "new", key(3)), (12, "new", key(12))])
    flat = f"{db}.flat"
    tables.full_overwrite(rows(spark, (1, "a", "x")), flat)
    tables.full_refresh(fresh, flat)
    assert spark.table(flat).count() == 2


def test_refresh_from_itself(spark, db, days):
    tables.full_refresh(spark.table(days).where("id > 4").withColumn("v", F.lit("kept")), days, staged=True)
    assert {(r["id"], r["v"]) for r in spark.table(days).collect()} == {(d, "kept") for d in range(5, 11)}


def test_null_partition(spark, db):
    table = f"{db}.nulls"
    tables.full_overwrite(rows(spark, (1, "old", None), (2, "old", key(2))), table, ["date"])
    tables.full_refresh(rows(spark, (3, "new", None)), table)
    assert state(spark, table) == Counter([(3, "new", None)])
    tables.full_refresh(rows(spark, (4, "new", "it's")), table)
    assert state(spark, table) == Counter([(4, "new", "it's")])
    tables.full_refresh(rows(spark, (5, "new", "x")), table)
    assert state(spark, table) == Counter([(5, "new", "x")])


def test_snapshot_backfill_and_stamp(spark, db):
    table = f"{db}.snap"
    people = spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string")
    tables.full_overwrite(tables.stamp(people.limit(0), TODAY), table, ["date"])
    for _ in range(2):
        tables.backfill_snapshot(people, table, dt.date(2024, 1, 1), dt.date(2024, 1, 3))
        tables.write_snapshot(people, table, TODAY)
    counts = {r["date"]: r["count"] for r in spark.table(table).groupBy("date").count().collect()}
    assert counts == {key(d): 2 for d in (1, 2, 3, 10)}


def test_derived_partitions(spark):
    df = spark.sql("select timestamp_ntz'2024-02-29 10:00:00' ts")
    assert tuple(tables.with_derived_partitions(df, "ts-day").first())[1:] == (2024, 2, 29)
    with pytest.raises(ValueError, match="column-year"):
        tables.with_derived_partitions(df, "ts-week")


def test_upsert_twice_is_upsert_once(spark, db):
    table = f"{db}.keyed"
    tables.full_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), table)
    new = spark.createDataFrame([(2, "B"), (3, "C")], "id long, v string")
    for _ in range(2):
        tables.upsert_table(new, table, ["id"])
        assert {tuple(r) for r in spark.table(table).collect()} == {(1, "a"), (2, "B"), (3, "C")}


def test_upsert_latest_wins(spark):
    old = spark.createDataFrame([(1, "a", 0)], "id long, v string, n int")
    new = spark.createDataFrame([(1, "x", 1), (1, "y", 3), (1, "z", 2), (5, "w", 1)], "id long, v string, n int")
    found = {tuple(r) for r in tables.upsert(old, new, ["id"], latest_by="n").collect()}
    assert found == {(1, "y", 3), (5, "w", 1)}


def test_upsert_rewrites_only_touched_partitions(spark, days):
    files = {f for f in spark.table(days).inputFiles() if "2024-01-05" not in f}
    tables.upsert_table(rows(spark, (5, "new", key(5)), (55, "new", key(5))), days, ["id", "date"])
    assert files <= set(spark.table(days).inputFiles())
    assert {tuple(r) for r in spark.table(days).where(F.col("date") == key(5)).collect()} == {
        (5, "new", key(5)), (55, "new", key(5))}
    assert spark.table(days).count() == 11


def test_hot_day_is_written_by_several_tasks(spark, db):
    table = f"{db}.hot"
    hot = spark.range(200_000).select(
        "id", F.md5(F.col("id").cast("string")).alias("v"),
        F.when(F.col("id") % 3 == 0, key(9)).otherwise(F.concat(F.lit("2024-01-"), F.col("id") % 9 + 10)).alias("date"),
    )
    tables.full_overwrite(hot.limit(0), table, ["date"])
    size = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    spark.conf.set(size, "500k")
    try:
        tables.replace_partitions(hot, table, "date", [key(9)])
    finally:
        spark.conf.unset(size)
    files = spark.table(table).inputFiles()
    assert len(files) > 3
    assert spark.table(table).count() == hot.where(F.col("date") == key(9)).count()


def test_upsert_keeps_the_rest_of_a_null_partition(spark, db):
    table = f"{db}.nulls"
    tables.full_overwrite(rows(spark, (1, "old", None), (2, "old", key(2))), table, ["date"])
    tables.upsert_table(rows(spark, (3, "new", None)), table, ["id", "date"])
    assert state(spark, table) == Counter([(1, "old", None), (2, "old", key(2)), (3, "new", None)])


def test_refresh_of_derived_partitions(spark, db):
    table = f"{db}.derived"

    def dated(*texts):
        df = spark.createDataFrame([(t,) for t in texts], "t string").select(F.col("t").cast("date").alias("d"))
        return tables.with_derived_partitions(df, "d-month")

    tables.full_overwrite(dated("2023-12-01", "2024-01-01", "2024-02-01"), table, ["year", "month"])
    tables.full_refresh(dated("2024-01-05", "2024-11-06"), table)
    assert catalog.existing_partitions(spark, table) == {("2024", "1"), ("2024", "11")}
    assert {str(r["d"]) for r in spark.table(table).collect()} == {"2024-01-05", "2024-11-06"}


@pytest.mark.parametrize("kind, values", [
    ("decimal(12,2)", ["2023", "2024"]), ("double", ["2023", "2024"]), ("string", ["2023", "2024"]),
])
def test_refresh_with_keys_of_another_type(spark, db, kind, values):
    table = f"{db}.years"
    tables.full_overwrite(spark.createDataFrame([(0, 2022), (0, 2023)], "id long, year int"), table, ["year"])
    fresh = spark.createDataFrame([(i, v) for i, v in enumerate(values, 1)], "id long, year string").select(
        "id", F.col("year").cast(kind).alias("year"))
    tables.full_refresh(fresh, table)
    assert sorted(tuple(r) for r in spark.table(table).collect()) == [(1, 2023), (2, 2024)]


@pytest.mark.parametrize("kind, texts", [
    ("date", ["2024-01-01", "2024-02-01"]), ("timestamp", ["2024-01-01 00:00:00", "2024-02-01 10:30:00"]),
])
def test_refresh_with_dates_and_times_as_keys(spark, db, kind, texts):
    table = f"{db}.moments"
    rows = spark.createDataFrame(list(enumerate(texts)), "id long, at string")
    tables.full_overwrite(rows.select("id", F.col("at").cast(kind).alias("at")), table, ["at"])
    tables.full_refresh(rows, table)
    assert sorted(r["id"] for r in spark.table(table).collect()) == [0, 1]


def test_blank_keys_are_the_null_partition(spark, db):
    table = f"{db}.blanks"
    rows = spark.createDataFrame([(1, ""), (2, "a"), (3, None)], "id long, k string")
    tables.full_overwrite(rows.select("id", F.lit("old").alias("k")), table, ["k"])
    for _ in range(2):
        tables.full_refresh(rows, table)
        assert sorted((r["id"], r["k"]) for r in spark.table(table).collect()) == [(1, None), (2, "a"), (3, None)]


def test_a_manifest_that_cannot_be_written_drops_nothing(spark, days, monkeypatch):
    def broken(*_):
        raise OSError("gone")

    fresh = rows(spark, (90, "new", key(9)))
    before = state(spark, days)
    with monkeypatch.context() as m:
        m.setattr(catalog, "existing_partitions", broken)
        with pytest.raises(OSError):
            tables.full_refresh(fresh, days)
    assert state(spark, days) == before
    tables.full_refresh(fresh, days)
    assert state(spark, days) == Counter([(90, "new", key(9))])


def test_many_partitions_are_dropped_in_parts(spark, days, monkeypatch):
    monkeypatch.setattr(catalog, "AT_ONCE", 3)
    tables.full_refresh(rows(spark, (1, "new", key(1))), days)
    assert state(spark, days) == Counter([(1, "new", key(1))])


def test_null_keys_are_keys(spark, db):
    table = f"{db}.pairs"
    old = spark.createDataFrame([(1, None, "old"), (1, 2, "old")], "a long, b long, v string")
    new = spark.createDataFrame([(1, None, "new")], old.schema)
    tables.full_overwrite(old, table)
    for _ in range(2):
        tables.upsert_table(new, table, ["a", "b"])
        assert Counter(map(tuple, spark.table(table).collect())) == Counter([(1, None, "new"), (1, 2, "old")])


def test_repeated_key_needs_an_order(spark, db):
    table = f"{db}.keyed"
    tables.full_overwrite(spark.createDataFrame([(1, 0)], "k long, at long"), table)
    twice = spark.createDataFrame([(1, 1), (1, 2)], "k long, at long")
    with pytest.raises(ValueError, match="more than once"):
        tables.upsert_table(twice, table, ["k"])
    tables.upsert_table(twice, table, ["k"], latest_by="at")
    assert [tuple(r) for r in spark.table(table).collect()] == [(1, 2)]


def test_upsert_rewrites_touched_buckets_only(spark, db):
    table = f"{db}.buckets"
    tables.keyed_table(spark.range(1000).select("id", F.lit("old").alias("v")), table, ["id"], 16)
    files = lambda: {r.f for r in spark.table(table).select(F.input_file_name().alias("f")).collect()}
    before = files()
    tables.upsert_table(spark.createDataFrame([(5, "new"), (5000, "new")], "id long, v string"), table, ["id"])
    kept = before & files()
    assert 14 <= len({f.split("key_bucket=")[1].split("/")[0] for f in kept})
    assert spark.table(table).where("v = 'new'").count() == 2 and spark.table(table).count() == 1001


def test_months_read_the_source_once(spark, db):
    table = f"{db}.once"
    reads = spark.sparkContext.accumulator(0)
    rows_ = spark.createDataFrame([(1, "202312"), (2, "202401")], "id long, ym string")
    tables.full_overwrite(rows_, table, ["ym"])

    def seen(batches):
        for batch in batches:
            reads.add(batch.num_rows)
            yield batch

    tables.replace_months(rows_.mapInArrow(seen, rows_.schema), table, "ym", TODAY)
    assert reads.value == 2

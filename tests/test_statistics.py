"""Statistics beside a table: always what a scan would say, mostly without one."""

import pytest
from pyspark.sql import functions as F

from daybook.operators import catalog, incremental, journal, statistics, tables


def day(d):
    return f"2024-01-{d:02d}"


def rows(spark, days, per_day=4, shift=0):
    """Ids and times that grow with the day; nulls among them."""
    items = [
        (100 * d + i + shift, None if i == 3 else f"{day(d)} 10:00:0{i}.{shift:06d}", day(d)) for d in days for i in range(per_day)
    ]
    return spark.createDataFrame(items, "id long, ts string, date string").withColumn("ts", F.col("ts").cast("timestamp_ntz"))


@pytest.fixture
def table(spark, db):
    name = f"{db}.events"
    tables.full_overwrite(rows(spark, [1, 2, 3]), name, ["date"])
    statistics.track(spark, name, ["id", "ts"])
    return name


def agrees(spark, table):
    scanned = incremental.watermarks(spark.table(table), ["id", "ts"])
    assert incremental.table_watermarks(spark, table, ["id", "ts"]) == scanned
    return scanned


def counts_agree(spark, table):
    keys = catalog.partition_columns(spark, table)
    held = spark.table(table).groupBy(*keys).count().collect()
    expected = {tuple(catalog.NULL_PARTITION if r[k] is None else str(r[k]) for k in keys): r["count"] for r in held}
    assert statistics.row_counts(spark, table) == expected


@pytest.fixture
def scans(monkeypatch):
    """Partitions that were measured again."""
    found = []
    whole = statistics.refresh

    def refresh(*args, **options):
        parts = whole(*args, **options)
        found.extend(sorted(parts))
        return parts

    monkeypatch.setattr(statistics, "refresh", refresh)
    return found


def test_first_measure(spark, table, scans):
    assert agrees(spark, table) == {"id": "303", "ts": "2024-01-03 10:00:02"}
    counts_agree(spark, table)
    assert scans == []


def test_replacements_carry_their_statistics(spark, table, scans):
    tables.replace_partitions(rows(spark, [2, 4], shift=50), table, "date", [day(2), day(3), day(4)])
    assert agrees(spark, table)["id"] == "453"
    tables.replace_partitions(rows(spark, []), table, "date", [day(4)])
    assert agrees(spark, table)["id"] == "253"
    counts_agree(spark, table)
    tables.full_refresh(rows(spark, [1]), table)
    assert agrees(spark, table)["id"] == "103"
    assert scans == []


def test_appends_are_observed(spark, table, scans):
    tables.append(rows(spark, [3], shift=7), table)
    tables.append(rows(spark, [3, 5], shift=20), table)
    assert agrees(spark, table) == {"id": "523", "ts": "2024-01-05 10:00:02.00002"}
    assert scans == []
    counts_agree(spark, table)  # an append to two days does not say how many of each
    assert scans == [(day(3),), (day(5),)]
    agrees(spark, table)
    assert scans == [(day(3),), (day(5),)]


def test_half_of_an_append_replaced(spark, table, scans):
    tables.append(rows(spark, [3, 4, 5], shift=20), table)
    tables.replace_partitions(rows(spark, [5], per_day=1), table, "date", [day(5)])
    assert agrees(spark, table)["id"] == "500"
    assert scans == [(day(3),), (day(4),)]  # days 1, 2 and 5 are certain
    counts_agree(spark, table)


def test_chains_of_appends(spark, table, scans):
    tables.append(rows(spark, [3, 4]), table)
    tables.append(rows(spark, [4, 5]), table)
    tables.append(rows(spark, [6, 7]), table)
    tables.replace_partitions(rows(spark, []), table, "date", [day(5)])
    assert agrees(spark, table)["id"] == "703"
    assert scans == [(day(3),), (day(4),)]  # what was appended to 6 and 7 is certain


def test_drops_by_hand_are_noticed(spark, table, scans):
    tables.append(rows(spark, [4, 5]), table)
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (date = '{day(5)}')")
    assert agrees(spark, table)["id"] == "403"
    assert scans == [(day(4),)]
    spark.sql(f"ALTER TABLE {table} DROP PARTITION (date = '{day(4)}')")
    assert agrees(spark, table)["id"] == "303"
    counts_agree(spark, table)


def test_partitions_added_by_hand_are_measured(spark, table, scans):
    rows(spark, [9]).write.insertInto(table)
    assert agrees(spark, table)["id"] == "903"
    assert scans == [(day(9),)]


def test_recovered_replacements_are_recorded_once(spark, table, monkeypatch, scans):
    for function in ("add_partitions", "drop_partitions"):
        with monkeypatch.context() as m:
            m.setattr(catalog, function, lambda *_: (_ for _ in ()).throw(OSError("gone")))
            with pytest.raises(OSError):
                journal.replace(rows(spark, [8], shift=9), table, ["date"], [(day(3),)])
        journal.recover(spark, table)
        assert agrees(spark, table)["id"] == "812"
        counts_agree(spark, table)
    assert scans == []


def test_no_data_file_of_the_target_is_read(spark, table):
    tables.append(rows(spark, [4, 5]), table)
    source = rows(spark, [5, 6], shift=2)
    place = catalog.location(spark, table)
    expected = incremental.newer_than_target(source, spark.table(table), [("ts", "ts")])
    expected_ids = sorted(r["id"] for r in expected.collect())
    # With every data file gone a scan would fail; the catalog and the statistics stay.
    for folder in catalog.folder_names(spark, place):
        catalog.delete(spark, f"{place}/{folder}")
    spark.catalog.refreshTable(table)
    marks = incremental.table_watermarks(spark, table, ["ts"])
    newer = incremental.newer_than_target(source, spark.table(table), [("ts", "ts")], marks)
    text = newer._jdf.queryExecution().executedPlan().toString()
    assert table not in text and "2024-01-05 10:00:02" in text
    assert sorted(r["id"] for r in newer.collect()) == expected_ids != []


def test_tables_without_partitions(spark, db, scans):
    name = f"{db}.plain"
    tables.full_overwrite(rows(spark, [1]), name)
    statistics.track(spark, name, ["id", "ts"])
    tables.append(rows(spark, [2]), name)
    assert agrees(spark, name)["id"] == "203"
    assert statistics.row_counts(spark, name) == {(): 8}
    tables.full_refresh(rows(spark, [1]), name)
    assert agrees(spark, name)["id"] == "103"
    tables.full_refresh(rows(spark, []), name)
    assert agrees(spark, name) == {"id": None, "ts": None}
    assert statistics.row_counts(spark, name) == {}


def test_nulls_empty_tables_and_odd_keys(spark, db):
    name = f"{db}.odd"
    odd = rows(spark, [1, 2]).withColumn("date", F.when(F.col("id") < 200, F.col("date"))).withColumn("part", F.lit("a/b=c"))
    tables.full_overwrite(odd.select("id", "ts", "date", "part").limit(0), name, ["date", "part"])
    statistics.track(spark, name, ["id", "ts"])
    assert agrees(spark, name) == {"id": None, "ts": None}
    tables.append(odd, name)
    agrees(spark, name)
    counts_agree(spark, name)
    assert catalog.NULL_PARTITION in {p for part in statistics.row_counts(spark, name) for p in part}
    tables.append(odd.limit(0), name)
    agrees(spark, name)


def test_untracked_columns_are_scanned(spark, table):
    assert incremental.table_watermarks(spark, table, ["date"]) == {"date": day(3)}
    with pytest.raises(ValueError, match="does not track"):
        statistics.watermarks(spark, table, ["date"])
    with pytest.raises(ValueError, match="no columns"):
        statistics.track(spark, table, ["nothing"])


def test_numbers_and_decimals_compare_as_such(spark, db):
    name = f"{db}.numbers"
    df = spark.createDataFrame([(9, "9.5", "a"), (10, "10.25", "b")], "n int, x string, part string").withColumn("x", F.col("x").cast("decimal(10,2)"))
    tables.full_overwrite(df, name, ["part"])
    statistics.track(spark, name, ["n", "x"])
    assert statistics.watermarks(spark, name, ["n", "x"]) == {"n": "10", "x": "10.25"}

"""Replacements that break off at every step, and what the next run makes of them."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.operators import catalog, journal, tables

DAYS = [(f"2024-01-0{d}T00:00:00",) for d in range(1, 6)]


def day(d):
    return f"2024-01-0{d}T00:00:00"


def old_rows(spark):
    return spark.range(50).select(
        "id", F.lit("old").alias("v"), F.concat(F.lit("2024-01-0"), F.col("id") % 5 + 1, F.lit("T00:00:00")).alias("date")
    )


def new_rows(spark):
    """Days 2 to 4, but no row of day 3."""
    return old_rows(spark).withColumn("v", F.lit("new")).where(F.col("date").isin(day(2), day(4)))


WINDOW = [(day(2),), (day(3),), (day(4),)]


def held(spark, table):
    return Counter((r["date"][:10], r["v"]) for r in spark.table(table).collect())


OLD = Counter({(f"2024-01-0{d}", "old"): 10 for d in range(1, 6)})
NEW = Counter({("2024-01-01", "old"): 10, ("2024-01-02", "new"): 10, ("2024-01-04", "new"): 10, ("2024-01-05", "old"): 10})


@pytest.fixture
def table(spark, db):
    name = f"{db}.days"
    tables.full_overwrite(old_rows(spark), name, ["date"])
    return name


class BrokenOff(Exception):
    pass


def break_at(monkeypatch, module, name, after=0):
    """Let a function of a module fail at its call number ``after``, counted from 0."""
    whole, calls = getattr(module, name), []

    def function(*args, **options):
        calls.append(name)
        if len(calls) > after:
            raise BrokenOff(name)
        return whole(*args, **options)

    monkeypatch.setattr(module, name, function)


def replace(spark, table):
    return journal.replace(new_rows(spark), table, ["date"], WINDOW)


def test_replacement(spark, table):
    assert replace(spark, table) == {(day(2),), (day(4),)}
    assert held(spark, table) == NEW
    assert journal.recover(spark, table) == {}


@pytest.mark.parametrize("step", ["stage", "prepare"])
def test_broken_off_before_the_manifest_is_undone(spark, table, monkeypatch, step):
    with monkeypatch.context() as m:
        break_at(m, journal, step)
        with pytest.raises(BrokenOff):
            replace(spark, table)
    assert held(spark, table) == OLD
    assert list(journal.recover(spark, table).values()) == ["undone"]
    assert held(spark, table) == OLD
    assert catalog.folder_names(spark, f"{catalog.location(spark, table)}/{journal.FOLDER}") == []
    replace(spark, table)
    assert held(spark, table) == NEW


def test_broken_off_while_staging_leaves_no_table(spark, table, monkeypatch):
    with monkeypatch.context() as m:
        break_at(m, catalog, "bucket_columns")  # the stage table exists, nothing is in it
        with pytest.raises(BrokenOff):
            replace(spark, table)
    database = table.split(".")[0]
    assert spark.sql(f"SHOW TABLES IN {database}").count() == 2
    journal.recover(spark, table)
    assert [r["tableName"] for r in spark.sql(f"SHOW TABLES IN {database}").collect()] == ["days"]
    assert held(spark, table) == OLD


@pytest.mark.parametrize("name, after", [
    ("add_partitions", 0), ("set_location", 0), ("set_location", 1), ("drop_partitions", 0),
])
def test_broken_off_behind_the_manifest_is_finished(spark, table, monkeypatch, name, after):
    with monkeypatch.context() as m:
        break_at(m, catalog, name, after)
        with pytest.raises(BrokenOff):
            replace(spark, table)
    spark.catalog.refreshTable(table)
    assert held(spark, table) != NEW
    assert list(journal.recover(spark, table).values()) == ["finished"]
    assert held(spark, table) == NEW
    assert journal.recover(spark, table) == {}


def test_the_next_replacement_finishes_the_last_one(spark, table, monkeypatch):
    with monkeypatch.context() as m:
        break_at(m, journal, "finish")
        with pytest.raises(BrokenOff):
            replace(spark, table)
    again = old_rows(spark).withColumn("v", F.lit("later")).where(F.col("date") == day(5))
    journal.replace(again, table, ["date"], [(day(5),)])
    assert held(spark, table) == NEW - Counter({("2024-01-05", "old"): 10}) + Counter({("2024-01-05", "later"): 10})


def test_files_out_of_use_go(spark, table):
    for _ in range(3):
        replace(spark, table)
    place = catalog.location(spark, table)
    assert len(catalog.folder_names(spark, f"{place}/{journal.FOLDER}")) == 1
    assert sorted(n for n in catalog.folder_names(spark, place) if n.startswith("date")) == [
        f"date=2024-01-0{d}T00%3A00%3A00" for d in (1, 5)
    ]
    assert held(spark, table) == NEW


def test_a_table_may_be_replaced_by_rows_of_its_own(spark, table):
    twice = spark.table(table).unionByName(spark.table(table))
    journal.replace(twice, table, ["date"], WINDOW)
    assert held(spark, table) == Counter({k: 2 * n for k, n in OLD.items()})


def test_without_rows_the_listed_days_are_emptied(spark, table):
    journal.replace(new_rows(spark).where("false"), table, ["date"], WINDOW)
    assert held(spark, table) == Counter({k: n for k, n in OLD.items() if k[0][-1] in "15"})
    assert catalog.folder_names(spark, f"{catalog.location(spark, table)}/{journal.FOLDER}") == []


def test_new_days_and_odd_names(spark, db):
    table = f"{db}.odd"
    names = ["a/b", "it's", "50%", "x=y", "q?", "back\\slash", "Zoë", "a b"]
    old = spark.createDataFrame([(i, n) for i, n in enumerate(names)], "id long, name string")
    tables.full_overwrite(old, table, ["name"])
    new = spark.createDataFrame([(i + 100, n) for i, n in enumerate([*names[:6], "new:day", None])], "id long, name string")
    journal.replace(new, table, ["name"], [("Zoë",)])
    assert sorted(r["id"] for r in spark.table(table).collect()) == [7, *range(100, 108)]
    journal.replace(new.withColumn("id", F.col("id") + 100), table, ["name"])
    assert sorted(r["id"] for r in spark.table(table).collect()) == list(range(200, 208))


def test_several_partition_columns_and_append(spark, db):
    table = f"{db}.months"
    old = spark.range(24).select("id", (F.col("id") % 2 + 2023).cast("int").alias("year"), (F.col("id") % 12).cast("int").alias("month"))
    tables.full_overwrite(old, table, ["year", "month"])
    journal.replace(old.where("year = 2023").withColumn("id", F.col("id") + 1000), table, ["year", "month"], [])
    assert spark.table(table).where("id >= 1000").count() == 12 == spark.table(table).where("year = 2023").count()
    tables.append(old, table)
    assert spark.table(table).count() == 48


def test_buckets_stay(spark, db):
    table = f"{db}.bucketed"
    old_rows(spark).write.partitionBy("date").bucketBy(4, "id").sortBy("id").saveAsTable(table)
    replace(spark, table)
    assert held(spark, table) == NEW
    plan = spark.table(table).groupBy("id").count()._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan

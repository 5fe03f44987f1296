import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import tables
from daybook.plans import jobs
from daybook.plans.config import ImportConfig
from daybook.sources import jdbc


def fail(message):
    def writer():
        raise ValueError(message)
    return writer


def test_audit_rows(spark, db):
    audit = f"{db}.audit"
    jobs.create_audit_table(spark, audit)
    good = jobs.audited_load(spark, audit, "a", lambda: None)
    bad = jobs.audited_load(spark, audit, "b", fail("it's gone"))
    assert not good.failed and bad.failed and isinstance(bad.error, ValueError)
    rows = {r["table_name"]: r for r in spark.table(audit).collect()}
    assert rows["a"]["status"] == "1" and rows["a"]["info"] == "update success" and rows["a"]["end_time"]
    assert rows["b"]["status"] == "0" and rows["b"]["info"] == "it's gone" and rows["b"]["end_time"] is None


def test_many_loads_side_by_side(spark, db):
    audit = f"{db}.audit"
    jobs.create_audit_table(spark, audit)
    writers = {
        f"t{i}": (lambda i=i: tables.full_overwrite(spark.range(i), f"{db}.t{i}")) for i in range(6)
    }
    writers["bad"] = fail("no")
    results = jobs.load_many(spark, audit, writers, at_once=3)
    assert jobs.failed_tables(results) == ["bad"]
    assert [spark.table(f"{db}.t{i}").count() for i in range(6)] == list(range(6))
    assert spark.table(audit).count() == 7
    assert jobs.load_many(spark, audit, {}) == []


class Frames(jdbc.Source):
    """A source whose tables are frames; keeps the conditions it is asked with."""

    def of(kind, table, metadata=None, owner=None):
        source = Frames(kind, "url", owner=owner)
        object.__setattr__(source, "frames", (table, metadata))
        object.__setattr__(source, "asked", [])
        return source

    def read(self, spark, table, condition=""):
        self.asked.append(condition)
        return self.frames[0].where(condition or "true")

    def metadata(self, spark):
        return self.frames[1]


def orders(spark):
    return spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select("o_orderkey", "o_orderdate")


@pytest.mark.parametrize("mode, span, low, high", [
    ("T0", (None, None), "1999-01-01", "2100-01-01"),
    ("T1", (None, None), "1999-05-04", "1999-05-05"),
    ("T0", ("1999-06-01 00:00:00", "1999-07-01 00:00:00"), "1999-06-01", "1999-07-01"),
])
def test_import_delta(spark, db, mode, span, low, high):
    audit, target = f"{db}.audit", f"{db}.target"
    jobs.create_audit_table(spark, audit)
    source = orders(spark)
    old = source.where("o_orderdate < '1999-01-01'")
    tables.full_overwrite(old, target)
    if mode == "T0":
        low = old.agg(F.max("o_orderdate").cast("string")).first()[0] if span[0] is None else low
    config = ImportConfig("delta", ["orders"], [target], ["o_orderdate"], ["o_orderdate"], delta_mode=mode)
    results = jobs.import_tables(
        spark, config, Frames.of("mysql", source), audit, dt.date(1999, 5, 5), *span)
    assert not jobs.failed_tables(results)
    operator = ">" if mode == "T0" and span[0] is None else ">="
    expected = source.where(f"o_orderdate {operator} '{low}' and o_orderdate < '{high}'")
    assert expected.count() > 0
    assert spark.table(target).exceptAll(old.unionAll(expected)).count() == 0
    assert spark.table(target).count() == old.count() + expected.count()


def test_import_into_an_empty_target_and_full(spark, db):
    audit, target = f"{db}.audit", f"{db}.target"
    jobs.create_audit_table(spark, audit)
    source = orders(spark)
    tables.full_overwrite(source.limit(0), target)
    metadata = spark.createDataFrame(
        [("hr", "ORDERS", "o_orderkey", "the\nkey"), ("hr", "other", "o_orderdate", "no"),
         ("old", "ORDERS", "o_orderkey", "of another schema")],
        "owner string, table_name string, column_name string, comments string")
    read = Frames.of("oracle", source, metadata, owner="hr")
    today = dt.date(2024, 1, 1)
    config = ImportConfig("delta", ["orders"], [target], ["o_orderdate"], ["o_orderdate"], delta_mode="T0")
    jobs.import_tables(spark, config, read, audit, today)
    assert spark.table(target).count() == source.count()
    full = ImportConfig("fullpart", ["orders"], [target], partition_fields=["o_orderdate-year"])
    jobs.import_tables(spark, full, read, audit, today)
    described = {c.name: c.description for c in spark.catalog.listColumns(target)}
    assert described["o_orderkey"] == "the,key" and described["o_orderdate"] is None
    assert tables.partition_columns(spark, target) == ["year"]
    assert read.asked == ["1 = 1", ""]


def test_import_into_a_keyed_table(spark, db):
    audit, target = f"{db}.audit", f"{db}.keyed"
    jobs.create_audit_table(spark, audit)
    rows = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 5, "n")], "k long, at long, v string")
    tables.keyed_table(spark.createDataFrame([(1, 0, "old"), (2, 0, "old"), (None, 0, "old")], rows.schema),
                       target, ["k"], 4)
    config = ImportConfig("delta", ["s"], [target], ["at"], ["at"], delta_mode="T0", keyed_target=True)
    source, today = Frames.of("mysql", rows), dt.date(2024, 1, 1)
    failed = jobs.import_tables(spark, config, source, audit, today, keys={target: ["k"]})
    assert jobs.failed_tables(failed) == [target] and "more than once" in failed[0].info
    done = jobs.import_tables(spark, config, source, audit, today, keys={target: ["k"]}, latest_by={target: "at"})
    assert not jobs.failed_tables(done)
    found = {(r.k, r.at, r.v) for r in spark.table(target).collect()}
    assert found == {(1, 2, "b"), (2, 0, "old"), (None, 5, "n")} and spark.table(target).count() == 3


@pytest.mark.parametrize("settings, message", [
    (dict(update_type="weekly"), "update type"),
    (dict(update_type="full", delta_mode="T2"), "delta mode"),
    (dict(update_type="full", target_tables=[]), "target_tables"),
    (dict(update_type="delta", target_delta_fields=["d"]), "source_delta_fields"),
    (dict(update_type="delta", source_delta_fields=["d"]), "target_delta_fields"),
    (dict(update_type="deltapart", source_delta_fields=["d"], target_delta_fields=["d"]), "partition_fields"),
    (dict(update_type="fullpart", partition_fields=["d-week"]), "column-year"),
    (dict(update_type="full", keyed_target=True, partition_fields=["d-day"]), "keyed"),
])
def test_settings_are_checked(settings, message):
    with pytest.raises(ValueError, match=message):
        ImportConfig(**{"source_tables": ["s"], "target_tables": ["t"], **settings})


def test_tasks():
    config = ImportConfig("delta", ["s", "u"], ["t", "v"], ["a-b", "c"], ["d-e", "f"])
    first, second = config.tasks()
    assert (first.source_delta_fields, first.target_delta_fields) == (("a", "b"), ("d", "e"))
    assert second.source_table == "u" and second.partition_field is None

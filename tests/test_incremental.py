import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.operators import incremental, tables

SCHEMA = "id long, ts timestamp_ntz"


def times(spark, *texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id long, ts string").select(
        "id", F.col("ts").cast("timestamp_ntz").alias("ts"))


def ids(df):
    return sorted(r["id"] for r in df.collect())


@pytest.mark.parametrize("mark", ["2024-01-05 00:30:00", "2024-01-05 12:30:00", "2024-01-05 15:04:00.000001"])
def test_t0_is_exact_at_every_hour(spark, mark):
    target = times(spark, "2024-01-01 00:00:00", mark)
    source = times(spark, "2024-01-05 00:10:00", "2024-01-05 03:04:00", "2024-01-05 15:03:59", mark,
                   "2024-01-05 15:04:00.000002", "2024-01-06 00:00:00")
    expected = [i for i, t in enumerate(ids_ts(source)) if t > dt.datetime.fromisoformat(mark)]
    assert ids(incremental.delta(source, target, [("ts", "ts")], "T0")) == expected


def ids_ts(df):
    return [r["ts"] for r in df.orderBy("id").collect()]


def test_t0_on_an_empty_target_loads_everything(spark):
    source = times(spark, "2024-01-05 00:10:00", "2024-01-06 00:00:00")
    assert ids(incremental.newer_than_target(source, source.limit(0), [("ts", "ts")])) == [0, 1]
    nulls = spark.createDataFrame([(1, None)], SCHEMA)
    assert ids(incremental.newer_than_target(source, nulls, [("ts", "ts")])) == [0, 1]


def test_t0_fields_are_joined_by_and(spark):
    df = spark.createDataFrame([(1, 5, 5), (2, 6, 5), (3, 6, 6)], "id long, a int, b int")
    assert ids(incremental.newer_than_target(df, df.where("id = 1"), [("a", "a"), ("b", "b")])) == [3]


def test_t1_and_range_are_half_open(spark):
    source = times(spark, "2024-01-04 23:59:59", "2024-01-05 00:00:00", "2024-01-05 23:59:59", "2024-01-06 00:00:00")
    assert ids(incremental.delta(source, source, [("ts", "ts")], "T1", today=dt.date(2024, 1, 6))) == [1, 2]
    begin, finish = dt.datetime(2024, 1, 5), dt.datetime(2024, 1, 6)
    fields = [("ts", "ts")]
    assert ids(incremental.delta(source, source, fields, "T1", None, begin, finish)) == [1, 2]
    with pytest.raises(ValueError):
        incremental.delta(source, source, fields, "T2")
    # Only one end given: the mode decides.
    assert ids(incremental.delta(source, source.limit(0), fields, "T0", begin=begin)) == [0, 1, 2, 3]


def test_watermark_is_pushed_down(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    old = orders.where(F.col("o_orderdate") < F.lit("2000-01-01").cast("timestamp_ntz"))
    plan = incremental.newer_than_target(orders, old, [("o_orderdate", "o_orderdate")])
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(o_orderdate" in text


def test_resume_by_key(spark):
    source = times(spark, "2024-01-01 00:00:00", "2024-01-02 00:00:00", "2024-01-03 00:00:00")
    assert ids(incremental.not_yet_loaded(source, source.where("id < 2"), ["id"])) == [2]


def test_keyed_loads(spark, db):
    table = f"{db}.keyed"
    tables.full_overwrite(spark.createDataFrame([(1, "a"), (2, "b")], "id long, v string"), table)
    delta = spark.createDataFrame([("2", " B\n"), ("3", "null")], "`T$ID` string, `t$v` string")
    incremental.load(delta, table, "delta", keys=["id"])
    assert {tuple(r) for r in spark.table(table).collect()} == {(1, "a"), (2, "B"), (3, None)}
    incremental.load(spark.createDataFrame([(9, "z")], "id long, v string"), table, "full", keys=["id"])
    assert [tuple(r) for r in spark.table(table).collect()] == [(9, "z")]


def test_load_rejects_wrong_settings(spark, db):
    df = spark.range(1)
    with pytest.raises(ValueError, match="update type"):
        incremental.load(df, f"{db}.t", "weekly")
    with pytest.raises(ValueError, match="partition field"):
        incremental.load(df, f"{db}.t", "deltapart")


def test_resume_takes_null_keys_for_equal(spark):
    rows = spark.createDataFrame([(1, "a"), (None, "a"), (1, None), (None, None), (2, "b")], "k long, part string")
    held = rows.where("part is null or k is null")
    left = incremental.not_yet_loaded(rows, held, ["k", "part"])
    assert sorted(map(tuple, left.collect())) == [(1, "a"), (2, "b")]
    assert incremental.not_yet_loaded(rows, rows, ["k"]).count() == 0
    again = rows.withColumnRenamed("part", "_held_k")  # a clashing name in the source
    assert incremental.not_yet_loaded(again.select("k", F.lit(1).alias("x")), held, ["k"]).count() == 1

from collections import Counter

import pytest
from pyspark.sql import functions as F

from daybook.operators import joins
from daybook.operators.joins import broadcast_when_small, hot_keys, left_join_spread


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def sides(spark):
    # One key holds a third of the right rows, in identical copies; some keys miss.
    left = spark.range(0, 300).select(
        F.when(F.col("id") % 50 == 0, None).otherwise(F.col("id") % 40).alias("k"),
        F.col("id").alias("l"),
    )
    right = spark.range(0, 900).select(
        F.when(F.col("id") < 300, 7).when(F.col("id") < 310, None)
        .otherwise(F.col("id") % 30).cast("bigint").alias("rk"),
        F.when(F.col("id") < 300, 0).otherwise(F.col("id")).alias("r"),
    )
    return left, right


def test_hot_keys_are_found_exactly(sides):
    _, right = sides
    frame, listed = hot_keys(right, ["rk"], min_rows=200)
    assert [tuple(r) for r in listed] == [(7, 2)] == [tuple(r) for r in frame.collect()]
    assert hot_keys(right, ["rk"], min_rows=1_000) is None


def test_limit_of_a_slice_does_not_grow_with_the_data(spark):
    # One key just under a thousandth of the rows.
    right = spark.range(3_000_000).select(F.when(F.col("id") < 2_999, -1).otherwise(F.col("id")).alias("rk"))
    _, listed = hot_keys(right, ["rk"], min_rows=50)
    assert [tuple(r) for r in listed] == [(-1, 60)]
    left = spark.createDataFrame([(-1,), (5_000,)], "k long")
    joined = left_join_spread(left, right, [("k", "rk")], min_rows=50)
    assert joined.groupBy("k").count().orderBy("k").collect() == [(-1, 2_999), (5_000, 1)]
    deal = F.pmod(F.monotonically_increasing_id(), F.lit(60))
    sizes = right.where("rk = -1").coalesce(1).groupBy(deal.alias("deal")).count()
    assert sizes.agg(F.max("count")).first()[0] <= 50


def test_long_list_of_hot_keys_stays_a_frame(sides, monkeypatch):
    left, right = sides
    monkeypatch.setattr(joins, "LISTED_KEYS", 2)
    frame, listed = hot_keys(right, ["rk"], min_rows=15)
    assert listed == [] and frame.count() > 2
    expected = Counter(map(tuple, left.join(right, left.k == right.rk, "left").collect()))
    assert Counter(map(tuple, left_join_spread(left, right, [("k", "rk")], min_rows=15).collect())) == expected


def test_spread_join_equals_plain_join(sides):
    left, right = sides
    expected = Counter(map(tuple, left.join(right, left.k == right.rk, "left").collect()))
    spread = left_join_spread(left, right, [("k", "rk")], min_rows=20)
    assert "_slice" in plan(spread)
    dealing = plan(spread).split("monotonically_increasing_id()")[1]
    assert dealing.lstrip().split("\n")[1].strip(" :+-*()0123456789").startswith("Sort [rk")
    assert Counter(map(tuple, spread.collect())) == expected
    assert "_slice" not in plan(left_join_spread(left, right, [("k", "rk")]))


def test_lookup_beyond_the_limit_is_not_marked(spark, sides):
    left, right = sides
    small, = broadcast_when_small(right)
    large, = broadcast_when_small(right, max_bytes=10)
    assert "broadcast" in small._jdf.queryExecution().logical().toString().lower()
    assert "broadcast" not in large._jdf.queryExecution().logical().toString().lower()


def test_empty_lookup(spark):
    empty = spark.range(0).select(F.col("id").alias("rk"))
    marked, = broadcast_when_small(empty)
    assert left_join_spread(spark.range(3), marked, [("id", "rk")]).count() == 3

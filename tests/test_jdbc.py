"""Everything of the JDBC operators that needs no database."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from daybook.sources import jdbc


def test_slices_cover_every_row_once(spark):
    df = spark.range(-500, 500).select(F.when(F.col("id") % 9 != 0, F.col("id")).alias("k"))
    met = sum((F.when(F.expr(p), 1).otherwise(0) for p in jdbc.slice_predicates("k")), F.lit(0))
    assert df.select(met.alias("n")).distinct().collect() == [(1,)]
    decimals = df.select((F.col("k") / 8).cast("decimal(12,3)").alias("k"))
    assert decimals.select(met.alias("n")).distinct().collect() == [(1,)]


def test_range_options():
    assert jdbc.range_options("id") == {
        "partitionColumn": "id", "lowerBound": "1", "upperBound": "10000", "numPartitions": "200"}


def test_conditions():
    assert jdbc.delta_condition(["a", "b"], "x") == "a > 'x' and b > 'x'"
    assert jdbc.delta_condition(["a"], "x", "y") == "a >= 'x' and a < 'y'"
    assert jdbc.delta_condition(["a"], None) == "1 = 1"
    assert jdbc.delta_condition(["a"], "o'x") == "a > 'o''x'"
    assert jdbc.delta_condition(["a"], "x", source="oracle") == "a > to_date('x', 'yyyy-mm-dd hh24:mi:ss')"
    assert jdbc.delta_condition(["a"], "x.5", source="oracle") == "a > to_timestamp('x.5', 'yyyy-mm-dd hh24:mi:ss.ff')"
    assert jdbc.day_before(dt.date(2024, 3, 1)) == ("2024-02-29 00:00:00", "2024-03-01 00:00:00")


def test_subquery():
    assert jdbc.subquery("t") == "t"
    assert jdbc.subquery("t", "a > 1") == "(select * from t where a > 1) t"
    assert jdbc.subquery("t", "a > 1", "oracle") == "(select * from t where a > 1)"


@pytest.mark.parametrize("rows, partitions", [
    (0, 1), (9_999, 1), (10_000, 10), (999_999, 10), (1_000_000, 100), (9_999_999, 100),
    (10_000_000, 500), (19_999_999, 500), (20_000_000, 1000),
    (20_000_001, 1001), (10**12, 50_000_000)])
def test_tiers(spark, rows, partitions):
    assert jdbc.partitions_for(rows) == partitions
    assert spark.range(1).select(jdbc.size_tier(F.lit(rows)).alias("p")).first()["p"] == partitions


def test_unknown_size_is_not_dealt_anew(spark):
    df = spark.range(10).repartition(3)
    assert jdbc.repartition_by_size(df, None) is df
    assert jdbc.repartition_by_size(df, 10_000).rdd.getNumPartitions() == 10


def test_source_reads_by_kind():
    calls = Recorder()
    holder = Holder()
    holder.read = calls
    source = jdbc.Source("oracle", "url", owner="HR", properties={"user": "u"}, slice_keys={"s": "id"},
                         range_columns={"r": "id"})
    source.read(holder, "s", "d > 1")
    source.read(holder, "r")
    source.read(holder, "t", "d > 1")
    source.metadata(holder)
    tables = [c[1][1] for c in calls.calls if c[0] == "jdbc"]
    options = [c[2] for c in calls.calls if c[0] == "options"]
    assert tables == ["(select * from s where d > 1)"]
    assert [o["dbtable"] for o in options] == ["r", "(select * from t where d > 1)", "all_col_comments"]
    assert options[0]["partitionColumn"] == "id" and "partitionColumn" not in options[1]
    assert jdbc.Source("mysql", "url").comment_columns()["owner_column"] == "table_schema"
    assert source.comment_columns() == {
        "owner_column": "owner", "table_column": "table_name", "name_column": "column_name",
        "comment_column": "comments"}
    with pytest.raises(ValueError, match="kind of a source"):
        jdbc.Source("access", "url")


def test_row_estimates():
    assert jdbc.row_estimate("dbo.V_View", None) == 1_000_000
    assert jdbc.row_estimate("dbo.t", None) is None
    assert jdbc.row_estimate("dbo.t", 7) == 7


class Recorder:
    """Stands for a reader or writer and keeps what it is told."""

    def __init__(self):
        self.calls = []

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self
        return call


class Holder:
    def __init__(self):
        self.read = self.write = Recorder()


def test_reads_and_writes_are_put_to_spark():
    holder = Holder()
    jdbc.read_sliced(holder, "url", "t", "id", slices=2, driver="d")
    jdbc.read_ranged(holder, "url", "t", "id", driver="d")
    jdbc.write_table(holder, "url", "t", overwrite=True, user="u")
    jdbc.write_table(holder, "url", "t")
    names = [c[0] for c in holder.read.calls]
    assert names == ["jdbc", "format", "options", "load", "mode", "option", "jdbc", "mode", "jdbc"]
    assert holder.read.calls[0][2]["predicates"] == jdbc.slice_predicates("id", 2)
    assert holder.read.calls[2][2]["numPartitions"] == "200"
    assert holder.read.calls[4][1] == ("overwrite",) and holder.read.calls[7][1] == ("append",)
    assert holder.read.calls[5][1] == ("truncate", "true")


def test_repartition(spark):
    assert jdbc.repartition_by_size(spark.range(10), 50_000).rdd.getNumPartitions() == 10

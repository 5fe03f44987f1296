import datetime as dt

import pytest
from pyspark.sql import types as T

from daybook.operators import shape


def frame(spark, *names):
    return spark.createDataFrame([tuple(range(len(names)))], list(names))


def test_names(spark):
    assert shape.strip_names(frame(spark, "a,b;c(d)", "{e}\n")).columns == ["abcd", "e"]
    vendor = shape.vendor_names(frame(spark, "T$DATE", "t$dates", "t$amt", "a$b", "amount$x"))
    assert vendor.columns == ["t_date", "t_dates", "amt", "a_b", "amounx"]
    with pytest.raises(ValueError, match="one name"):
        shape.lower_names(frame(spark, "A", "a"))


@pytest.mark.parametrize("name, ddl", [
    ("date", "date"), ("timestamp", "timestamp"), ("binary", "binary"), ("integer", "int"),
    ("boolean", "boolean"), ("long", "bigint"), ("double", "double"), ("float", "float"),
    ("short", "smallint"), ("byte", "tinyint"), ("string", "string"),
    ("decimal", "decimal(38,18)"), ("decimal( 10 , 2 )", "decimal(10,2)"),
])
def test_type_names(name, ddl):
    assert shape.sql_type(name) == ddl


def test_unknown_type_name():
    with pytest.raises(ValueError, match="type name"):
        shape.sql_type("number")


def test_bad_values_become_null(spark):
    df = spark.createDataFrame([("12", "x"), ("z", "y")], "a string, b string")
    target = T.StructType([T.StructField("a", T.IntegerType())])
    assert [tuple(r) for r in shape.cast_to_schema(df, target).collect()] == [(12, "x"), (None, "y")]
    with pytest.raises(ValueError, match="missing"):
        shape.cast_to_schema(df, T.StructType([T.StructField("c", T.IntegerType())]))


def test_type_map(spark):
    df = spark.sql("select date'2024-01-02' d, cast(1.5 as decimal(5,2)) m, 3 n, timestamp_ntz'2024-01-02 03:04:05' t")
    out = shape.cast_by_type_map(df)
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["string", "double", "int", "timestamp_ntz"]
    assert tuple(out.first())[:2] == ("2024-01-02", 1.5)


def test_comments(spark):
    metadata = spark.createDataFrame(
        [("hr", "EMP", "id", " the\nkey "), ("hr", "emp", "name", None), ("x", "emp", "id", "other")],
        "table_schema string, table_name string, column_name string, column_comment string",
    )
    rows = shape.column_comments(metadata, "Emp", "hr").collect()
    comments = {r["column_name"]: r["comment"] for r in rows}
    assert comments == {"id": "the,key", "name": ""}
    df = shape.with_comments(frame(spark, "id", "name", "age"), comments)
    assert shape.comments_of(df) == {"id": "the,key", "name": ""}


def test_safe_union_both_ways(spark):
    stamp = dt.datetime(2024, 1, 2, 3, 4, 5)
    left = spark.createDataFrame([(1, 1599846111000)], "ID long, T long")
    right = spark.createDataFrame([(2, stamp, "x")], "id int, t timestamp, extra string")
    for rows in (shape.safe_union(left, right), shape.safe_union(right, left)):
        assert rows.schema["t"].dataType == T.TimestampType()
        assert rows.schema["id"].dataType == T.LongType()
        found = {r["id"]: (r["t"], r["extra"]) for r in rows.collect()}
        assert found == {1: (dt.datetime(2020, 9, 11, 9, 41, 51), None), 2: (stamp, "x")}


def test_union_pages(spark):
    empty = spark.createDataFrame([], T.StructType([]))
    first, second = frame(spark, "a", "b"), frame(spark, "b", "a")
    rows = shape.union_pages([empty, first, second]).collect()
    assert sorted(tuple(r) for r in rows) == [(0, 1), (1, 0)]
    with pytest.raises(ValueError):
        shape.union_pages([empty])

"""Rows whose shape changes between loads."""

import json

import pytest
from pyspark.sql import types as T

from daybook.operators import tables
from daybook.sources import drift

BASE = T.StructType([T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("x", T.DoubleType())])


def land(folder, *pages, envelope=("count", "items")):
    folder.mkdir(exist_ok=True)
    for i, rows in enumerate(pages):
        text = rows if isinstance(rows, str) else json.dumps({envelope[0]: len(rows), envelope[1]: rows})
        (folder / f"{i}.json").write_text(text)
    return str(folder)


@pytest.fixture
def table(spark, db):
    tables.full_overwrite(spark.createDataFrame([(1, "a", 1.5)], BASE), f"{db}.items")
    return f"{db}.items"


def held(spark, table, *columns):
    return sorted((tuple(r) for r in spark.table(table).select(*columns).collect()), key=str)


def test_fields_and_their_types(spark, tmp_path):
    path = land(
        tmp_path / "in",
        [{"i": 1, "d": 1, "s": "x", "b": True, "n": None, "mixed": 1, "o": {"a": 1}, "odd name": 1}],
        [{"i": 2**40, "d": 0.5, "s": None, "b": False, "mixed": "one", "l": [1], "e": 1e300, "o": None}], [], '{"count": 0}',
    )
    kinds = {n: t.simpleString() for n, t in drift.fields_of(drift.read_items(spark, path)).items()}
    assert kinds == {
        "i": "bigint", "d": "double", "s": "string", "b": "boolean", "n": "void", "mixed": "string", "o": "string",
        "l": "string", "e": "double", "odd name": "bigint",
    }


def test_added_missing_and_retyped_fields(spark, table, tmp_path):
    path = land(tmp_path / "in", [
        {"id": 2, "name": "b", "city": "Rome", "size": 3, "bad-name": 7},
        {"id": "three", "name": 3, "city": None, "nothing": None},
        {"id": 4.5, "name": None, "size": 2.5},
    ])
    found = drift.load(spark, path, table)
    assert {n: t.simpleString() for n, t in found.added.items()} == {"city": "string", "size": "double"}
    assert found.missing == ["x"] and found.refused == ["bad-name"] and list(found.retyped) == ["id"]
    assert spark.table(table).columns == ["id", "name", "x", "city", "size", "rescued"]
    assert held(spark, table, "id", "name", "x", "city", "size", "rescued") == sorted([
        (1, "a", 1.5, None, None, None), (2, "b", None, "Rome", 3.0, {"bad-name": "7"}),
        (None, "3", None, None, None, {"id": "three"}), (None, None, None, None, 2.5, {"id": "4.5"}),
    ], key=str)


def test_the_next_loads_use_the_wider_table(spark, table, tmp_path):
    drift.load(spark, land(tmp_path / "a", [{"id": 2, "city": "Rome"}]), table)
    again = drift.load(spark, land(tmp_path / "b", [{"ID": 3, "City": "Oslo", "x": 2}]), table)
    assert again.added == {} and again.retyped == {} and again.refused == []
    assert drift.load(spark, land(tmp_path / "c", []), table).added == {}
    assert spark.table(table).columns == ["id", "name", "x", "city"]


def test_rules(spark, table, tmp_path):
    path = land(tmp_path / "in", [{"id": "x", "aa": 1, "ab": 2, "zz": 3}])
    with pytest.raises(ValueError, match="3 new fields"):
        drift.load(spark, path, table, rule=drift.Rule(at_most=2))
    with pytest.raises(ValueError, match="other types"):
        drift.load(spark, path, table, rule=drift.Rule(retyped="fail"))
    assert spark.table(table).columns == ["id", "name", "x"] and spark.table(table).count() == 1
    found = drift.load(spark, path, table, rule=drift.Rule(names="a.*"))
    assert sorted(found.added) == ["aa", "ab"] and found.refused == ["zz"]
    assert held(spark, table, "rescued")[1][0] == {"id": "x", "zz": "3"} or held(spark, table, "rescued")[0][0] == {"id": "x", "zz": "3"}


def test_numbers_only_widen(spark, table, tmp_path):
    found = drift.load(spark, land(tmp_path / "in", [{"id": 7, "x": 3, "name": 1.5}]), table)
    assert found.retyped == {} and held(spark, table, "id", "name", "x")[1] == (7, "1.5", 3.0)


def test_broken_pages_fail_with_their_name(spark, table, tmp_path):
    for bad in ("{", '{"items": 5}'):
        path = land(tmp_path / "in", [{"id": 1}], bad)
        with pytest.raises(Exception, match="1.json is not valid"):
            drift.load(spark, path, table)
    assert spark.table(table).count() == 1


def test_get_envelope(spark, table, tmp_path):
    path = land(tmp_path / "in", [{"id": 9, "new": True}], envelope=("Count", "Result"))
    drift.load(spark, path, table, envelope="get")
    assert held(spark, table, "id", "new") == sorted([(1, None), (9, True)], key=str)

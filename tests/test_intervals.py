"""Snapshots, compressed to intervals and expanded, are the same bag; so are tables of them."""

from collections import Counter

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from daybook.operators import catalog, intervals, journal

SCHEMA = "empid string, dept string, date string"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def bag(df):
    return Counter(tuple(r) for r in df.select("empid", "dept", "date").collect())


ROWS = [
    ("1", "a", "2024-01-01"), ("1", "a", "2024-01-02"), ("1", "b", "2024-01-05"), ("1", "a", "2024-01-06"),
    ("2", None, "2024-01-01"), ("2", None, "2024-01-05"), (None, "x", "2024-01-02"), (None, "x", "2024-01-02"),
    (None, "x", "2024-01-05"), ("3", "c", "2024-01-02"), ("3", "c", "2024-01-05"), ("3", "c", "2024-01-06"),
]


def test_islands_and_copies(spark):
    rows = frame(spark, ROWS)
    pulls = intervals.pulls_of(rows)
    packed = intervals.compress(rows, pulls)
    assert Counter(tuple(r) for r in packed.collect()) == Counter([
        ("1", "a", 1, 2, 1), ("1", "b", 3, 3, 1), ("1", "a", 4, 4, 1),
        # Absent from the second pull: two intervals. Twice and then once: two intervals.
        ("2", None, 1, 1, 1), ("2", None, 3, 3, 1), (None, "x", 2, 2, 2), (None, "x", 3, 3, 1), ("3", "c", 2, 4, 1),
    ])
    assert bag(intervals.expand(packed, pulls)) == Counter(ROWS)


def test_a_day_without_a_pull_neither_ends_an_interval_nor_comes_back(spark):
    rows = frame(spark, [("1", "a", d) for d in ("2024-01-01", "2024-01-02", "2024-01-09")])
    pulls = intervals.pulls_of(rows)
    packed = intervals.compress(rows, pulls)
    assert [tuple(r) for r in packed.collect()] == [("1", "a", 1, 3, 1)]
    assert bag(intervals.expand(packed, pulls)) == bag(rows)
    assert intervals.of_day(packed, pulls, "2024-01-05").count() == 0
    assert bag(intervals.of_day(packed, pulls, "2024-01-09")) == Counter([("1", "a", "2024-01-09")])


def test_one_day_is_not_found_by_expanding_all(spark):
    rows = frame(spark, ROWS)
    pulls = intervals.pulls_of(rows)
    one = intervals.of_day(intervals.compress(rows, pulls), pulls, "2024-01-02")
    assert bag(one) == Counter(r for r in ROWS if r[2] == "2024-01-02")


def test_facts_meet_the_row_of_their_day(spark):
    rows = frame(spark, ROWS)
    pulls = intervals.pulls_of(rows)
    facts = spark.createDataFrame(
        [(i, e, f"2024-01-0{d}") for i, (e, d) in enumerate((e, d) for e in ("1", "2", "3", None) for d in range(1, 8))],
        "id long, empid string, date string")
    found = intervals.join_as_of(facts, intervals.compress(rows, pulls), pulls, ["empid"])
    plain = facts.join(rows, ["empid", "date"], "left").select("id", "empid", "date", "dept")
    assert Counter(map(tuple, found.collect())) == Counter(map(tuple, plain.collect()))


def test_nothing_to_compress(spark, db):
    rows = frame(spark, [])
    pulls = intervals.pulls_of(rows)
    assert intervals.expand(intervals.compress(rows, pulls), pulls).count() == 0
    intervals.create(rows, f"{db}.none")
    assert intervals.add_pull(frame(spark, ROWS[:1]), f"{db}.none", "2024-01-01") == 1
    assert intervals.expand(spark.table(f"{db}.none"), spark.table(f"{db}.none_pulls")).count() == 1


def stored(spark, table):
    spark.catalog.refreshTable(f"{table}_pulls")
    return bag(intervals.expand(spark.table(table), spark.table(f"{table}_pulls")))


def days(rows):
    return sorted({r[2] for r in rows})


@pytest.fixture
def table(spark, db):
    name = f"{db}.staff"
    intervals.create(frame(spark, [r for r in ROWS if r[2] <= "2024-01-02"]), name)
    return name


def pull(spark, table, rows, day):
    return intervals.add_pull(frame(spark, [r for r in rows if r[2] == day]).drop("date"), table, day)


def test_pulls_one_by_one(spark, table):
    for number, day in enumerate(["2024-01-05", "2024-01-06"], 3):
        assert pull(spark, table, ROWS, day) == number
        assert stored(spark, table) == Counter(r for r in ROWS if r[2] <= day)
    whole = intervals.compress(frame(spark, ROWS), intervals.pulls_of(frame(spark, ROWS)))
    assert Counter(map(tuple, spark.table(table).drop(intervals.STATE).collect())) == Counter(map(tuple, whole.collect()))


def test_the_newest_pull_may_be_added_again(spark, table):
    wrong = [("1", "a", "2024-01-05"), ("9", "z", "2024-01-05")]
    pull(spark, table, wrong, "2024-01-05")
    for _ in range(2):
        assert pull(spark, table, ROWS, "2024-01-05") == 3
        assert stored(spark, table) == Counter(r for r in ROWS if r[2] <= "2024-01-05")
    with pytest.raises(ValueError, match="before the newest"):
        pull(spark, table, ROWS, "2024-01-02")


def test_an_empty_pull_closes_all(spark, table):
    assert intervals.add_pull(frame(spark, []).drop("date"), table, "2024-01-03") == 3
    assert stored(spark, table) == Counter(r for r in ROWS if r[2] <= "2024-01-02")
    assert (intervals.OPEN,) not in catalog.existing_partitions(spark, table)
    pull(spark, table, ROWS, "2024-01-05")
    assert stored(spark, table) == Counter(r for r in ROWS if r[2] <= "2024-01-05")


def test_closed_intervals_are_not_rewritten(spark, table):
    pull(spark, table, ROWS, "2024-01-05")
    before = catalog.existing_partitions(spark, table)
    files = {f for f in spark.table(table).inputFiles() if "closed_by=2024" in f}
    pull(spark, table, ROWS, "2024-01-06")
    assert files <= set(spark.table(table).inputFiles())
    assert catalog.existing_partitions(spark, table) - before == {("2024-01-06",)}


def test_a_pull_that_breaks_off_can_be_added_again(spark, table, monkeypatch):
    for step in ("stage", "prepare", "finish"):
        with monkeypatch.context() as m:
            m.setattr(journal, step, lambda *_: (_ for _ in ()).throw(OSError("gone")))
            with pytest.raises(OSError):
                pull(spark, table, ROWS, "2024-01-05")
        assert pull(spark, table, ROWS, "2024-01-05") == 3
        assert stored(spark, table) == Counter(r for r in ROWS if r[2] <= "2024-01-05")


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.tuples(st.sampled_from(["1", "2", None]), st.sampled_from(["a", None])), max_size=4), min_size=1, max_size=5))
def test_any_pulls(spark, pulls):
    rows = [(e, d, f"2024-01-{2 * i + 1:02d}") for i, p in enumerate(pulls) for e, d in p]
    df = frame(spark, rows)
    numbered = intervals.pulls_of(df)
    packed = intervals.compress(df, numbered)
    assert bag(intervals.expand(packed, numbered)) == Counter(rows)
    assert packed.agg(F.coalesce(F.sum((F.col("last_pull") - F.col("first_pull") + 1) * F.col("copies")), F.lit(0))).first()[0] == len(rows)

"""The paged data source and the stream of pulls."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import catalog, tables
from daybook.sources import paged, pages
from daybook.streaming import current_day

ITEM = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("ok", T.BooleanType()),
    T.StructField("date", T.StringType()),
])


def day(d):
    return f"2024-01-{d:02d}T00:00:00"


def rows(spark, days, n=10):
    return spark.range(n * len(days)).select(
        "id", F.concat(F.lit("n"), F.col("id")).alias("name"), (F.col("id") % 2 == 0).alias("ok"),
        F.element_at(F.array(*[F.lit(day(d)) for d in days]), (F.col("id") % len(days) + 1).cast("int")).alias("date"),
    )


@pytest.fixture
def source(spark, tmp_path):
    paged.register(spark)

    def read(folder="in", **options):
        reader = spark.read.format("paged").schema(options.pop("schema", ITEM)).option("page_rows", 3)
        for name, value in options.items():
            reader = reader.option(name, value)
        return reader.load(str(tmp_path / folder))

    return read


def bag(df):
    return sorted(map(tuple, df.collect()))


@pytest.mark.parametrize("envelope", ["post", "get"])
@pytest.mark.parametrize("group", [1, 2, 50])
def test_all_pages_of_all_days(spark, source, tmp_path, envelope, group):
    df = rows(spark, [1, 2, 3])
    pages.land_requests(df, str(tmp_path / "in"), "date", "id", envelope=envelope, page_rows=3)
    found = source(envelope=envelope, group_pages=group)
    assert found.schema == ITEM and bag(found) == bag(df)
    assert found.rdd.getNumPartitions() == {1: 12, 2: 6, 50: 3}[group]  # four pages a day


def test_other_days_are_not_asked_for(spark, source, tmp_path):
    df = rows(spark, [1, 2, 3, 4])
    pages.land_requests(df, str(tmp_path / "in"), "date", "id", page_rows=3)
    for d in (1, 4):  # what is not asked for may as well be broken
        for page in (tmp_path / "in").glob(f"date={day(d).replace(':', '%3A')}/page=*/part*"):
            page.write_text("{")
    for condition, days in [
        (F.col("date") == day(2), [2]), (F.col("date").between(day(2), day(3)), [2, 3]),
        (F.col("date").isin(day(2), day(3)), [2, 3]), ((F.col("date") > day(1)) & (F.col("date") < day(3)), [2]),
        ((F.col("date") >= day(2)) & (F.col("date") <= day(3)) & F.col("ok"), [3]),
    ]:
        found = source().where(condition)
        assert bag(found) == bag(df.where(condition)) and {r[3] for r in bag(found)} == {day(d) for d in days}
    with pytest.raises(Exception, match="is not a page"):
        source().where(F.col("id") > 0).collect()


def test_pages_of_a_long_day_share_files_and_partitions(spark, source, tmp_path, monkeypatch):
    """Line separators inside a value are no ends of pages; a group begins inside a block."""
    monkeypatch.setattr(pages, "BLOCK_ROWS", 30)
    monkeypatch.setattr(paged, "PARTITIONS", 4)
    paged.register(spark)  # a source travels with the values it is registered with
    df = rows(spark, [1, 2], 100).withColumn("name", F.concat("name", F.lit("\u2028\n\x85\t\u00e9")))
    df = df.where((F.col("date") == day(1)) | (F.col("id") < 10))
    pages.land_requests(df, str(tmp_path / "in"), "date", "id", page_rows=3)
    landed = tmp_path / "in" / f"date={day(1).replace(':', '%3A')}"
    assert {f.name for f in landed.iterdir()} == {"page=1-10", "page=11-20", "page=21-30", "page=31-34"}
    assert len(list(landed.glob("page=*/part*"))) == 4
    assert {f.name for f in (tmp_path / "in" / f"date={day(2).replace(':', '%3A')}").iterdir()} == {"page=1", "page=2"}
    for group in (1, 3, 50):
        found = source(group_pages=group)
        assert bag(found) == bag(df) and found.rdd.getNumPartitions() <= 4
    monkeypatch.setattr(paged, "PARTITION_ROWS", 9)
    paged.register(spark)
    found = source(group_pages=2)
    assert bag(found) == bag(df) and found.rdd.getNumPartitions() == 17
    # A page that is gone from its block is found missing.
    block = next((landed / "page=11-20").glob("part*"))
    lines = block.read_bytes().split(b"\n")
    block.write_bytes(b"\n".join(lines[:3] + lines[4:]))
    with pytest.raises(Exception, match="pages 13 to 14 of 2024-01-01T00:00:00 hold 3 rows, but 6"):
        source(group_pages=2).collect()


def test_days_without_a_count_keep_partitions_of_their_own(monkeypatch):
    monkeypatch.setattr(paged, "PARTITIONS", 1)
    groups = [paged.PageGroup("a", 1, 9, None), paged.PageGroup("b", 1, 1, 2), paged.PageGroup("b", 2, 2, 1),
              paged.PageGroup("c", 1, 9, None), paged.PageGroup("d", 1, 1, 1)]
    assert [len(p.groups) for p in paged._dealt(groups)] == [1, 2, 1, 1]
    assert paged._dealt([]) == []


def test_only_the_days_asked_for_make_partitions(spark, source, tmp_path):
    pages.land_requests(rows(spark, [1, 2, 3]), str(tmp_path / "in"), "date", "id", page_rows=3)
    assert source(group_pages=50).where(F.col("date") == day(2)).rdd.getNumPartitions() == 1
    assert source(group_pages=50).where(F.col("date") == day(9)).count() == 0


def land(folder, **documents):
    for name, document in documents.items():
        place = folder / f"date={day(1).replace(':', '%3A')}" / f"page={name[1:]}"
        place.mkdir(parents=True, exist_ok=True)
        (place / "part-0").write_text(document if isinstance(document, str) else json.dumps(document))


def item(i, **other):
    return {"id": i, "name": f"n{i}", "ok": True, "date": day(1)} | other


def test_the_declared_count_ends_the_reading(spark, source, tmp_path):
    land(tmp_path / "in", p1={"count": 4, "items": [item(1), item(2), item(3)]}, p2={"count": 4, "items": [item(4)]},
         p3="what lies behind the declared rows is not asked for")
    assert [r["id"] for r in source().orderBy("id").collect()] == [1, 2, 3, 4]


def test_without_a_count_the_first_empty_page_ends_it(spark, source, tmp_path):
    land(tmp_path / "in", p1={"items": [item(1)]}, p2={"items": [item(2)]}, p3={"items": []}, p4={"items": [item(9)]})
    assert [r["id"] for r in source().orderBy("id").collect()] == [1, 2]


@pytest.mark.parametrize("documents, message", [
    (dict(p1={"count": 4, "items": [item(1), item(2), item(3)]}), "pages 1 to 2 of 2024-01-01T00:00:00 hold 3 rows, but 4"),
    (dict(p1={"count": 2, "items": [item(1), item(2), item(3)]}), "hold 3 rows, but 2"),
    (dict(p1={"count": 0, "items": [item(1)]}), "declares no rows and holds 1"),
    (dict(p1={"count": 1, "items": {"id": 1}}), "no array of rows"),
    (dict(p1={"count": 1, "items": [item("one")]}), "values of other types"),
    (dict(p1="[1]"), "is not a page"),
])
def test_pages_that_are_wrong_fail_with_their_name(spark, source, tmp_path, documents, message):
    land(tmp_path / "in", **documents)
    with pytest.raises(Exception, match=message):
        source().collect()


def test_values_as_they_come(spark, source, tmp_path):
    land(tmp_path / "in", p1={"count": 3, "items": [
        item(1, ok="true", name=None, other=1), {"id": None, "date": day(1)}, item(3, ok="maybe", name={"a": 1})]})
    assert sorted(map(tuple, source().collect()), key=str) == sorted([
        (1, None, True, day(1)), (None, None, None, day(1)), (3, '{"a":1}', None, day(1))], key=str)


def test_no_days_and_empty_days(spark, source, tmp_path):
    assert source("nowhere").count() == 0
    land(tmp_path / "in", p1={"count": 0, "items": []})
    (tmp_path / "in" / "date=empty").mkdir()
    assert source().count() == 0
    with pytest.raises(Exception, match="schema"):
        spark.read.format("paged").load(str(tmp_path)).collect()


# --- the stream ----------------------------------------------------------------

TODAY = dt.date(2024, 1, 5)


@pytest.fixture
def stream(spark, db, tmp_path):
    table = f"{db}.cards"
    tables.full_overwrite(rows(spark, [4, 5]).withColumn("name", F.lit("old")), table, ["date"])

    def pull(number, name, n=3, complete=True):
        df = rows(spark, [5], n).withColumn("name", F.lit(name))
        pages.land_pages(df, str(tmp_path / "pulls" / f"pull={number}"), "id")
        if not complete:
            (tmp_path / "pulls" / f"pull={number}" / "_SUCCESS").unlink()

    def run(state="state"):
        current_day.stream_pulls(
            spark, str(tmp_path / "pulls"), ITEM, table, "date", TODAY, str(tmp_path / state)).awaitTermination()
        return sorted((r["date"][8:10], r["name"], r["count"]) for r in spark.table(table).groupBy("date", "name").count().collect())

    (tmp_path / "pulls").mkdir()
    return table, pull, run


def test_newest_complete_pull(spark, stream):
    _, pull, run = stream
    old = ("04", "old", 10)
    assert run() == [old, ("05", "old", 10)]
    pull(1, "first")
    assert run() == [old, ("05", "first", 3)]
    pull(10, "tenth", 4)
    pull(9, "ninth")
    assert run() == [old, ("05", "tenth", 4)]
    pull(2, "late")
    assert run() == [old, ("05", "tenth", 4)]
    pull(11, "broken off", complete=False)
    assert run() == [old, ("05", "tenth", 4)]
    pull(12, "twelfth", 5)
    assert run() == [old, ("05", "twelfth", 5)]


def test_an_empty_pull_empties_the_day(spark, stream, tmp_path):
    _, pull, run = stream
    folder = tmp_path / "pulls" / "pull=1"
    folder.mkdir()
    (folder / "part-0").write_text('{"count": 0, "items": []}\n')
    (folder / "_SUCCESS").write_text("")
    assert run() == [("04", "old", 10)]


def test_a_repeated_batch_is_skipped(spark, stream, tmp_path, monkeypatch):
    table, pull, run = stream
    pull(1, "first")
    run()
    checkpoint = str(tmp_path / "state")
    assert current_day.last_batch(spark, table, day(5), checkpoint) == 0
    assert current_day.last_batch(spark, table, day(4), checkpoint) == -1
    assert current_day.last_batch(spark, table, day(5), "another") == -1
    # As if the stream had died before it noted that the batch is done.
    for note in (tmp_path / "state" / "commits").glob("*0*"):
        note.unlink()
    calls = []
    monkeypatch.setattr(current_day, "replace_current_day", lambda *a: calls.append(a))
    assert run() == [("04", "old", 10), ("05", "first", 3)]
    assert calls == []


def test_a_batch_that_broke_off_is_run_again(spark, stream, monkeypatch):
    table, pull, run = stream
    pull(1, "first")
    whole = current_day.replace_current_day
    with monkeypatch.context() as m:
        m.setattr(current_day, "replace_current_day", lambda *a: (_ for _ in ()).throw(OSError("gone")))
        with pytest.raises(Exception, match="gone"):
            run()
    assert current_day.replace_current_day is whole
    pull(2, "second")
    run()  # the batch that broke off, with the pull it had
    assert run() == [("04", "old", 10), ("05", "second", 3)]


def test_a_pull_whose_count_is_wrong_fails(spark, stream, tmp_path):
    _, _, run = stream
    folder = tmp_path / "pulls" / "pull=1"
    folder.mkdir()
    (folder / "part-0").write_text(json.dumps({"count": 2, "items": [item(1)]}))
    (folder / "_SUCCESS").write_text("")
    with pytest.raises(Exception, match="has 1 rows, but says 2"):
        run()
    assert catalog.existing_partitions(spark, stream[0]) == {(day(4),), (day(5),)}

"""Bad pages beside good ones: rows, reasons, limits, and their way back."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import tables
from daybook.sources import pages, quarantine

ITEM = T.StructType([
    T.StructField("id", T.LongType()), T.StructField("name", T.StringType()), T.StructField("ok", T.BooleanType()),
])


def row(i, **other):
    return {"id": i, "name": f"n{i}", "ok": True} | other


PAGES = {
    "good": {"count": 2, "items": [row(1), row(2, ok="false")]},
    "uncounted": {"items": [row(3, ok="maybe")]},
    "empty": {"count": 0, "items": []},
    "null": {"count": 0, "items": None},
    "more": {"count": 1, "items": [row(4, unknown=[1])]},
    "cut": '{"count": 1, "items": [{"id": 5',
    "blank": " ",
    "count": {"count": 3, "items": [row(6)]},
    "lost": {"count": 2},
    "type": {"count": 1, "items": [row("seven")]},
    "object": {"count": 1, "items": {"id": 8}},
    "list": [row(9)],
    "number": "10",
}
REASONS = {
    "cut": quarantine.NOT_JSON, "blank": quarantine.NOT_JSON, "count": quarantine.OTHER_COUNT,
    "lost": quarantine.OTHER_COUNT, "type": quarantine.OTHER_TYPES, "object": quarantine.NO_ROWS,
    "list": quarantine.NO_ROWS, "number": quarantine.NO_ROWS,
}


def land(folder, documents):
    folder.mkdir(exist_ok=True)
    for name, document in documents.items():
        (folder / f"{name}.json").write_text(document if isinstance(document, str) else json.dumps(document))
    return str(folder)


@pytest.fixture
def side(spark, db):
    quarantine.create_side_table(spark, f"{db}.side")
    tables.full_overwrite(spark.createDataFrame([], ITEM), f"{db}.target")
    return f"{db}.side", f"{db}.target"


def ids(spark, table):
    return sorted(r["id"] for r in spark.table(table).collect())


def test_every_kind_of_page(spark, side, tmp_path):
    side, target = side
    found = quarantine.load(
        spark, land(tmp_path / "in", PAGES), ITEM, lambda rows: tables.append(rows, target), side, "cards", max_share=None)
    assert (found.good_pages, found.bad_pages) == (5, 8)
    assert {(r["id"], r["ok"]) for r in spark.table(target).collect()} == {(1, True), (2, False), (3, None), (4, True)}
    kept = spark.table(side).collect()
    assert {r["file"].split("/")[-1].removesuffix(".json"): r["reason"] for r in kept} == REASONS
    assert {r["load"] for r in kept} == {"cards"} and all(r["loaded_at"] for r in kept)
    texts = {r["file"].split("/")[-1].removesuffix(".json"): r["page"] for r in kept}
    assert texts["cut"] == PAGES["cut"] and json.loads(texts["type"]) == PAGES["type"]


def test_good_pages_give_what_the_strict_reader_gives(spark, tmp_path):
    good = {n: p for n, p in PAGES.items() if n not in REASONS}
    path = land(tmp_path / "in", good)
    found = quarantine.split(spark, path, ITEM)
    strict = pages.read_pages(spark, path, ITEM)
    assert found.rows.schema == strict.schema and found.bad_pages == 0
    assert sorted(map(tuple, found.rows.collect()), key=str) == sorted(map(tuple, strict.collect()), key=str)


@pytest.mark.parametrize("limit", [{"max_bad": 7, "max_share": None}, {"max_share": 0.5}, {"max_bad": 0}])
def test_beyond_the_limit_nothing_changes(spark, side, tmp_path, limit):
    side, target = side
    with pytest.raises(quarantine.TooManyBadPages, match=r"8 of 13 pages of cards.*not valid JSON \(2\)"):
        quarantine.load(spark, land(tmp_path / "in", PAGES), ITEM, lambda rows: tables.append(rows, target), side, "cards", **limit)
    assert spark.table(side).count() == spark.table(target).count() == 0


def test_a_failing_writer_leaves_the_side_table(spark, side, tmp_path):
    def broken(rows):
        raise OSError("no space")

    with pytest.raises(OSError):
        quarantine.load(spark, land(tmp_path / "in", PAGES), ITEM, broken, side[0], "cards", max_share=None)
    assert spark.table(side[0]).count() == 0


def test_repaired_pages_come_back(spark, side, tmp_path):
    side, target = side
    write = lambda rows: tables.append(rows, target)
    for name in ("cards", "shifts"):
        quarantine.load(spark, land(tmp_path / name, PAGES), ITEM, write, side, name, max_share=None)
    before = ids(spark, target)
    found = quarantine.release(
        spark, side, ITEM, write, "cards",
        repair=lambda page: F.regexp_replace(F.regexp_replace(page, '"count": 3', '"count": 1'), "seven", "7"),
    )
    assert found.good_pages == 1  # a number as text is still no number
    assert ids(spark, target) == sorted([*before, 6])
    assert spark.table(side).where("load = 'cards'").count() == 7 and spark.table(side).where("load = 'shifts'").count() == 8


def test_get_pages_scrubbed_pages_and_no_pages(spark, tmp_path):
    path = land(tmp_path / "get", {"a": '{"Count":1,"Result":[{"t$id":1,"t$name":" x ","ok":true}]}', "b": "{"})
    found = quarantine.split(spark, path, ITEM, envelope="get", scrub=True)
    assert (found.good_pages, found.bad_pages) == (1, 1)
    assert [tuple(r) for r in found.rows.collect()] == [(1, "x", True)]
    (tmp_path / "none").mkdir()
    (tmp_path / "none" / "x.json").write_text("")
    found = quarantine.split(spark, str(tmp_path / "none"), ITEM)
    assert (found.good_pages, found.bad_pages, found.rows.count(), found.bad.count()) == (0, 0, 0, 0)

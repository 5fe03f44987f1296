import datetime as dt

from daybook.operators import tables
from daybook.sources.pages import land_pages
from daybook.streaming.current_day import stream_current_day

DAY = "2024-01-10T00:00:00"


def test_each_trigger_takes_the_newest_pull(spark, db, tmp_path):
    table, landing, state = f"{db}.cards", str(tmp_path / "pulls"), str(tmp_path / "state")

    def cards(*codes):
        return spark.createDataFrame([(c, DAY) for c in codes], "shiftcode string, signdate string")

    def trigger():
        stream_current_day(
            spark, landing, cards("x").schema, table, "signdate", dt.date(2024, 1, 10), state
        ).awaitTermination()
        return sorted(r["shiftcode"] for r in spark.table(table).collect())

    tables.full_overwrite(cards("old"), table, ["signdate"])
    land_pages(cards("a"), f"{landing}/pull=1", "shiftcode")
    land_pages(cards("a", "norm "), f"{landing}/pull=2", "shiftcode", page_rows=1)
    assert trigger() == ["a", "norm "]
    assert trigger() == ["a", "norm "]
    land_pages(cards("c"), f"{landing}/pull=010", "shiftcode")
    assert trigger() == ["c"]
    # A late page of an older pull does not bring that pull back.
    cards("late").selectExpr("1 as count", "array(struct(*)) as items").write.mode("append").json(
        f"{landing}/pull=2")
    assert trigger() == ["c"]

import itertools

from pyspark.sql import functions as F

from daybook.operators import wide
from daybook.plans import hr_views as hr

SF = "/root/testdata/sf0.001"

DAY = "2024-01-10T00:00:00"
EARLIER, LATER = "2024-01-09T00:00:00", "2024-01-11T00:00:00"


def expected(entry, leave, stored):
    if entry is not None and entry <= DAY and (leave is None or leave > DAY):
        return False
    if (entry is not None and entry >= DAY) or (leave is not None and leave <= DAY):
        return True
    return {"true": True, "false": False}.get(stored)


def test_status_truth_table(spark):
    moments = [None, EARLIER, DAY, LATER]
    rows = [
        (DAY, e, l, s) for e, l, s in itertools.product(moments, moments, ["true", "false", "n/a", None])
    ]
    df = spark.createDataFrame(rows, "date string, entrydate string, leavedate string, isleave string")
    found = df.withColumn("status", wide.status_as_of()).collect()
    assert len(found) == 64
    for r in found:
        assert r["status"] == expected(r["entrydate"], r["leavedate"], r["isleave"]), r


def test_status_boundaries(spark):
    rows = [(DAY, DAY, None), (DAY, EARLIER, DAY), (DAY, None, DAY), (DAY, LATER, None)]
    df = spark.createDataFrame(rows, "date string, entrydate string, leavedate string")
    status = df.select(wide.status_as_of(stored=F.lit("false")).alias("s")).collect()
    assert [r["s"] for r in status] == [False, True, True, True]


def test_cards_fan_out(spark):
    facts = spark.createDataFrame([("a", DAY), ("b", DAY)], "empid string, date string")
    cards = spark.createDataFrame(
        [("a", DAY, "x")] * 3 + [("a", EARLIER, "x")], "empid string, signdate string, shiftcode string"
    )
    rows = wide.join_cards(facts, cards).collect()
    assert sorted((r["empid"], r["shiftcode"] or "") for r in rows) == [("a", "x")] * 3 + [("b", "")]


def test_hot_cards_and_snapshots_join_the_same(spark):
    facts = hr.attendance(spark, SF).select("empid", "date", "value1")
    cards, people = hr.cards(spark, SF), hr.snapshots(spark, SF)
    # A person and day with a third of all cards, another with a third of all snapshots.
    cards = cards.unionAll(cards.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(200))).alias("n")).drop("n"))
    people = people.unionAll(people.limit(1).select("*", F.explode(F.sequence(F.lit(1), F.lit(2000))).alias("n")).drop("n"))
    for join, side in [(wide.join_cards, cards), (wide.join_snapshot, people)]:
        plain, spread = join(facts, side), join(facts, side, hot_rows=100)
        assert "_slice" in spread._jdf.queryExecution().optimizedPlan().toString()
        assert spread.exceptAll(plain).count() == 0 and spread.count() == plain.count()


def test_default_label(spark):
    units = spark.createDataFrame(
        [("1", "f", None, "L", "S", "n")],
        "fnumber string, forgfunctionid string, freserveitemfirst string, flongnumber string, "
        "fsortcode string, fdisplayname_l2 string",
    )
    lookup = spark.createDataFrame([("f", "sales", "9")], "fid string, fname_l2 string, fnumber string")
    kept = wide.org_dimension(units, lookup, lookup).first()
    labelled = wide.org_dimension(units, lookup, lookup, "other").first()
    assert (kept["systemcategory"], kept["companycategory"]) == ("sales", None)
    assert labelled["companycategory"] == "other"


def test_blank_levels_become_null(spark):
    df = spark.createDataFrame(
        [("1", "", "", "x", None, "")],
        "deptcode string, deptnamel1 string, deptnamel2 string, deptnamel3 string, "
        "deptnamel4 string, deptnamel5 string",
    )
    assert tuple(wide.clean_departments(df).first()) == ("1", "", None, "x", None, None)

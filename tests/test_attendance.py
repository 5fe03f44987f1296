"""The refresh jobs from landed pages to the wide table."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas
from daybook.functions.dates import day_text
from daybook.operators import catalog, journal, tables
from daybook.plans import attendance as plan
from daybook.plans import cli
from daybook.plans import hr_views as hr
from daybook.plans import jobs
from daybook.queries import _wide
from daybook.sources.pages import land_pages

SF = "/root/testdata/sf0.001"
TODAY = dt.date(2024, 1, 25)


@pytest.fixture
def base(spark, db, tmp_path):
    landing = str(tmp_path / "landing")
    people = hr.people(spark, SF).withColumn("isleave", F.col("isleave").try_cast("boolean"))
    land_pages(hr.attendance(spark, SF), f"{landing}/{plan.ATTENDANCE}", "recordid", page_rows=300)
    land_pages(hr.cards(spark, SF), f"{landing}/{plan.CARDS}", "empid")
    shifts = hr.shifts(spark, SF).withColumn("shiftcode", F.upper("shiftcode"))
    land_pages(shifts, f"{landing}/{plan.SHIFTS}", "shiftcode")
    land_pages(people, f"{landing}/{plan.SNAPSHOTS}", "empid")
    land_pages(hr.departments(spark, SF), f"{landing}/{plan.DEPARTMENTS}", "deptcode")
    plan.create_tables(spark, db)
    for name, view in [(plan.ORG_UNITS, hr.org_units), (plan.ORG_FUNCTIONS, hr.org_functions),
                       (plan.ORG_CATEGORIES, hr.org_categories)]:
        tables.full_refresh(view(spark, SF), f"{db}.{name}")
    return landing, people


def test_base_and_wide_refresh(spark, db, base):
    landing, people = base
    results = plan.refresh_base_tables(spark, db, landing, TODAY)
    assert jobs.failed_tables(results) == []
    days = {r["date"] for r in spark.table(f"{db}.{plan.SNAPSHOTS}").select("date").distinct().collect()}
    assert days == {day_text(TODAY)}
    assert spark.table(f"{db}.{plan.ATTENDANCE}").agg(F.max("date")).first()[0] == "2024-01-24T00:00:00"

    first = dt.date(2024, 1, 3)
    tables.backfill_snapshot(people, f"{db}.{plan.SNAPSHOTS}", first, TODAY)
    for _ in range(2):
        assert not plan.refresh_wide_table(spark, db, TODAY).failed
    expected = _wide(spark, SF, window=(first, TODAY - dt.timedelta(days=1))).withColumn(
        "shiftcode", F.upper("shiftcode"))
    found = spark.table(f"{db}.{plan.WIDE}").select(*expected.columns)
    assert found.count() == expected.count() > 0
    assert found.exceptAll(expected).count() == 0

    assert not plan.backfill_wide_table(spark, db, first, first).failed
    assert spark.table(f"{db}.{plan.WIDE}").count() == expected.count()
    window = plan.wide_window(spark, db, first, first)
    text = window._jdf.queryExecution().executedPlan().toString()
    # Facts, people and cards each read the days of the window only.
    for name, key in [(plan.ATTENDANCE, "date"), (plan.CARDS, "signdate"), (plan.SNAPSHOTS, "date")]:
        scan = next(line for line in text.splitlines() if f"{db}.{name}[" in line)
        assert "InMemoryFileIndex(1 paths)[" in scan and f"PartitionFilters: [isnotnull({key}#" in scan
    history = plan.wide_window(spark, db, first, TODAY, history=True)
    assert history.columns == schemas.wide_columns(schemas.HISTORY_VALUE_COUNT)

    narrow = f"{db}.narrow"
    tables.full_overwrite(found.select(*schemas.NARROW_COLUMNS).limit(0), narrow)
    plan.refresh_narrow_view(spark, db, narrow)
    assert spark.table(narrow).count() == expected.count()
    assert spark.table(f"{db}.{plan.AUDIT}").where("status = '1'").count() == 8


def test_current_cards(spark, db, base):
    landing, _ = base
    assert not plan.refresh_current_cards(spark, db, landing, TODAY).failed
    cards = spark.table(f"{db}.{plan.CARDS}")
    expected = hr.cards(spark, SF).where(F.col("signdate") == day_text(TODAY)).count()
    assert cards.count() == expected > 0


def test_later_tables(spark, db, tmp_path):
    landing = str(tmp_path / "landing")
    plan.create_tables(spark, db)

    def land(name, rows, schema, key, envelope="post"):
        item = T._parse_datatype_string(schema)
        land_pages(spark.createDataFrame(rows, item), f"{landing}/{name}", f"`{item.names[0]}`", envelope=envelope)
        plan.create_table(spark, f"{db}.{name}", item, key)
        return item

    dated = [("1", "2023-11-01T00:00:00"), ("2", "2024-01-20T00:00:00"), ("3", "2024-02-20T00:00:00")]
    pending = [("P", "False", 0.0), ("P", "False", 2.0), ("D", "False", 1.0), ("D", "True", 9.0)]
    items = {
        "roster": land("roster", [("1", "202312"), ("2", "202402"), ("3", "202310")], "id string, ym string", "ym"),
        "leave": land("leave", dated, "id string, enddate string", "enddate"),
        "overtime": land("overtime", dated, "id string, workdate string", "workdate"),
        "card_correction": land("card_correction", dated, "id string, signdate string", "signdate"),
        "leave_type": land("leave_type", [("a",), ("b",)], "code string", None),
    }
    item = T._parse_datatype_string("`HR部门` string, closed string, hours double")
    land_pages(spark.createDataFrame(pending, item), f"{landing}/pending_leave", "`HR部门`", envelope="get")
    items["pending_leave"] = item
    plan.create_table(
        spark, f"{db}.pending_leave", T._parse_datatype_string("deptcode string, closed string, hours double"), None)
    conditions = (F.col("`HR部门`") == "P", (F.col("closed") == "False") & (F.col("hours") > 0))
    results = plan.refresh_later_tables(spark, db, landing, TODAY, items, conditions)
    assert jobs.failed_tables(results) == []

    def ids(name):
        return sorted(r[0] for r in spark.table(f"{db}.{name}").collect())

    assert ids("roster") == ["1", "2"]
    assert ids("leave") == ids("overtime") == ids("card_correction") == ["2", "3"]
    assert ids("leave_type") == ["a", "b"]
    assert ids("pending_leave") == ["D", "P", "P", "P"]


def test_only_the_newest_pull_counts(spark, db, tmp_path):
    landing = str(tmp_path / "landing")
    plan.create_tables(spark, db)
    people = hr.people(spark, SF).withColumn("isleave", F.col("isleave").try_cast("boolean"))
    frames = {
        plan.CARDS: (hr.cards(spark, SF), "empid"), plan.SNAPSHOTS: (people, "empid"),
        plan.DEPARTMENTS: (hr.departments(spark, SF), "deptcode"), plan.SHIFTS: (hr.shifts(spark, SF), "shiftcode"),
        plan.ATTENDANCE: (hr.attendance(spark, SF), "recordid"),
    }
    counts = []
    for pull in ("1", "002"):
        for name, (frame, order) in frames.items():
            land_pages(frame, f"{landing}/{name}/pull={pull}", order)
        assert jobs.failed_tables(plan.refresh_base_tables(spark, db, landing, TODAY)) == []
        assert not plan.refresh_current_cards(spark, db, landing, TODAY).failed
        counts.append([spark.table(f"{db}.{name}").count() for name in frames])
    assert counts[0] == counts[1] and all(counts[0])
    assert counts[0][1] == people.count() and counts[0][2] == frames[plan.DEPARTMENTS][0].count()


def test_jobs_as_programs(spark, db, base, capsys):
    landing, _ = base
    parse = cli.parser().parse_args
    day = ["--today", str(TODAY)]
    assert cli.run(spark, parse(["cards", "--db", db, "--landing", landing, *day])) == 0
    assert cli.run(spark, parse(["cards", "--db", db, "--landing", landing + "/none", *day])) == 1
    assert "failed" in capsys.readouterr().out
    assert cli.run(spark, parse(["wide", "--db", db, *day])) == 0
    assert cli.run(spark, parse(["backfill", "--db", db, "--low", "2024-01-03", "--high", "2024-01-04"])) == 0
    assert cli.run(spark, parse(["base", "--db", db, "--landing", landing, *day])) == 0
    with pytest.raises(SystemExit):
        parse(["wide", "--db", db])


def test_refreshes_keep_tables_in_buckets(spark, db, base, tmp_path):
    landing, people = base
    for name in plan.BY_PERSON:
        spark.sql(f"DROP TABLE {db}.{name}")
    plan.create_tables(spark, db, buckets=4)
    assert jobs.failed_tables(plan.refresh_base_tables(spark, db, landing, TODAY)) == []
    tables.backfill_snapshot(people, f"{db}.{plan.SNAPSHOTS}", dt.date(2024, 1, 3), TODAY)
    assert not plan.refresh_current_cards(spark, db, landing, TODAY).failed
    for name, column in plan.BY_PERSON.items():
        assert catalog.bucket_columns(spark, f"{db}.{name}") == [column]
        by_person = spark.table(f"{db}.{name}").groupBy(column).count()
        assert "Exchange" not in by_person._jdf.queryExecution().executedPlan().toString()
    assert not plan.refresh_wide_table(spark, db, TODAY).failed
    expected = _wide(spark, SF, window=(dt.date(2024, 1, 3), TODAY - dt.timedelta(days=1))).withColumn(
        "shiftcode", F.upper("shiftcode"))
    found = spark.table(f"{db}.{plan.WIDE}").select(*expected.columns)
    assert found.count() == expected.count() > 0 and found.exceptAll(expected).count() == 0


def test_jobs_begin_by_recovering_what_broke_off(spark, db, base, monkeypatch, capsys):
    landing, _ = base
    assert plan.recover_tables(spark, db) == {} == plan.recover_tables(spark, "no_such_database")
    with monkeypatch.context() as m:
        m.setattr(journal, "finish", lambda *_: (_ for _ in ()).throw(OSError("gone")))
        assert plan.refresh_current_cards(spark, db, landing, TODAY).failed
    assert spark.table(f"{db}.{plan.CARDS}").count() == 0
    arguments = ["backfill", "--db", db, "--low", "2024-01-03", "--high", "2024-01-03"]
    assert cli.run(spark, cli.parser().parse_args(arguments)) == 0
    assert f"{db}.{plan.CARDS} recovered: finished" in capsys.readouterr().out
    assert spark.table(f"{db}.{plan.CARDS}").count() > 0

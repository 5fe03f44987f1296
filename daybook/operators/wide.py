"""The day-level wide table: facts joined with cards, shifts, people and the organisation."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook import schemas
from daybook.functions.text import blank_to_null
from daybook.operators.filters import date_window, known_members
from daybook.operators.joins import HOT_ROWS, broadcast_when_small, left_join_spread
from daybook.session import ensure_compiled_methods


def org_dimension(
    units: DataFrame, functions: DataFrame, categories: DataFrame, default_label: str | None = None
) -> DataFrame:
    """Org units with the names and numbers of their function and category.

    A unit without a match keeps a null category name, which is what the wide
    table holds; ``default_label`` fills both names instead.
    """
    function = functions.select(
        F.col("fid").alias("_function"),
        F.col("fname_l2").alias("systemcategory"),
        F.col("fnumber").alias("systemnumber"),
    )
    category = categories.select(
        F.col("fid").alias("_category"),
        F.col("fname_l2").alias("companycategory"),
        F.col("fnumber").alias("companynumber"),
    )
    org = (
        units.join(function, F.col("forgfunctionid") == F.col("_function"), "left")
        .join(category, F.col("freserveitemfirst") == F.col("_category"), "left")
        .select("fnumber", "fdisplayname_l2", *schemas.ORG_COLUMNS)
    )
    if default_label is not None:
        org = org.fillna(default_label, ["systemcategory", "companycategory"])
    return org


def status_as_of(
    day: Column | str = "date",
    entry: Column | str = "entrydate",
    leave: Column | str = "leavedate",
    stored: Column | str = "isleave",
) -> Column:
    """Whether a person has left, as of the row's day.

    On board up to the day and not gone by it: false. Not yet entered, or gone by
    it: true. Undecided: the stored flag, null if it is not a truth value.
    """
    day, entry, leave, stored = (
        F.col(c) if isinstance(c, str) else c for c in (day, entry, leave, stored)
    )
    on_board = (entry <= day) & (leave.isNull() | (leave > day))
    return (
        F.when(on_board, F.lit(False))
        .when((entry >= day) | (leave <= day), F.lit(True))
        .otherwise(stored.try_cast("boolean"))
    )


def with_status(snapshots: DataFrame) -> DataFrame:
    return snapshots.withColumn("isleave", status_as_of())


def clean_departments(departments: DataFrame) -> DataFrame:
    return departments.withColumns({c: blank_to_null(F.col(c)) for c in schemas.LEVEL_COLUMNS})


def people_of_days(snapshots: DataFrame) -> DataFrame:
    """Snapshots as a join side, with the status as of their day.

    They grow with people and days, so the joins below never broadcast them.
    """
    return with_status(snapshots).select(
        F.col("empid").alias("_person"), F.col("date").alias("_person_day"),
        "empdept", *schemas.EMPLOYEE_COLUMNS,
    )


def join_snapshot(facts: DataFrame, snapshots: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Facts with the person's snapshot of exactly that day, if there is one."""
    return left_join_spread(
        facts, people_of_days(snapshots).hint("merge"), [("empid", "_person"), ("date", "_person_day")], hot_rows
    ).drop("_person", "_person_day")


def join_known_people(facts: DataFrame, snapshots: DataFrame) -> DataFrame:
    """Facts of people known on that day: the left join and its filter in one inner join.

    AQE can split either side of it, so hot keys need no search.
    """
    return facts.join(
        known_members(people_of_days(snapshots)).hint("merge"),
        (F.col("empid") == F.col("_person")) & (F.col("date") == F.col("_person_day")),
    ).drop("_person", "_person_day")


def join_cards(facts: DataFrame, cards: DataFrame, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Facts with every card record of that person and day; repeats fan out."""
    records = cards.select(
        F.col("empid").alias("_card"), F.col("signdate").alias("_card_day"), "shiftcode"
    )
    return left_join_spread(
        facts, records, [("empid", "_card"), ("date", "_card_day")], hot_rows
    ).drop("_card", "_card_day")


def shift_dimension(shifts: DataFrame) -> DataFrame:
    return shifts.select(F.col("shiftcode").alias("_shift"), "shiftname")


def join_shifts(facts: DataFrame, dimension: DataFrame) -> DataFrame:
    """The shift name of the card record's shift code."""
    return facts.join(dimension, F.col("shiftcode") == F.col("_shift"), "left").drop("_shift")


def department_dimension(departments: DataFrame, org: DataFrame) -> DataFrame:
    """Departments with their org unit, one lookup for the facts."""
    return (
        clean_departments(departments).select(*schemas.DEPARTMENT_COLUMNS)
        .join(org.drop("fdisplayname_l2"), F.col("deptcode") == F.col("fnumber"), "left")
        .drop("fnumber")
    )


def join_departments(facts: DataFrame, dimension: DataFrame, code: str) -> DataFrame:
    return facts.join(dimension, F.col(code) == F.col("deptcode"), "left")


def wide_record(
    facts: DataFrame,
    cards: DataFrame,
    shifts: DataFrame,
    snapshots: DataFrame,
    departments: DataFrame,
    org: DataFrame,
    *,
    window: tuple[dt.date, dt.date] | None = None,
    department_code: str = "empdept",
    values: int = schemas.VALUE_COUNT,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """The whole chain, one row per fact and card record of a known person.

    ``department_code`` is the person's current code, or a fact column that holds
    the code of the time. People are joined before cards, so that unknown members
    go before the cards fan out; both joins use the key (person, day), and the fact
    is shuffled once for the two of them. Rows this wide go beyond the methods that the
    JVM compiles, so the session's limit for them is lowered.
    """
    ensure_compiled_methods(facts.sparkSession)
    if window:
        facts = date_window(facts, *window)
        snapshots = date_window(snapshots, *window)
        cards = date_window(cards, *window, column="signdate")
    values_kept = schemas.value_columns(values)
    needed = [*schemas.FACT_ID_COLUMNS, *values_kept, "date"]
    if department_code != "empdept" and department_code not in needed:
        needed.append(department_code)
    shift, department = broadcast_when_small(
        shift_dimension(shifts), department_dimension(departments, org)
    )
    rows = join_known_people(facts.select(*needed), snapshots)
    rows = join_shifts(join_cards(rows, cards, hot_rows), shift)
    rows = join_departments(rows, department, department_code)
    return rows.select(*schemas.wide_columns(values))


def org_name_fallback(
    records: DataFrame, org: DataFrame, root: str, code: str = "deptcode"
) -> DataFrame:
    """Org columns by department code, or else by the composed display name.

    A record takes its org columns from the unit with its code. Only a record
    without such a unit looks up ``root_level1_level2`` among the display names.
    """
    by_code, by_name = broadcast_when_small(
        org.select(F.col("fnumber").alias("_unit"), F.struct(*schemas.ORG_COLUMNS).alias("_by_code")),
        org.select(F.col("fdisplayname_l2").alias("_name"),
                   F.struct(*schemas.ORG_COLUMNS).alias("_by_name")),
    )
    name = F.when(
        F.col("_unit").isNull(), F.concat_ws("_", F.lit(root), "deptnamel1", "deptnamel2")
    )
    joined = (
        records.join(by_code, F.col(code) == F.col("_unit"), "left")
        .join(by_name, name == F.col("_name"), "left")
    )
    return joined.select(
        *records.columns,
        *[F.coalesce(F.col("_by_code")[c], F.col("_by_name")[c]).alias(c)
          for c in schemas.ORG_COLUMNS],
    )


def narrow_view(wide: DataFrame) -> DataFrame:
    return wide.select(*schemas.NARROW_COLUMNS)

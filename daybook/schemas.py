"""Declared schemas of the source tables and page envelopes."""

from __future__ import annotations

from pyspark.sql import types as T

# Column names of the source tables and of the wide table.
VALUE_COUNT = 55
HISTORY_VALUE_COUNT = 38

EMPLOYEE_COLUMNS = ["empnum", "emprank", "empname", "isleave", "atttype"]
SHIFT_COLUMNS = ["shiftcode", "shiftname"]
DEPARTMENT_COLUMNS = [
    "deptcode", "deptnamel1", "deptnamel2", "deptnamel3", "deptnamel4", "deptnamel5",
]
ORG_COLUMNS = [
    "systemcategory", "systemnumber", "companycategory", "companynumber",
    "flongnumber", "fsortcode",
]
FACT_ID_COLUMNS = ["recordid", "empid", "updatetime"]
LEVEL_COLUMNS = ["deptnamel2", "deptnamel3", "deptnamel4", "deptnamel5"]
NARROW_COLUMNS = [
    "empname", "empnum", "deptnamel1", "deptnamel2", "systemcategory", "value2", "date",
]


def value_columns(count: int = VALUE_COUNT) -> list[str]:
    return [f"value{i}" for i in range(1, count + 1)]


def wide_columns(values: int = VALUE_COUNT) -> list[str]:
    return (
        EMPLOYEE_COLUMNS + SHIFT_COLUMNS + DEPARTMENT_COLUMNS + ORG_COLUMNS
        + FACT_ID_COLUMNS + value_columns(values) + ["date"]
    )


def strings(*names: str) -> T.StructType:
    return T.StructType([T.StructField(n, T.StringType()) for n in names])


ATTENDANCE = strings(*FACT_ID_COLUMNS, *value_columns(), "date")
CARD_RECORD = strings("empid", "shiftcode", "signdate")
SHIFT = strings("shiftcode", "shiftname")
EMPLOYEE = (
    strings("empid", "empnum", "emprank", "empname", "empdept", "atttype",
            "entrydate", "leavedate")
    .add("isleave", T.BooleanType())
)
EMPLOYEE_SNAPSHOT = T.StructType(EMPLOYEE.fields + [T.StructField("date", T.StringType())])
DEPARTMENT = strings(*DEPARTMENT_COLUMNS)
ORG_UNIT = strings("fnumber", "forgfunctionid", "freserveitemfirst", "flongnumber",
                   "fsortcode", "fdisplayname_l2")
ORG_LOOKUP = strings("fid", "fname_l2", "fnumber")
PENDING_LEAVE = strings("companycode", "deptcode", "officecode", "empnum", "mailnum",
                        "start", "end", "leavecode")
LOAD_AUDIT = strings("table_name", "start_time", "status", "info", "end_time")


def post_envelope(item: T.StructType) -> T.StructType:
    """``{count, items: [...]}``, the page form of the POST source."""
    return T.StructType([
        T.StructField("count", T.IntegerType()),
        T.StructField("items", T.ArrayType(item)),
    ])


def get_envelope(item: T.StructType) -> T.StructType:
    """``{Count, Result: [...]}``, the page form of the GET source."""
    return T.StructType([
        T.StructField("Count", T.IntegerType()),
        T.StructField("Result", T.ArrayType(item)),
    ])

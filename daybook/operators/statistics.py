"""Row counts and bounds per partition, kept beside a table and read instead of its data.

A tracked table has ``<table>_statistics``: rows and the smallest and largest value of the
tracked columns, as exact text. Replacements measure the files they have just staged, before
the catalog changes, and the numbers are part of the journal's manifest. An append is observed
while it is written: one pass, one row for all the partitions it touches.

What is no longer certain is measured again, and nothing else: partitions of an append of
which others have been replaced or dropped since, and partitions that came by other ways.
Partitions dropped by hand are noticed, rows added by hand to a known partition are not.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.operators import catalog

PROPERTY = "daybook.statistics"
REPLACED, APPENDED = "replaced", "appended"

_BOUNDS = T.MapType(T.StringType(), T.StructType([T.StructField("low", T.StringType()), T.StructField("high", T.StringType())]))
SCHEMA = T.StructType([
    T.StructField("kind", T.StringType()),
    T.StructField("partitions", T.ArrayType(T.ArrayType(T.StringType()))),
    T.StructField("n_rows", T.LongType()),
    T.StructField("bounds", _BOUNDS),
    T.StructField("entry", T.StringType()),
])

Part = tuple[str, ...]


def statistics_table(table: str) -> str:
    return f"{table}_statistics"


def entry_name() -> str:
    """Names that sort by the time they were made."""
    return f"{time.time_ns():020d}_{uuid.uuid4().hex[:12]}"


# --- tracking ------------------------------------------------------------------

def track(spark: SparkSession, table: str, columns: list[str]) -> None:
    """Keep statistics of a table from now on; its partitions are measured once."""
    missing = sorted(set(columns) - set(spark.table(table).columns))
    if missing:
        raise ValueError(f"{table} has no columns {missing}")
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{PROPERTY}' = '{','.join(columns)}')")
    empty = spark.createDataFrame([], SCHEMA)
    empty.write.mode("overwrite").partitionBy("entry").saveAsTable(statistics_table(table))
    keys = catalog.partition_columns(spark, table)
    record(spark, table, entry_name(), measured(spark.table(table), keys, columns))


def tracked(spark: SparkSession, table: str) -> list[str]:
    """The tracked columns of a table; none if it is not tracked."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == PROPERTY).collect()
    return rows[0]["value"].split(",") if rows else []


def measured(rows: DataFrame, keys: list[str], columns: list[str]) -> list[dict]:
    """One row of statistics per partition that has rows; reads the tracked columns only."""
    found = rows.groupBy(F.array(*[
        F.coalesce(F.col(k).cast("string"), F.lit(catalog.NULL_PARTITION)) for k in keys
    ]).cast("array<string>").alias("part")).agg(*_aggregates(columns)).collect()
    return [
        {"kind": REPLACED, "partitions": [list(r["part"])], "n_rows": r["n_rows"], "bounds": _bounds(r, columns)}
        for r in found
    ]


def emptied(parts: list[Part]) -> list[dict]:
    return [{"kind": REPLACED, "partitions": [list(p)], "n_rows": 0, "bounds": {}} for p in parts]


def record(spark: SparkSession, table: str, entry: str, rows: list[dict]) -> None:
    """Keep the statistics of one change; recording it again changes nothing."""
    if not rows:
        return
    df = spark.createDataFrame([{**r, "entry": entry} for r in rows], SCHEMA)
    target = statistics_table(table)
    if (entry,) in catalog.existing_partitions(spark, target):
        return
    df.coalesce(1).write.insertInto(target)


def observed(rows: DataFrame, table: str) -> tuple[DataFrame, Callable[[str], None]]:
    """Rows that are measured while they are written, and what to call once they are.

    The call takes how the rows came: appended, or replacing all there was. A table that is
    not tracked is left as it is.
    """
    spark = rows.sparkSession
    columns = tracked(spark, table)
    if not columns:
        return rows, lambda kind: None
    keys = catalog.partition_columns(spark, table)
    watch = Observation()
    parts = F.collect_set(F.array(*[
        F.coalesce(F.col(k).cast("string"), F.lit(catalog.NULL_PARTITION)) for k in keys
    ]).cast("array<string>")).alias("parts")

    def done(kind: str) -> None:
        try:
            found = watch.get
        except Exception:  # noqa: BLE001  (a plan without rows may leave the observation out)
            found = {}
        if found.get("n_rows") is None:
            _forget(spark, table)
        elif found["n_rows"]:
            record(spark, table, entry_name(), [{
                "kind": kind, "partitions": [list(p) for p in found["parts"]], "n_rows": found["n_rows"],
                "bounds": _bounds(found, columns),
            }])
        elif kind == REPLACED:
            record(spark, table, entry_name(), emptied([()]))

    return rows.observe(watch, parts, *_aggregates(columns)), done


def _forget(spark: SparkSession, table: str) -> None:
    """Nothing is certain any more: all partitions are measured when they are asked for."""
    spark.createDataFrame([], SCHEMA).write.mode("overwrite").partitionBy("entry").saveAsTable(statistics_table(table))


def _aggregates(columns: list[str]) -> list:
    return [
        F.count(F.lit(1)).alias("n_rows"),
        *[F.min(c).cast("string").alias(f"low_{i}") for i, c in enumerate(columns)],
        *[F.max(c).cast("string").alias(f"high_{i}") for i, c in enumerate(columns)],
    ]


def _bounds(row, columns: list[str]) -> dict:
    return {c: {"low": row[f"low_{i}"], "high": row[f"high_{i}"]} for i, c in enumerate(columns)}


# --- reading -------------------------------------------------------------------

def _certain(spark: SparkSession, table: str, per_partition: bool) -> tuple[dict[Part, list], list, set[Part]]:
    """What is known: rows per partition, rows of appends to several, and partitions to measure.

    With ``per_partition`` an append to several partitions does not count as known. The
    statistics have a row per partition and change, which is what reaches the driver.
    """
    keys = catalog.partition_columns(spark, table)
    there = catalog.existing_partitions(spark, table) if keys else {()}
    rows = sorted(spark.table(statistics_table(table)).collect(), key=lambda r: r["entry"])
    parts_of = [[tuple(p) for p in r["partitions"]] for r in rows]
    since: dict[Part, str] = {}
    for r, parts in zip(rows, parts_of):
        if r["kind"] == REPLACED:
            since.update({p: r["entry"] for p in parts})
    unsure: set[Part] = set()
    known = {p for p in there if p in since}
    appends = []
    for r, parts in zip(rows, parts_of):
        if r["kind"] != APPENDED:
            continue
        live = {p for p in parts if since.get(p, "") < r["entry"] and p in there}
        known |= live
        if len(live) < len(parts) or (per_partition and len(parts) > 1):
            unsure |= live
        else:
            appends.append((r, live))
    unsure |= there - known
    # An append of which one partition is measured again no longer tells about the others.
    more = True
    while more:
        more = False
        for r, live in list(appends):
            if live & unsure:
                appends.remove((r, live))
                more = more or bool(live - unsure)
                unsure |= live
    sure: dict[Part, list] = {
        parts[0]: [r] for r, parts in zip(rows, parts_of)
        if r["kind"] == REPLACED and parts[0] in there - unsure and since[parts[0]] == r["entry"]
    }
    floating = []
    for r, live in appends:
        if len(live) == 1:
            sure.setdefault(next(iter(live)), []).append(r)
        else:
            floating.append(r)
    return sure, floating, unsure


def refresh(spark: SparkSession, table: str, per_partition: bool = False) -> set[Part]:
    """Measure what is not certain, and return these partitions. Only they are read."""
    unsure = _certain(spark, table, per_partition)[2]
    if not unsure:
        return unsure
    keys = catalog.partition_columns(spark, table)
    rows = spark.table(table)
    if keys:
        rows = rows.where(_among(rows, keys, unsure))
    found = measured(rows, keys, tracked(spark, table))
    seen = {tuple(r["partitions"][0]) for r in found}
    record(spark, table, entry_name(), found + emptied(sorted(unsure - seen)))
    return unsure


def _among(rows: DataFrame, keys: list[str], parts: set[Part]):
    """A condition on partition columns alone, so that only these partitions are listed."""
    def one(key: str, value: str):
        return F.col(key).isNull() if value == catalog.NULL_PARTITION else F.col(key) == F.lit(value).cast(rows.schema[key].dataType)

    condition = F.lit(False)
    for part in sorted(parts):
        met = F.lit(True)
        for key, value in zip(keys, part):
            met = met & one(key, value)
        condition = condition | met
    return condition


def watermarks(spark: SparkSession, table: str, columns: list[str]) -> dict[str, str | None]:
    """The largest value of each column as exact text, None for an empty table.

    No data file is read, unless some partition is not certain: then that one is.
    """
    missing = sorted(set(columns) - set(tracked(spark, table)))
    if missing:
        raise ValueError(f"{table} does not track {missing}")
    refresh(spark, table)
    sure, floating, _ = _certain(spark, table, False)
    rows = [r for held in sure.values() for r in held] + floating
    texts = spark.createDataFrame(
        [tuple((r["bounds"].get(c) or {"high": None})["high"] for c in columns) for r in rows] or [(None,) * len(columns)],
        T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(columns))]),
    )
    schema = spark.table(table).schema
    row = texts.agg(*[
        F.max(F.col(f"c{i}").cast(schema[c].dataType)).cast("string").alias(f"c{i}") for i, c in enumerate(columns)
    ]).first()
    return {c: row[f"c{i}"] for i, c in enumerate(columns)}


def row_counts(spark: SparkSession, table: str) -> dict[Part, int]:
    """Rows of every partition that has any; ``()`` names the whole of a table without partitions."""
    refresh(spark, table, per_partition=True)
    sure, _, _ = _certain(spark, table, True)
    counts = {p: sum(r["n_rows"] for r in held) for p, held in sure.items()}
    return {p: n for p, n in counts.items() if n}

"""JDBC tables: sliced and ranged reads, query pushdown, writes, size tiers."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Slices and range partitions of a read, and the size tiers.
SLICES = 10
RANGE_PARTITIONS = 200
RANGE_BOUNDS = (1, 10_000)
SIZE_TIERS = [(10_000, 1), (1_000_000, 10), (10_000_000, 100), (20_000_000, 500)]
LARGEST_TIER = 1000
VIEW_ROWS = 1_000_000
#: Rows of one partition beyond the largest tier: as many as where it begins.
TIER_ROWS = SIZE_TIERS[-1][0] // LARGEST_TIER


def slice_predicates(key: str, slices: int = SLICES) -> list[str]:
    """One predicate per slice of a stable numeric key; every row meets exactly one.

    Negative keys go by their absolute value, a fraction is cut off, and rows without a
    key go to slice 0.
    """
    predicates = [f"mod(floor(abs({key})), {slices}) = {i}" for i in range(slices)]
    predicates[0] = f"({predicates[0]} or {key} is null)"
    return predicates


def read_table(spark: SparkSession, url: str, table: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=table, **options).load()


def read_sliced(
    spark: SparkSession, url: str, table: str, key: str, slices: int = SLICES, **properties: str
) -> DataFrame:
    return spark.read.jdbc(
        url, table, predicates=slice_predicates(key, slices), properties=properties
    )


def range_options(
    column: str, bounds: tuple[int, int] = RANGE_BOUNDS, partitions: int = RANGE_PARTITIONS
) -> dict[str, str]:
    """Options of a range-partitioned read; rows beyond the bounds go to the end ranges."""
    return {
        "partitionColumn": column,
        "lowerBound": str(bounds[0]),
        "upperBound": str(bounds[1]),
        "numPartitions": str(partitions),
    }


def read_ranged(
    spark: SparkSession,
    url: str,
    table: str,
    column: str,
    bounds: tuple[int, int] = RANGE_BOUNDS,
    partitions: int = RANGE_PARTITIONS,
    **options: str,
) -> DataFrame:
    return read_table(spark, url, table, **range_options(column, bounds, partitions), **options)


def delta_condition(
    fields: list[str], begin: str | None, finish: str | None = None, source: str = ""
) -> str:
    """SQL for "newer than begin", or for ``[begin, finish)`` if both are given."""

    def literal(text: str) -> str:
        quoted = "'" + text.replace("'", "''") + "'"
        if source != "oracle":
            return quoted
        if "." in text:
            return f"to_timestamp({quoted}, 'yyyy-mm-dd hh24:mi:ss.ff')"
        return f"to_date({quoted}, 'yyyy-mm-dd hh24:mi:ss')"

    if begin is None:
        return "1 = 1"
    if finish is None:
        return " and ".join(f"{f} > {literal(begin)}" for f in fields)
    return " and ".join(f"{f} >= {literal(begin)} and {f} < {literal(finish)}" for f in fields)


def subquery(table: str, condition: str = "", source: str = "") -> str:
    """A table expression that the database itself filters (Oracle takes no alias here)."""
    if not condition:
        return table
    return f"(select * from {table} where {condition})" + ("" if source == "oracle" else " t")


def day_before(today: dt.date) -> tuple[str, str]:
    """Yesterday 00:00 and today 00:00 as the texts of a delta range."""
    yesterday = today - dt.timedelta(days=1)
    return f"{yesterday} 00:00:00", f"{today} 00:00:00"


def write_table(df: DataFrame, url: str, table: str, overwrite: bool = False, **properties: str) -> None:
    """Append, or empty the remote table and fill it; the table itself is kept."""
    writer = df.write.mode("overwrite" if overwrite else "append")
    if overwrite:
        writer = writer.option("truncate", "true")
    writer.jdbc(url, table, properties=properties)


def size_tier(rows: Column) -> Column:
    """Number of partitions for a row count; beyond the largest tier it grows with the rows."""
    tier = F.when(rows < SIZE_TIERS[0][0], F.lit(SIZE_TIERS[0][1]))
    for limit, partitions in SIZE_TIERS[1:]:
        tier = tier.when(rows < limit, F.lit(partitions))
    return tier.otherwise(
        F.greatest(F.lit(LARGEST_TIER), F.ceil(rows / F.lit(TIER_ROWS)).cast("int"))
    )


def row_estimate(name: str, counted: int | None) -> int | None:
    """A view counts as a million rows; a table without a count stays unknown."""
    return VIEW_ROWS if "view" in name.lower() else counted


def partitions_for(rows: int) -> int:
    return next((p for limit, p in SIZE_TIERS if rows < limit),
                max(LARGEST_TIER, -(-rows // TIER_ROWS)))


def repartition_by_size(df: DataFrame, rows: int | None) -> DataFrame:
    """Deal a table over the partitions of its size; without a known count it stays as read."""
    return df if rows is None else df.repartition(partitions_for(rows))


# Where each kind of database keeps its column comments.
METADATA = {
    "oracle": {"table": "all_col_comments", "owner_column": "owner", "table_column": "table_name",
               "name_column": "column_name", "comment_column": "comments"},
    "mysql": {"table": "INFORMATION_SCHEMA.COLUMNS", "owner_column": "table_schema",
              "table_column": "table_name", "name_column": "column_name",
              "comment_column": "column_comment"},
}
METADATA["sqlserver"] = METADATA["mysql"]


@dataclass(frozen=True)
class Source:
    """A database to import from: its kind, address, and how tables are cut for reading.

    ``slice_keys`` and ``range_columns`` name the column of a table that a sliced or a
    ranged read goes by; any other table is read in one piece, and dealt over partitions
    afterwards if ``rows`` knows its size. ``owner`` is the schema whose metadata counts.
    """

    kind: str
    url: str
    owner: str | None = None
    properties: dict[str, str] = field(default_factory=dict)
    slice_keys: dict[str, str] = field(default_factory=dict)
    range_columns: dict[str, str] = field(default_factory=dict)
    rows: dict[str, int] = field(default_factory=dict)

    def __post_init__(self) -> None:
        if self.kind not in METADATA:
            raise ValueError(f"the kind of a source is one of {tuple(METADATA)}, not {self.kind!r}")

    def read(self, spark: SparkSession, table: str, condition: str = "") -> DataFrame:
        """A table, or its rows that meet a condition which the database itself applies."""
        asked = subquery(table, condition, self.kind)
        if table in self.slice_keys:
            return read_sliced(spark, self.url, asked, self.slice_keys[table], **self.properties)
        if table in self.range_columns:
            return read_ranged(spark, self.url, asked, self.range_columns[table], **self.properties)
        df = read_table(spark, self.url, asked, **self.properties)
        return repartition_by_size(df, None if condition else row_estimate(table, self.rows.get(table)))

    def metadata(self, spark: SparkSession) -> DataFrame:
        return read_table(spark, self.url, METADATA[self.kind]["table"], **self.properties)

    def comment_columns(self) -> dict[str, str]:
        return {k: v for k, v in METADATA[self.kind].items() if k != "table"}

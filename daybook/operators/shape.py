"""Schema operators: names, casts, comments, unions."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Characters not allowed in names, vendor prefixes, accepted type names,
# the default cast map, and the time zone of epoch columns.
ILLEGAL_CHARACTERS = r"[,;{}()\n\t\r]"
VENDOR_RESERVED = r"t\$(date|full|conf|user)"
VENDOR_PREFIX = r"t\$"
TYPE_NAMES = {
    "void": "void",
    "null": "void",
    "date": "date",
    "timestamp": "timestamp",
    "binary": "binary",
    "integer": "int",
    "boolean": "boolean",
    "long": "bigint",
    "double": "double",
    "float": "float",
    "short": "smallint",
    "byte": "tinyint",
    "string": "string",
    "interval": "interval",
    "calendarinterval": "interval",
    "calendar interval": "interval",
    "decimal": "decimal(38,18)",
}
SIZED_DECIMAL = r"decimal\(\s*(\d+)\s*,\s*(-?\d+)\s*\)"
DEFAULT_CASTS = {"date": "string", "decimal": "double"}
EPOCH_ZONE = "UTC+8"


def _quoted(name: str):
    return F.col("`" + name.replace("`", "``") + "`")


def _renamed(df: DataFrame, names: list[str]) -> DataFrame:
    clashes = [n for n, times in Counter(n.lower() for n in names).items() if times > 1]
    if clashes:
        raise ValueError(f"columns fall together under one name: {clashes}")
    return df.toDF(*names)


def strip_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [re.sub(ILLEGAL_CHARACTERS, "", c) for c in df.columns])


def lower_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [c.lower() for c in df.columns])


def vendor_name(name: str) -> str:
    """``T$DATE`` to ``t_date``, other ``t$`` prefixes away, any other ``$`` to ``_``.

    The prefix is taken out wherever it stands: ``amount$x`` becomes ``amounx``.
    """
    name = re.sub(VENDOR_RESERVED, r"t_\1", name.lower())
    return re.sub(VENDOR_PREFIX, "", name).replace("$", "_")


def vendor_names(df: DataFrame) -> DataFrame:
    return _renamed(df, [vendor_name(c) for c in df.columns])


def sql_type(name: str) -> str:
    """The SQL type for a type name; a name that is not known is an error."""
    if name in TYPE_NAMES:
        return TYPE_NAMES[name]
    sized = re.fullmatch(SIZED_DECIMAL, name)
    if not sized:
        raise ValueError(f"not a type name: {name!r}")
    return f"decimal({sized[1]},{sized[2]})"


def cast_by_type_name(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast columns to types given by name; a value that does not fit becomes null."""
    return df.select([
        _quoted(c).try_cast(sql_type(types[c])).alias(c) if c in types else _quoted(c)
        for c in df.columns
    ])


def cast_by_type_map(df: DataFrame, casts: dict[str, str] | None = None) -> DataFrame:
    """Cast every column whose type the map names; any decimal counts as ``decimal``."""
    casts = DEFAULT_CASTS if casts is None else casts

    def target(field: T.StructField) -> str | None:
        name = "decimal" if isinstance(field.dataType, T.DecimalType) else field.dataType.typeName()
        return casts.get(name)

    return cast_by_type_name(df, {f.name: target(f) for f in df.schema.fields if target(f)})


def cast_to_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """Cast by name to a target schema; columns the target lacks stay as they are."""
    types = {f.name: f.dataType for f in target.fields}
    missing = [n for n in types if n not in df.columns]
    if missing:
        raise ValueError(f"columns missing for the target: {missing}")
    return df.select([
        _quoted(c).try_cast(types[c]).alias(c) if c in types and types[c] != df.schema[c].dataType
        else _quoted(c)
        for c in df.columns
    ])


def with_comments(df: DataFrame, comments: dict[str, str]) -> DataFrame:
    """Attach column comments; a column without one stays as it is."""
    return df.select([
        _quoted(c).alias(c, metadata={**df.schema[c].metadata, "comment": comments[c]})
        if c in comments else _quoted(c)
        for c in df.columns
    ])


def column_comments(
    metadata: DataFrame,
    table: str,
    owner: str | None = None,
    owner_column: str = "table_schema",
    table_column: str = "table_name",
    name_column: str = "column_name",
    comment_column: str = "column_comment",
) -> DataFrame:
    """(column_name, comment) of one table out of a column-metadata table.

    Tables compare without case, line breaks and tabs become commas, a missing
    comment becomes blank.
    """
    rows = metadata.where(F.lower(table_column) == table.lower())
    if owner is not None:
        rows = rows.where(F.col(owner_column) == owner)
    flat = F.trim(F.translate(comment_column, "\r\n\t", ",,,"))
    return rows.select(
        F.col(name_column).alias("column_name"), F.coalesce(flat, F.lit("")).alias("comment")
    )


def comments_of(df: DataFrame) -> dict[str, str]:
    return {f.name: f.metadata["comment"] for f in df.schema.fields if "comment" in f.metadata}


def epoch_to_timestamp(column):
    """Epoch milliseconds, cut to the second, as a time of the fixed zone, in UTC.

    Whole division, so times before 2001 and before 1970 are right too.
    """
    millis = column.try_cast("bigint")
    seconds = ((millis - F.pmod(millis, F.lit(1000))) / 1000).cast("bigint")
    return F.to_utc_timestamp(F.from_unixtime(seconds), EPOCH_ZONE)


def safe_union(left: DataFrame, right: DataFrame) -> DataFrame:
    """Union by name of frames whose columns or types differ.

    Names are lower-cased, a column one side lacks is null there, and where one
    side holds an epoch number and the other a timestamp the number is converted.
    """
    left, right = lower_names(left), lower_names(right)
    return _align_epochs(left, right).unionByName(
        _align_epochs(right, left), allowMissingColumns=True
    )


def _align_epochs(df: DataFrame, other: DataFrame) -> DataFrame:
    times = {
        f.name: f.dataType for f in other.schema.fields
        if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType))
    }
    return df.select([
        epoch_to_timestamp(_quoted(f.name)).cast(times[f.name]).alias(f.name)
        if f.name in times and isinstance(f.dataType, T.LongType) else _quoted(f.name)
        for f in df.schema.fields
    ])


def union_pages(pages: list[DataFrame]) -> DataFrame:
    """Union of page frames by name; a page without columns is skipped."""
    filled = [p for p in pages if p.columns]
    if not filled:
        raise ValueError("every page is empty")
    result = filled[0]
    for page in filled[1:]:
        result = result.unionByName(page)
    return result

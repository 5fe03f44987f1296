"""Pages whose rows change their shape: new, missing and retyped fields.

Rows are read as variants, so no schema has to be right beforehand. One aggregate over all
rows says which fields there are and of what type; only that schema reaches the driver. A
target grows by the new fields that a rule admits. What a target column cannot take, and
fields the rule does not admit, are kept as text in one column of the row, not lost.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import scrub_json_text
from daybook.operators import tables
from daybook.sources.pages import ENVELOPES

#: Column with the values that have no place: a map from field to its text.
RESCUED = "rescued"
RESCUED_TYPE = T.MapType(T.StringType(), T.StringType())


@dataclass(frozen=True)
class Rule:
    """What a load may add to its target.

    ``names`` is a pattern that the whole name of a new field has to match, ``at_most`` the
    number of fields that one load may add: more are taken for a fault of the source, and
    the load fails. With ``retyped="fail"`` so does a value that its column cannot take.
    """

    names: str = r"[A-Za-z_][A-Za-z0-9_]*"
    at_most: int = 20
    retyped: str = "rescue"


@dataclass(frozen=True)
class Drift:
    """How the fields of a load differ from its target."""

    added: dict[str, T.DataType] = field(default_factory=dict)
    missing: list[str] = field(default_factory=list)
    retyped: dict[str, tuple[T.DataType, T.DataType]] = field(default_factory=dict)
    refused: list[str] = field(default_factory=list)


def read_items(spark: SparkSession, path: str, envelope: str = "post", scrub: bool = False) -> DataFrame:
    """The rows of all pages as variants, one column ``item``.

    A page that is not JSON, or whose rows are not an array, fails the load with its name.
    A page without rows, or with a null in their place, has none.
    """
    array = ENVELOPES[envelope][2]
    value = scrub_json_text(F.col("value")) if scrub else F.col("value")
    pages = spark.read.text(path).select(
        F.try_parse_json(value).alias("page"), F.col("_metadata.file_path").alias("_page")
    )
    rows = F.try_variant_get("page", F.lit(f"$.{array}"), "array<variant>")
    bad = F.col("page").isNull() | (rows.isNull() & F.try_variant_get("page", F.lit(f"$.{array}"), "string").isNotNull())
    whole = F.when(~bad, rows).otherwise(
        F.raise_error(F.concat(F.lit("page "), "_page", F.lit(" is not valid"))).cast("array<variant>"))
    return pages.select(F.explode(whole).alias("item"))


def fields_of(items: DataFrame) -> dict[str, T.DataType]:
    """The fields that the rows have, and a type that holds all their values.

    Numbers widen to the wider one; a field of several kinds is a string, and so are nested
    ones. A field that is null in every row has the null type.
    """
    text = items.agg(F.schema_of_variant_agg("item").alias("s")).first()["s"]
    if not text.startswith("OBJECT<"):
        return {}
    found = T.DataType.fromDDL(re.sub(r"\bOBJECT<", "STRUCT<", text))
    return {f.name: _flat(f.dataType) for f in found.fields}


def _flat(kind: T.DataType) -> T.DataType:
    if isinstance(kind, (T.LongType, T.BooleanType, T.DoubleType, T.StringType, T.NullType)):
        return kind
    if isinstance(kind, T.DecimalType):
        return T.LongType() if kind.scale == 0 and kind.precision <= 18 else T.DoubleType()
    return T.StringType()


def compare(found: dict[str, T.DataType], target: T.StructType, rule: Rule) -> Drift:
    """Names are compared without case, as the catalog does."""
    own = {f.name.lower(): f for f in target.fields if f.name != RESCUED}
    added, refused, retyped = {}, [], {}
    for name, kind in found.items():
        known = own.get(name.lower())
        if known is None:
            if isinstance(kind, T.NullType):
                continue  # no row says what it is
            if re.fullmatch(rule.names, name) and name.lower() not in {n.lower() for n in added}:
                added[name] = kind
            else:
                refused.append(name)
        elif not _takes(known.dataType, kind):
            retyped[known.name] = (known.dataType, kind)
    here = {n.lower() for n in found}
    return Drift(added, [f.name for n, f in own.items() if n not in here], retyped, refused)


_WIDTHS = [T.LongType(), T.DoubleType(), T.StringType()]


def _takes(target: T.DataType, found: T.DataType) -> bool:
    """Whether every value of the type found has a place in the target's type."""
    if target == found or isinstance(found, T.NullType) or isinstance(target, T.StringType):
        return True
    return target in _WIDTHS and found in _WIDTHS and _WIDTHS.index(target) > _WIDTHS.index(found)


def shaped(items: DataFrame, target: T.StructType, drift: Drift) -> DataFrame:
    """Rows with the target's columns and the added ones; what has no place is rescued."""
    names = {f.name: f.dataType for f in target.fields if f.name != RESCUED} | drift.added
    columns = {n: _value(n, t) for n, t in names.items()}
    lost = [
        F.when(_text(n).isNotNull() & columns[n].isNull(), F.struct(F.lit(n).alias("key"), _text(n).alias("value")))
        for n in drift.retyped
    ] + [
        F.when(_text(n).isNotNull(), F.struct(F.lit(n).alias("key"), _text(n).alias("value"))) for n in drift.refused
    ]
    rescued = F.lit(None).cast(RESCUED_TYPE)
    if lost:
        kept = F.array_compact(F.array(*lost))
        rescued = F.when(F.size(kept) > 0, F.map_from_entries(kept))
    return items.select(*[c.alias(n) for n, c in columns.items()], rescued.cast(RESCUED_TYPE).alias(RESCUED))


def _path(name: str) -> Column:
    return F.lit("$['" + name.replace("'", "\\'") + "']")


def _text(name: str) -> Column:
    return F.try_variant_get("item", _path(name), "string")


def _value(name: str, kind: T.DataType) -> Column:
    value = F.try_variant_get("item", _path(name), kind.simpleString())
    if isinstance(kind, T.IntegralType):
        # A fraction would be cut off; it does not fit.
        exact = F.try_variant_get("item", _path(name), "decimal(38,10)")
        return F.when(exact.isNull() | (exact == value), value)
    return value


def load(
    spark: SparkSession, path: str, table: str, envelope: str = "post", rule: Rule = Rule(), scrub: bool = False
) -> Drift:
    """Append the rows of a folder of pages, after the table has grown by what is new.

    The table gets the column ``rescued`` with its first drifting load. Missing fields are
    null. Two passes over the pages: one for the schema, one for the rows.
    """
    items = read_items(spark, path, envelope, scrub)
    target = spark.table(table).schema
    drift = compare(fields_of(items), target, rule)
    if len(drift.added) > rule.at_most:
        raise ValueError(f"{path} has {len(drift.added)} new fields, more than {rule.at_most}: {sorted(drift.added)}")
    if drift.retyped and rule.retyped == "fail":
        raise ValueError(f"{path} has fields of other types than {table}: {drift.retyped}")
    new = {n: t for n, t in drift.added.items()}
    if RESCUED not in target.names and (drift.retyped or drift.refused):
        new[RESCUED] = RESCUED_TYPE
    if new:
        columns = ", ".join(f"`{n}` {t.simpleString()}" for n, t in new.items())
        spark.sql(f"ALTER TABLE {table} ADD COLUMNS ({columns})")
    rows = shaped(items, target, drift)
    tables.append(rows, table)
    return drift

"""Pages that cannot be loaded go to a side table instead of failing the whole load.

One pass over the pages parses them and writes them aside, good ones as rows, bad ones as
text with their reason and file. How many are bad is observed on the way. Only then, and only
if they are within the limit, do the rows go to their target and the bad pages to the side
table.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook.functions.text import scrub_json_text
from daybook.operators.tables import full_refresh
from daybook.session import workspace
from daybook.sources.pages import ENVELOPES, booleans_as_text, with_booleans

# Why a page is bad.
NOT_JSON, NO_ROWS, OTHER_TYPES, OTHER_COUNT = (
    "not valid JSON", "no array of rows", "values of other types", "another number of rows than its count",
)
SIDE = T.StructType([T.StructField(n, T.StringType()) for n in ("load", "loaded_at", "file", "reason", "page")])


class TooManyBadPages(Exception):
    """The limit of a load is exceeded; neither the target nor the side table has changed."""


@dataclass(frozen=True)
class Split:
    good_pages: int
    bad_pages: int
    rows: DataFrame
    bad: DataFrame


def create_side_table(spark: SparkSession, table: str) -> None:
    columns = ", ".join(f"`{n}` string" for n in SIDE.names)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet")


def parsed(
    pages: DataFrame, item: T.StructType, envelope: str = "post", scrub: bool = False
) -> DataFrame:
    """Pages (value, file) to (file, page, reason, rows); a good page's reason is null.

    A page without rows, or with a null in their place, is good if its count does not say
    otherwise; so is a page without a count. A boolean may be landed as text, and is still
    text in ``rows``. A blank page is not JSON.
    """
    make, count, array = ENVELOPES[envelope]
    schema = T.StructType([*make(booleans_as_text(item)).fields, T.StructField("_corrupt", T.StringType())])
    value = scrub_json_text(F.col("value")) if scrub else F.col("value")
    known = pages.select("file", "value", value.alias("text")).select(
        "file", "value", F.try_parse_json("text").alias("json"),
        F.from_json("text", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}).alias("read"),
    )
    field = F.lit(f"$.{array}")
    kind = F.schema_of_variant(F.try_variant_get("json", field, "variant"))
    reason = (
        F.when(F.col("json").isNull(), NOT_JSON)
        .when(~F.schema_of_variant("json").startswith("OBJECT"), NO_ROWS)
        .when(~F.coalesce(kind, F.lit("VOID")).rlike("^(ARRAY|VOID)"), NO_ROWS)
        .when(F.col("read._corrupt").isNotNull(), OTHER_TYPES)
        .when(F.col(f"read.{count}") != F.coalesce(F.array_size(f"read.{array}"), F.lit(0)), OTHER_COUNT)
    )
    return known.select("file", "value", reason.alias("reason"), F.col(f"read.{array}").alias("rows")).select(
        "file", F.when(F.col("reason").isNotNull(), F.col("value")).alias("page"), "reason",
        F.when(F.col("reason").isNull(), F.col("rows")).alias("rows"),
    )


def split(
    spark: SparkSession, path: str, item: T.StructType, envelope: str = "post", scrub: bool = False
) -> Split:
    """Read, parse and write aside the pages under a path, all in one pass."""
    pages = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file"))
    return _split(pages, item, envelope, scrub)


def _split(pages: DataFrame, item: T.StructType, envelope: str, scrub: bool) -> Split:
    spark = pages.sparkSession
    watch = Observation()
    aside = workspace(spark, "quarantine")
    bad = F.col("reason").isNotNull()
    all_pages = parsed(pages, item, envelope, scrub).withColumn("state", F.when(bad, "bad").otherwise("good"))
    all_pages.observe(
        watch, F.count_if(bad).alias("bad"), F.count_if(~bad).alias("good")
    ).write.partitionBy("state").parquet(aside)
    schema = T.StructType([*all_pages.drop("state").schema.fields, T.StructField("state", T.StringType())])
    kept = spark.read.schema(schema).parquet(aside)
    rows = with_booleans(kept.where("state = 'good'").select(F.inline("rows")), item)
    counts = watch.get if _wrote(spark, aside) else {"bad": 0, "good": 0}
    return Split(counts["good"], counts["bad"], rows, kept.where("state = 'bad'").select("file", "reason", "page"))


def _wrote(spark: SparkSession, folder: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    return any(s.isDirectory() for s in files.listStatus(place))


def load(
    spark: SparkSession,
    path: str,
    item: T.StructType,
    writer: Callable[[DataFrame], object],
    side_table: str,
    name: str,
    envelope: str = "post",
    scrub: bool = False,
    max_bad: int | None = None,
    max_share: float | None = 0.1,
) -> Split:
    """Give the rows of good pages to a writer and put bad pages into the side table.

    The load fails with :class:`TooManyBadPages`, and changes nothing, if more than
    ``max_bad`` pages or more than ``max_share`` of all pages are bad. ``writer`` is called
    once; if it raises, the side table has not changed either.
    """
    found = split(spark, path, item, envelope, scrub)
    pages = found.good_pages + found.bad_pages
    if (max_bad is not None and found.bad_pages > max_bad) or (
        max_share is not None and pages and found.bad_pages > max_share * pages
    ):
        reasons = found.bad.groupBy("reason").count().orderBy("reason").collect()
        raise TooManyBadPages(f"{found.bad_pages} of {pages} pages of {name} are bad: "
                              + ", ".join(f"{r['reason']} ({r['count']})" for r in reasons))
    writer(found.rows)
    if found.bad_pages:
        _keep(found.bad, side_table, name)
    return found


def _keep(bad: DataFrame, side_table: str, name: str) -> None:
    at = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    bad.select(
        F.lit(name).alias("load"), F.lit(at).alias("loaded_at"), "file", "reason", "page"
    ).write.insertInto(side_table)


def release(
    spark: SparkSession,
    side_table: str,
    item: T.StructType,
    writer: Callable[[DataFrame], object],
    name: str,
    envelope: str = "post",
    repair: Callable[[Column], Column] | None = None,
    scrub: bool = False,
) -> Split:
    """Parse the kept pages of a load again, repaired, and load those that are good now.

    What is still bad stays in the side table with its new reason; other loads' pages stay
    as they are.
    """
    own = F.col("load") == name
    value = repair(F.col("page")) if repair else F.col("page")
    found = _split(spark.table(side_table).where(own).select(value.alias("value"), "file"), item, envelope, scrub)
    if found.good_pages:
        writer(found.rows)
    at = dt.datetime.now().strftime("%Y-%m-%d %H:%M:%S")
    still = found.bad.select(F.lit(name).alias("load"), F.lit(at).alias("loaded_at"), "file", "reason", "page")
    full_refresh(spark.table(side_table).where(~own).unionByName(still), side_table, staged=True)
    return found

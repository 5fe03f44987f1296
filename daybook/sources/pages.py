"""Landed JSON pages: one document per page, an envelope around an array of rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from daybook import schemas
from daybook.functions.text import scrub_json_text
from daybook.operators.ids import sequential_id
from daybook.operators.shape import strip_names
from daybook.operators.tables import full_overwrite

# Fixed value: rows per page.
PAGE_ROWS = 5000
#: Pages of a day that are landed as a folder each; of a longer day, many share a file.
FOLDER_PAGES = 20
#: Rows of the pages that are landed together in one file.
BLOCK_ROWS = 50_000
#: What a folder that holds one pull of a table is called, before its number.
PULL = "pull="

ENVELOPES = {
    "post": (schemas.post_envelope, "count", "items"),
    "get": (schemas.get_envelope, "Count", "Result"),
}


def read_pages(
    spark: SparkSession,
    path: str,
    item: T.StructType,
    envelope: str = "post",
    scrub: bool = False,
    distinct: bool = False,
) -> DataFrame:
    """All rows of all pages under ``path``.

    The schema is declared, so an empty page, an all-null column or another column
    order changes nothing. A page that is not valid, or whose count differs from its
    rows, fails the load instead of losing rows. A boolean may be landed as text; one that
    is neither true nor false is null. ``scrub`` repairs the raw text first; ``distinct``
    drops the repeats of overlapping GET pages.
    """
    _, count, array = ENVELOPES[envelope]
    pages = _pages(spark, path, item, envelope, scrub)
    held = F.coalesce(F.array_size(array), F.lit(0))
    whole = F.when(F.coalesce(F.col(count) == held, F.lit(True)), F.col(array)).otherwise(
        F.raise_error(F.concat(
            F.lit("page "), "_page", F.lit(" has "), held.cast("string"), F.lit(" rows, but says "),
            F.col(count).cast("string"),
        ))
    )
    rows = with_booleans(pages.select(F.inline(whole)), item)
    return rows.distinct() if distinct else rows


def page_counts(
    spark: SparkSession, path: str, item: T.StructType, envelope: str = "post", scrub: bool = False
) -> DataFrame:
    """One row per page: page (its file), declared, held, complete.

    A page without a count declares nothing and counts as complete.
    """
    _, count, array = ENVELOPES[envelope]
    held = F.coalesce(F.array_size(array), F.lit(0))
    return _pages(spark, path, item, envelope, scrub).select(
        F.col("_page").alias("page"), F.col(count).alias("declared"), held.alias("held"),
        F.coalesce(F.col(count) == held, F.lit(True)).alias("complete"),
    )


def _is_boolean(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.BooleanType)


def booleans_as_text(item: T.StructType) -> T.StructType:
    return T.StructType([
        T.StructField(f.name, T.StringType()) if _is_boolean(f) else f for f in item.fields
    ])


def with_booleans(rows: DataFrame, item: T.StructType) -> DataFrame:
    """Booleans that were read as text; one that is neither true nor false is null."""
    return rows.select([
        F.col(f"`{f.name}`").try_cast("boolean").alias(f.name) if _is_boolean(f) else F.col(f"`{f.name}`")
        for f in item.fields
    ])


def _pages(spark: SparkSession, path: str, item: T.StructType, envelope: str, scrub: bool) -> DataFrame:
    """The envelopes under a path, and the file each comes from; booleans still as text."""
    schema = ENVELOPES[envelope][0](booleans_as_text(item))
    if scrub:
        return spark.read.text(path).select(
            F.from_json(scrub_json_text(F.col("value")), schema, {"mode": "FAILFAST"}).alias("page"),
            F.col("_metadata.file_path").alias("_page"),
        ).select("page.*", "_page")
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path).select(
        *schema.names, F.col("_metadata.file_path").alias("_page")
    )


def newest_pull(spark: SparkSession, path: str) -> str:
    """The folder of the newest pull of a landing folder, or the folder itself without pulls.

    Pulls are folders ``pull=<number>``, compared as numbers and named as they are, leading
    zeros and all. Only folder names are listed; no page is read.
    """
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return path
    names = [s.getPath().getName() for s in files.listStatus(folder) if s.isDirectory()]
    pulls = [n for n in names if n.removeprefix(PULL).isdigit() and n.startswith(PULL)]
    if not pulls:
        return path
    return f"{path}/{max(pulls, key=lambda n: (int(n.removeprefix(PULL)), n))}"


def land_pages(
    df: DataFrame, path: str, *order_by: str, envelope: str = "post", page_rows: int = PAGE_ROWS
) -> None:
    """Write a frame as page documents of at most ``page_rows`` rows."""
    _, count, array = ENVELOPES[envelope]
    numbered = sequential_id(df, "_row", *order_by)
    page = F.expr(f"(_row - 1) div {page_rows}")
    (
        numbered.groupBy(page.alias("_page"))
        .agg(F.collect_list(F.struct(*df.columns)).alias(array))
        .select(F.to_json(
            F.struct(F.size(array).alias(count), F.col(array)), {"ignoreNullFields": "false"}
        ).alias("value"))
        .write.text(path)
    )


def land_requests(
    df: DataFrame, path: str, key: str, *order_by: str, envelope: str = "post", page_rows: int = PAGE_ROWS
) -> None:
    """Write a frame as the answers of a paged source, from page 1 of each day.

    Every page declares the rows of its whole day, as such a source does. Rows are numbered
    over all days at once, so a day may be larger than a task. A day of few pages has a folder
    ``<key>=<day>/page=<number>/`` for each. Of a day with more than ``FOLDER_PAGES`` pages, those
    of about ``BLOCK_ROWS`` rows lie in ``<key>=<day>/page=<first>-<last>/``, a line for each, in
    order: its number, a tab and the document. So files grow with rows, not with pages.
    """
    _, count, array = ENVELOPES[envelope]
    size = max(1, BLOCK_ROWS // page_rows)
    numbered = sequential_id(df, "_row", key, *order_by)
    days = numbered.groupBy(F.col(key).alias("_day")).agg(
        F.min("_row").alias("_first"), F.count(F.lit(1)).cast("int").alias("_total"))
    paged = numbered.join(F.broadcast(days), F.col(key) == F.col("_day")).withColumn(
        "_page", F.expr(f"(_row - _first) div {page_rows} + 1"))
    pages, block = f"((_total - 1) div {page_rows} + 1)", f"((_page - 1) div {size} * {size} + 1)"
    folder = F.expr(
        f"if({pages} <= {FOLDER_PAGES}, string(_page), "
        f"concat({block}, '-', least({block} + {size - 1}, {pages})))")
    document = F.to_json(F.struct(F.col("_total").alias(count), F.col(array)), {"ignoreNullFields": "false"})
    number = F.when(F.col("_folder").contains("-"), F.concat(F.col("_page").cast("string"), F.lit("\t")))
    (
        paged.withColumn("_folder", folder).repartition("_day", "_folder")
        .groupBy("_day", "_folder", "_page", "_total").agg(F.collect_list(F.struct(*df.columns)).alias(array))
        .sortWithinPartitions("_day", "_folder", "_page")
        .select(F.col("_day").alias(key), F.col("_folder").alias("page"),
                F.concat(F.coalesce(number, F.lit("")), document).alias("value"))
        .write.partitionBy(key, "page").text(path)
    )


def landing_to_table(
    spark: SparkSession, path: str, item: T.StructType, table: str, envelope: str = "post",
    scrub: bool = False,
) -> bool:
    """Pages to a table made anew, with names cleaned."""
    return full_overwrite(strip_names(read_pages(spark, path, item, envelope, scrub)), table)

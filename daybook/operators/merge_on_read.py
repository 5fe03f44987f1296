"""A keyed table that writes only the batch: a base, numbered deltas, and a view over both.

Rows lie in partitions (bucket of the key, sequence number). Sequence 0 is the base; every
batch adds the next number, with one partition for each bucket it touches, so the bytes
written follow the batch, not the table. Reading takes of every key the row of the largest
number. Buckets without deltas are read as they are; in the others the base is joined with
the deltas' keys only. Compaction makes a new base of the buckets whose deltas have grown
beyond a share of their base, in one replacement of the journal.

A table has one writer at a time; readers need not wait for it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators import catalog, journal
from daybook.operators.keys import KEY_BUCKET, latest_per_key, repeated_key, with_key_bucket

SEQUENCE, DELETED = "key_sequence", "key_deleted"
PARTITIONS = [KEY_BUCKET, SEQUENCE]
KEYS_PROPERTY, BUCKETS_PROPERTY = "daybook.merge_keys", "daybook.merge_buckets"

#: Rows of deltas for each row of the base beyond which a bucket is compacted.
RATIO = 0.25


def create(df: DataFrame, table: str, keys: list[str], buckets: int, latest_by: str | None = None) -> None:
    """Create the table with its first rows; a key is held once (see :func:`write`)."""
    rows = _layer(_unique(df, keys, latest_by), keys, buckets, 0, F.lit(False))
    rows.hint("rebalance", *PARTITIONS).write.mode("overwrite").partitionBy(*PARTITIONS).saveAsTable(table)
    names = ",".join(keys)
    df.sparkSession.sql(
        f"ALTER TABLE {table} SET TBLPROPERTIES ('{KEYS_PROPERTY}' = '{names}', '{BUCKETS_PROPERTY}' = '{buckets}')"
    )


def layout(spark: SparkSession, table: str) -> tuple[list[str], int] | None:
    """Key columns and number of buckets of such a table, else None."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(
        F.col("key").isin(KEYS_PROPERTY, BUCKETS_PROPERTY)
    ).collect()
    found = {r["key"]: r["value"] for r in rows}
    if len(found) < 2:
        return None
    return found[KEYS_PROPERTY].split(","), int(found[BUCKETS_PROPERTY])


def columns(spark: SparkSession, table: str) -> list[str]:
    """The table's own columns, without those that order its rows."""
    return [c for c in spark.table(table).columns if c not in (*PARTITIONS, DELETED)]


def write(
    new: DataFrame, table: str, latest_by: str | None = None, deleted: Column | None = None
) -> int | None:
    """Add a batch: its rows replace those of the same keys, and where ``deleted`` holds the key goes.

    Of rows with the same key within the batch the one with the largest ``latest_by`` counts;
    without that column a repeated key is an error. Nulls in a key equal each other. Returns
    the batch's number, or None for an empty batch. A batch that breaks off leaves nothing,
    or is finished by the next writer.
    """
    spark = new.sparkSession
    keys, buckets = _layout(spark, table)
    journal.recover(spark, table)
    number = max((int(s) for _, s in catalog.existing_partitions(spark, table)), default=0) + 1
    gone = F.coalesce(deleted, F.lit(False)) if deleted is not None else F.lit(False)
    own = new.select(*columns(spark, table), gone.alias(DELETED))
    rows = _layer(_unique(own, keys, latest_by), keys, buckets, number, F.col(DELETED))
    written = journal.replace(rows.select(spark.table(table).columns), table, PARTITIONS, [])
    return number if written else None


def read(spark: SparkSession, table: str) -> DataFrame:
    """The rows as they are now: of every key the newest one, without deleted keys."""
    return _current(spark, table, spark.table(table)).select(*columns(spark, table))


def create_view(spark: SparkSession, table: str, view: str) -> None:
    """The same as a view, which follows later batches and compactions."""
    keys, _ = _layout(spark, table)
    own = columns(spark, table)
    held = ", ".join(f"`{c}`" for c in own)
    same = " AND ".join(f"d.`{k}` <=> b.`{k}`" for k in [KEY_BUCKET, *keys])
    by = ", ".join(f"`{k}`" for k in [KEY_BUCKET, *keys])
    rest = ", ".join(f"`{c}`" for c in [DELETED, *own])
    spark.sql(f"""
        CREATE OR REPLACE VIEW {view} AS
        SELECT {held} FROM {table} b WHERE {SEQUENCE} = 0 AND NOT EXISTS (
            SELECT 1 FROM {table} d WHERE d.{SEQUENCE} > 0 AND {same})
        UNION ALL
        SELECT {', '.join(f'newest.`{c}`' for c in own)} FROM (
            SELECT max_by(struct({rest}), {SEQUENCE}) AS newest FROM {table} WHERE {SEQUENCE} > 0 GROUP BY {by})
        WHERE NOT newest.{DELETED}""")


def delta_rows(spark: SparkSession, table: str) -> DataFrame:
    """Per bucket: rows of the base, rows of the deltas. Reads no column of the data."""
    delta = F.col(SEQUENCE) > 0
    return spark.table(table).groupBy(KEY_BUCKET).agg(
        F.count_if(~delta).alias("base_rows"), F.count_if(delta).alias("delta_rows")
    )


def compact(spark: SparkSession, table: str, ratio: float = RATIO) -> list[int]:
    """Make a new base of the buckets with more rows of deltas than ``ratio`` of their base.

    Returns these buckets. What is read does not change. A compaction that breaks off is
    undone or finished by the next writer.
    """
    journal.recover(spark, table)
    # Their number is set when the table is made; it does not grow with the rows.
    full = [r[KEY_BUCKET] for r in delta_rows(spark, table).where(
        F.col("delta_rows") > ratio * F.col("base_rows")).collect()]
    if not full:
        return []
    rows = _current(spark, table, spark.table(table).where(F.col(KEY_BUCKET).isin(full)))
    base = rows.withColumns({SEQUENCE: F.lit(0).cast("long"), DELETED: F.lit(False)})
    parts = [p for p in catalog.existing_partitions(spark, table) if int(p[0]) in set(full)]
    journal.replace(base.select(spark.table(table).columns), table, PARTITIONS, parts)
    return sorted(full)


# --- internals ---------------------------------------------------------------

def _layout(spark: SparkSession, table: str) -> tuple[list[str], int]:
    found = layout(spark, table)
    if not found:
        raise ValueError(f"{table} was not made by merge_on_read.create")
    return found


def _unique(df: DataFrame, keys: list[str], latest_by: str | None) -> DataFrame:
    if latest_by:
        return latest_per_key(df, keys, latest_by)
    if (twice := repeated_key(df, keys)) is not None:
        raise ValueError(f"the batch holds the key {twice} more than once; name a latest_by column")
    return df


def _layer(df: DataFrame, keys: list[str], buckets: int, number: int, deleted: Column) -> DataFrame:
    return with_key_bucket(df.withColumn(DELETED, deleted), keys, buckets).withColumn(
        SEQUENCE, F.lit(number).cast("long")
    )


def _current(spark: SparkSession, table: str, rows: DataFrame) -> DataFrame:
    """The newest row of every key, with the columns that order rows, and without deleted ones."""
    keys, _ = _layout(spark, table)
    touched = sorted({int(b) for b, s in catalog.existing_partitions(spark, table) if s != "0"})
    base = rows.where(F.col(SEQUENCE) == 0)
    if not touched:
        return base
    by = [KEY_BUCKET, *keys]
    rest = [c for c in rows.columns if c not in by]
    newest = rows.where(F.col(SEQUENCE) > 0).groupBy(*by).agg(
        F.max_by(F.struct(*rest), F.col(SEQUENCE)).alias("_newest")
    ).select(*by, "_newest.*").select(*rows.columns)
    fresh = newest.select(*[F.col(k).alias(f"_new_{k}") for k in by])
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in by])
    met = base.where(F.col(KEY_BUCKET).isin(touched)).join(fresh, same, "left_anti")
    return (
        base.where(~F.col(KEY_BUCKET).isin(touched)).unionByName(met)
        .unionByName(newest.where(~F.col(DELETED)))
    )

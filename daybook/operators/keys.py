"""Rows by key: the newest of each, a key that is held twice, and the bucket of a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Partition column of a keyed table.
KEY_BUCKET = "key_bucket"


def latest_per_key(df: DataFrame, keys: list[str], latest_by: str) -> DataFrame:
    """One row per key, the one with the largest ``latest_by``.

    An aggregate, combined before the shuffle: a key with very many rows costs one
    row per task.
    """
    rest = [c for c in df.columns if c not in keys and c != latest_by]
    newest = F.max(F.struct(latest_by, *rest)).alias("_newest")
    return df.groupBy(*keys).agg(newest).select(
        *[F.col(c) if c in keys else F.col("_newest")[c].alias(c) for c in df.columns]
    )


def with_key_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    return df.withColumn(KEY_BUCKET, F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))


def repeated_key(df: DataFrame, keys: list[str]) -> tuple | None:
    """One key that more than one row has, if there is any."""
    row = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows")).where("_rows > 1").first()
    return tuple(row[k] for k in keys) if row else None

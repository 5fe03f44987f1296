"""Join helpers for sides whose size or key spread is not known beforehand."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

BROADCAST_BYTES = 32 * 1024 * 1024
ROW_OVERHEAD = 16
#: Rows of one key, and of one slice of a split key, that a task takes.
HOT_ROWS = 5_000_000
HASH_BUCKETS = 4_096
#: Up to so many hot keys are literals of the plan; a longer list stays a frame.
LISTED_KEYS = 1_000


def broadcast_when_small(*lookups: DataFrame, max_bytes: int = BROADCAST_BYTES) -> list[DataFrame]:
    """Mark each lookup for broadcast if its measured size allows it.

    One job measures the bytes of all of them. A larger lookup is returned unmarked:
    Spark then joins it by shuffle, and AQE splits skewed partitions of the fact side.
    """

    def measured(df: DataFrame, position: int) -> DataFrame:
        widths = " + ".join(
            f"coalesce(octet_length(cast(`{c}` as string)), 0) + {ROW_OVERHEAD}" for c in df.columns
        )
        return df.selectExpr(f"sum(cast({widths} as bigint)) as bytes", f"{position} as position")

    sizes = reduce(DataFrame.union, [measured(df, i) for i, df in enumerate(lookups)]).collect()
    small = {r["position"] for r in sizes if (r["bytes"] or 0) <= max_bytes}
    return [F.broadcast(df) if i in small else df for i, df in enumerate(lookups)]


def hot_keys(
    df: DataFrame, keys: list[str], min_rows: int = HOT_ROWS
) -> tuple[DataFrame, list[Row]] | None:
    """Keys with at least ``min_rows`` rows, each with the slices to cut it into, or None.

    Returns a frame of the keys as ``_hot0``, … and ``_slices``, and its rows if they are
    few, else no rows. A slice has at most ``min_rows`` rows. Both limits are rows that one task can hold and do not grow with the data. Rows
    are first counted per hash bucket, in a scan of the key columns that shuffles a few
    thousand counts per task and runs at once. Only a bucket with that many rows can hold
    a hot key, and only the keys of such buckets are counted one by one.
    """
    named = df.where(" and ".join(f"`{k}` is not null" for k in keys)).withColumn(
        "_bucket", F.pmod(F.xxhash64(*keys), F.lit(HASH_BUCKETS))
    )
    buckets = named.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    full = [r["_bucket"] for r in buckets.where(F.col("_rows") >= min_rows).collect()]
    if not full:
        return None
    slices = F.ceil(F.col("_rows") / F.lit(min_rows)).cast("bigint")
    found = (
        named.where(F.col("_bucket").isin(full)).groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("_rows")).where(F.col("_rows") >= min_rows)
        .select(*[F.col(k).alias(f"_hot{i}") for i, k in enumerate(keys)], slices.alias("_slices"))
    )
    listed = found.limit(LISTED_KEYS + 1).collect()
    if not listed:
        return None
    if len(listed) <= LISTED_KEYS:
        return F.broadcast(df.sparkSession.createDataFrame(listed, found.schema)), listed
    return broadcast_when_small(found)[0], []


def left_join_spread(
    left: DataFrame,
    right: DataFrame,
    on: list[tuple[str, str]],
    min_rows: int = HOT_ROWS,
) -> DataFrame:
    """Left outer equi-join that also stands a hot key on the right side.

    AQE splits the left side of a left outer join, but never the right one. Hot right
    keys are therefore joined apart: their right rows are dealt over slices and the
    left rows repeated per slice. Every hot key has right rows, so for these keys
    the inner join equals the left join and nothing is lost or added. Rows are
    dealt in a sorted order, so a task that is run again after a lost executor deals
    them the same way. Without hot keys the plan is the plain join. Column names must
    differ between the sides.
    """
    left_keys, right_keys = [l for l, _ in on], [r for _, r in on]
    matches = reduce(lambda a, b: a & b, [F.col(l) == F.col(r) for l, r in on])
    hot = hot_keys(right, right_keys, min_rows)
    if hot is None:
        return left.join(right, matches, "left")
    hot_df, listed = hot

    def is_hot(keys: list[str]) -> Column:
        return reduce(
            lambda a, b: a & b, [F.col(k) == F.col(f"_hot{i}") for i, k in enumerate(keys)]
        )

    def near_hot(df: DataFrame, keys: list[str]) -> DataFrame:
        """Literals of a short list reach the scan; the join with the list is exact either way."""
        for i, key in enumerate(keys if listed else []):
            df = df.where(F.col(key).isin(sorted({row[i] for row in listed})))
        return df

    cold = left.join(hot_df, is_hot(left_keys), "left_anti").join(
        right.join(hot_df, is_hot(right_keys), "left_anti"), matches, "left"
    )
    left_slices = (
        near_hot(left, left_keys).join(hot_df, is_hot(left_keys))
        .withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1)))
        .select(*left.columns, "_slice")
    )
    right_slices = (
        near_hot(right, right_keys).sortWithinPartitions(*right.columns)
        .withColumn("_arrival", F.monotonically_increasing_id())
        .join(hot_df, is_hot(right_keys))
        .select(*right.columns, F.pmod("_arrival", "_slices").alias("_deal"))
    )
    split = left_slices.join(right_slices, matches & (F.col("_slice") == F.col("_deal")))
    return cold.unionByName(split.drop("_slice", "_deal"))


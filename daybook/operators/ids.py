"""Gapless sequential row numbers without a single-partition window."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from daybook.session import SHUFFLE_PARTITION_BYTES, SHUFFLE_PARTITIONS, estimated_bytes, workspace

_ROW_BITS = 33


def id_partitions(df: DataFrame) -> int:
    """Partitions to number a frame in: by its size, at least the session's."""
    have = int(df.sparkSession.conf.get(SHUFFLE_PARTITIONS))
    return max(have, -(-estimated_bytes(df) // SHUFFLE_PARTITION_BYTES))


def sequential_id(df: DataFrame, name: str, *order_by: str, partitions: int | None = None) -> DataFrame:
    """Add a 1-based ``bigint`` id that follows the given order.

    Rows are range-partitioned and numbered inside their partition; each partition
    then gets the count of rows before it. Ties, even one value that most rows
    share, are spread by a hash of the row and by their place in the input, so no
    task gets a whole group of equal rows. Places are given in a sorted order, so a
    task that is run again after a lost executor gives the same ones. The numbered
    rows are written once to the shared workspace, so that counting and numbering
    see the same rows, and stay there until the workspaces are cleared. There are as many
    partitions as the input's size asks for. The offsets table has one row per partition,
    which bounds the broadcast.
    """
    spark = df.sparkSession
    keyed = (
        df.withColumn("_tie", F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]))
        .sortWithinPartitions("_tie")
        .withColumn("_place", F.monotonically_increasing_id())
    )
    count = partitions or id_partitions(df)
    order = [*order_by, "_tie", "_place"]
    ranged = (
        keyed.repartitionByRange(count, *order)
        .sortWithinPartitions(*order)
        .withColumn("_at", F.monotonically_increasing_id())
        .withColumn("_part", F.shiftright("_at", _ROW_BITS))
        .drop("_tie", "_place")
    )
    path = workspace(spark, "sequential-id")
    ranged.write.parquet(path)
    numbered = spark.read.schema(ranged.schema).parquet(path)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        numbered.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))
        .select(F.col("_part"), F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_before"))
    )
    row_in_part = F.col("_at").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    return (
        numbered.join(F.broadcast(offsets), "_part")
        .select(*[F.col(f"`{c}`") for c in df.columns],
                (F.col("_before") + row_in_part + 1).alias(name))
    )

"""Current-day refresh as a file stream over landed pulls.

Every pull of the source lands as ``<landing>/pull=<number>/…`` and holds the day in
full, so the newest pull replaces the day. A trigger takes what has landed since the
last one and ends, which suits a half-hourly schedule.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from daybook.functions import dates
from daybook.operators.tables import replace_current_day
from daybook.sources.paged import PullReader, register
from daybook.sources.pages import newest_pull, read_pages


def stream_current_day(
    spark: SparkSession,
    landing: str,
    item: T.StructType,
    table: str,
    key: str,
    today: dt.date,
    checkpoint: str,
    envelope: str = "post",
) -> StreamingQuery:
    """Replace today's partition by the newest landed pull.

    Pulls are numbered in order, and one lands in full before the next one starts.
    A batch only tells that pages arrived. The newest of all landed pulls is then read
    back in full: pages of one pull that fall into two batches are not lost, a late page
    of an older pull does not bring that pull back, and a batch that is run again gives
    the same table.
    """
    def refresh(batch: DataFrame, _batch_id: int) -> None:
        if batch.isEmpty():
            return
        pull = read_pages(spark, newest_pull(spark, landing), item, envelope)
        replace_current_day(pull, table, key, today)

    return (
        spark.readStream.schema("value string, pull string").text(landing)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


#: Table property with the last batch that a stream has put into a partition.
BATCH_PROPERTY = "daybook.batch"


def last_batch(spark: SparkSession, table: str, partition: str, checkpoint: str) -> int:
    """The number of the last batch of a stream in a partition, -1 if there is none."""
    rows = spark.sql(f"SHOW TBLPROPERTIES {table}").where(F.col("key") == f"{BATCH_PROPERTY}.{partition}").collect()
    stream, _, number = rows[0]["value"].rpartition("#") if rows else ("", "", "")
    return int(number) if stream == checkpoint else -1


def stream_pulls(
    spark: SparkSession,
    landing: str,
    item: T.StructType,
    table: str,
    key: str,
    today: dt.date,
    checkpoint: str,
    envelope: str = "post",
) -> StreamingQuery:
    """Replace today's partition by each newest pull, with the pull's number as the offset.

    A batch holds the rows of the newest complete pull and no others, so a pull that lands
    late or breaks off changes nothing, and an empty pull empties the day. The batch is
    recorded with the partition once it is in place; Spark runs a batch again after a failure,
    and one that is recorded is skipped.
    """
    register(spark)
    day = dates.day_text(today)

    def refresh(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        if not PullReader(item, {"path": landing}).complete():
            return  # the first batch runs in any case, also without a pull
        if batch_id <= last_batch(session, table, day, checkpoint):
            return
        replace_current_day(batch, table, key, today)
        session.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ('{BATCH_PROPERTY}.{day}' = '{checkpoint}#{batch_id}')")

    return (
        spark.readStream.format("pulls").schema(item).option("envelope", envelope).load(landing)
        .writeStream.foreachBatch(refresh)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )

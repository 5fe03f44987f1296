"""Helpers shared by the operators: staging, even spreading of hot groups, Arrow text."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from daybook.operators.joins import broadcast_when_small

CHECKPOINT_DIR = "spark.checkpoint.dir"

#: Rows that one slice of a hot group holds, and the least number of slices.
SLICE_ROWS = 100_000
MIN_SLICES = 64

#: Bytes of text that a vectorised step works on at once; a longer text stands alone.
CHUNK_BYTES = 1 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a temporary one in a local session only."""
    base = spark.conf.get(CHECKPOINT_DIR, None)
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return _own_folder()


@cache
def _own_folder() -> str:
    folder = tempfile.mkdtemp(prefix="daybook-llm-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write a frame as Parquet into the shared folder and read it again.

    Cuts the lineage: what is read later survives a lost executor and is not computed
    twice. The folder goes when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm/{label}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)


def whole_rows(docs: DataFrame, **keys: Column) -> DataFrame:
    """Rows as one column ``_row`` beside keys, so that no key's name can clash with theirs.

    Keys are expressions over the rows' own columns; ``select("_row.*")`` gives the rows back.
    """
    own = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("_row")
    return docs.select(own, *[k.alias(n) for n, k in keys.items()])


def without(docs: DataFrame, gone: DataFrame, **keys: Column) -> DataFrame:
    """The rows whose keys are not among ``gone``, which has a column of each key's name.

    Nulls equal each other. A list of measured small size is broadcast, so the rows stay
    where they are; a longer one is joined by merge. The result is the same.
    """
    small, = broadcast_when_small(staged(gone.distinct(), "gone"))
    small = small.select(*[F.col(k).alias(f"_gone_{k}") for k in keys])
    same = [F.col(k).eqNullSafe(F.col(f"_gone_{k}")) for k in keys]
    return whole_rows(docs, **keys).join(small, same, "left_anti").select("_row.*")


def slices_for(rows: int) -> int:
    """Into how many slices a group is dealt, so that none outgrows a task at any size."""
    return max(MIN_SLICES, -(-rows // SLICE_ROWS))


def with_group_totals(
    rows: DataFrame,
    by: list[str],
    totals: dict[str, tuple[str, Column]],
    deal_by: list[str],
    slices: int,
) -> DataFrame:
    """Add totals of each group to each of its rows, however many rows a group has.

    ``totals`` maps a new column to an aggregate that can be taken again over its own
    results (``"min"``, ``"max"`` or ``"sum"``) and its input. Rows of a group are dealt
    over slices by a hash of ``deal_by``; totals are taken per slice, then per group
    (one row for each slice at most), and go back to the slices that exist. So neither
    an aggregation nor the join ever has a whole hot group in one task.
    """
    combine = {"min": F.min, "max": F.max, "sum": F.sum}
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(*deal_by), F.lit(slices)).cast("int"))
    parts = dealt.groupBy(*by, "_slice").agg(
        *[combine[how](column).alias(name) for name, (how, column) in totals.items()]
    )
    whole = parts.groupBy(*by).agg(
        *[combine[how](name).alias(name) for name, (how, _) in totals.items()],
        F.collect_list("_slice").alias("_slices"),
    )
    back = whole.withColumn("_slice", F.explode("_slices")).drop("_slices")
    return dealt.join(back, [*by, "_slice"]).drop("_slice")


def text_chunks(texts: pa.Array | pa.ChunkedArray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """The bytes of a string column in chunks: first row, bytes, and where each text ends.

    Null counts as empty. A chunk has about ``CHUNK_BYTES`` bytes, or one longer text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.fill_null("").cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)
    first = 0
    while first < len(texts):
        last = int(np.searchsorted(offsets, offsets[first] + CHUNK_BYTES, "right")) - 1
        last = min(max(last, first + 1), len(texts))
        yield (first, data[offsets[first]:offsets[last]],
               offsets[first + 1:last + 1] - offsets[first])
        first = last

"""The shared helpers: totals of hot groups, text chunks, staged frames."""

import os

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from daybook.llm import common


def test_group_totals_of_a_hot_group(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("n"), F.when(F.col("id") < 2000, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k")
    )
    totals = {"low": ("min", F.col("n")), "high": ("max", F.col("n")), "size": ("sum", F.lit(1).cast("long"))}
    found = common.with_group_totals(rows, ["k"], totals, ["n"], 16)
    assert found.columns == ["k", "n", "low", "high", "size"]
    expected = rows.join(rows.groupBy("k").agg(F.min("n").alias("low"), F.max("n").alias("high"),
                                               F.count("n").alias("size")), "k")
    assert found.count() == 3000 and found.exceptAll(expected.select(*found.columns)).count() == 0


def test_no_slice_grows_with_the_rows():
    assert common.slices_for(0) == common.MIN_SLICES
    for rows in (10**6, 10**9, 10**12):
        assert rows / common.slices_for(rows) <= common.SLICE_ROWS


@pytest.mark.parametrize("texts", [[], [None], ["", None, "é"], ["a" * 10, "b" * 50, "", "c"]])
def test_text_chunks_hold_all_bytes(monkeypatch, texts):
    monkeypatch.setattr(common, "CHUNK_BYTES", 12)
    for array in (pa.array(texts, pa.string()), pa.array([*texts, "x"], pa.string())[:len(texts)]):
        found = []
        for first, data, ends in common.text_chunks(array):
            assert first == len(found)
            assert len(ends) == 1 or len(data) <= 12
            found += [data[a:b].tobytes() for a, b in zip(np.concatenate(([0], ends[:-1])), ends)]
        assert found == [(t or "").encode() for t in texts]


def test_staged_rows_lie_in_the_shared_folder(spark):
    frame = common.staged(spark.range(5), "test")
    assert frame.count() == 5
    folder = common.shared_folder(spark)
    assert all(f.startswith(f"file://{folder.removeprefix('file://')}/llm/test-") for f in frame.inputFiles())
    assert os.path.isdir(folder.removeprefix("file://"))


def test_cluster_without_a_shared_folder_is_an_error():
    class Cluster:
        master = "spark://host:7077"

        def get(self, _key, default=None):
            return default

    session = Cluster()
    session.conf = session.sparkContext = session
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_folder(session)

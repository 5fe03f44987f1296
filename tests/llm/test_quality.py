"""The quality classifier on held-out labels, and its parts."""

import math

import pytest
from pyspark.sql import functions as F

from daybook.llm import quality
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    scores = QUERIES["op2_quality_classifier"](spark, SF_DIR)
    assert scores.count() == spark.read.parquet(f"{SF_DIR}/documents.parquet").count()
    rows = scores.where("held_out").join(labels, "doc_id").collect()
    assert len(rows) > 50 and sum(r.predicted == r.quality for r in rows) / len(rows) > 0.95
    for r in rows:
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.3)


def test_model_is_sparse_rules(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet").select(F.col("doc_id").alias("id"), F.col("quality").alias("label"))
    stats = quality.text_statistics(docs).cache()
    model = quality.fit(stats, labels)
    assert 0 < len(model.weighted) < quality.TREES * 2 ** (quality.DEPTH + 1) / 2
    names = {n for rule, _ in model.weighted for n, _, _ in rule.bounds}
    assert names <= set(quality.STATISTICS)
    row = stats.select("*", model.score().alias("score")).first()
    total = model.intercept + sum(
        w for rule, w in model.weighted
        if all((low is None or row[n] > low) and (high is None or row[n] <= high) for n, low, high in rule.bounds)
    )
    assert math.isclose(row.score, 1 / (1 + math.exp(-total)), rel_tol=1e-9)
    sample = quality.fit(stats, labels, fit_rows=60)  # a bounded sample also trains
    assert sample.weighted


def test_statistics():
    found = dict(zip(quality.STATISTICS, quality.statistics(b"The THE the the !! | a1\nx.\nx.\n")))
    assert found["upper"] == 4 / 30 and found["digits"] == 1 / 30 and found["exclaims"] == 2 / 30
    assert found["top_word"] == 2 / 9 and found["repeats"] == 2 / 9 and found["bars"] == 1 / 9
    assert found["repeated_lines"] == pytest.approx(1 / 3) and found["ended_lines"] == pytest.approx(2 / 3)
    assert quality.statistics(b"") == quality.statistics(b" \n") == [0.0] * len(quality.STATISTICS)


def test_rows_of_all_kinds(spark):
    rows = [(i, ("good words and the like of it " * 9) if i % 2 else "#### && $$ " * 9) for i in range(60)]
    rows += [(None, None), (99, None), (98, ""), (97, "a" * 300_000), (5, rows[5][1])]
    docs = spark.createDataFrame([(*r, 1.0, "x") for r in rows], "doc_id long, text string, score double, label string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(None, 1), (98, None), (97, 7), (5, 1)],
                                   "doc_id long, quality int")
    found = quality.quality_scores(docs, labels).collect()
    assert len(found) == len(rows)
    assert {(r.doc_id, r.predicted) for r in found} >= {(i, i % 2) for i in range(60)}
    stay = quality.keep_good(docs, labels)
    assert stay.columns == docs.columns and stay.where("doc_id < 60").count() == 31


def test_without_labels_or_documents(spark):
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert [r.score for r in quality.quality_scores(docs, none).collect()] == pytest.approx([0.5, 0.5])
    one = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    assert quality.quality_scores(docs, one).where("predicted = 1").count() == 2
    assert quality.quality_scores(docs.where("false"), one).count() == 0

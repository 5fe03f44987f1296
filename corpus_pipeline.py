"""A corpus pipeline of the training-data operators; each stage is written and read again.

Every stage takes documents with an id and a text among any other columns, and but for the
last returns the same columns. None of them fails on null ids or texts, empty or very long
texts, repeated rows, an empty table, or columns of any name; what each does with them it says.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontaminate, exact_dedup, quality, sentencepiece_viterbi, simhash
from daybook.llm.common import read_table, staged


def classify(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go.

    A null or empty text is scored like any other. Rows with the same id go together, those
    with a null id too. Without labels all documents have the same score.
    """
    return quality.keep_good(docs, read_table(spark, sf_dir, "labels"), threshold=0.3)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal up to white space the one with the smallest id stays.

    Null counts as empty; null ids come last. Of rows equal in id and text one stays.
    """
    return exact_dedup.keep_first(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates the document with the smallest id stays.

    Texts without words are near to each other. Rows with a null id cannot be told apart and
    all stay.
    """
    return simhash.keep_one(docs, shingle=4, radius=4)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go.

    A text without words holds none. Rows with the same id go together, those with a null id
    too. Without items nothing goes.
    """
    return decontaminate.keep_clean(docs, read_table(spark, sf_dir, "benchmark"), window=10)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of every document that is left: one row per row, a null text has no pieces."""
    return sentencepiece_viterbi.encode_documents(docs)


STAGES = [
    ("quality classifier", classify),
    ("exact dedup", exact),
    ("simhash near-dedup", near),
    ("benchmark decontamination", decontaminated),
    ("sentencepiece", encode),
]

#: SQL cannot express trained rules, fingerprints or segmentation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the documents of ``sf_dir``."""
    docs = read_table(spark, sf_dir, "documents")
    for number, (_, stage) in enumerate(STAGES):
        # Written to the shared folder, read again, and gone when the session's JVM ends.
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{number}")
    return docs

"""Quality classifier: a sparse ensemble of rules taken from trees.

Statistics of each text are the only inputs. A random forest is grown on labelled rows;
every path from a root to a node becomes a rule, a conjunction of bounds on statistics.
A logistic regression with an L1 penalty weighs the rules, and the few with a weight
become one Spark column expression.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged, without

#: The forest and the rule weights are fitted on at most about this many labelled rows.
FIT_ROWS = 50_000
TREES = 16
DEPTH = 3
PENALTY = 0.002
SEED = 7

UPPER = bytes(range(65, 91))
DIGITS = b"0123456789"
SYMBOLS = b"#$%&*+/<=>@[\\]^_`{|}~"
ENDINGS = (b".", b"!", b"?", b":", b'"')

#: Common short words of the four languages.
STOP_WORDS = frozenset(
    "the of and to in a is that it for on was be with as this by from at are or an not "
    "der die und das ist von den mit des im ein eine nicht zu auf für als auch es sich "
    "de la le et les des en un une que est pour dans sur par au du qui il ne pas "
    "el los las del y por con una su para se al lo como más".encode().split()
)

STATISTICS = [
    "log_bytes", "log_words", "mean_word", "longest_word", "upper", "digits", "symbols",
    "exclaims", "bars", "distinct", "top_word", "repeats", "stop_words", "repeated_lines",
    "ended_lines", "symbol_words",
]


def statistics(text: bytes) -> list[float]:
    """The statistics of one text; all zero for a text without words."""
    words = text.split()
    if not words:
        return [0.0] * len(STATISTICS)
    size, count = len(text), len(words)
    counts = Counter(words)
    lines = [line for line in text.split(b"\n") if line.strip()]
    without = lambda chars: size - len(text.translate(None, chars))
    last = Counter(word[-1] for word in words)
    return [
        math.log1p(size), math.log1p(count), sum(map(len, words)) / count, float(max(map(len, words))),
        without(UPPER) / size, without(DIGITS) / size, without(SYMBOLS) / size,
        text.count(b"!") / size, counts[b"|"] / count, len(counts) / count,
        counts.most_common(1)[0][1] / count, sum(map(eq, words, words[1:])) / count,
        sum(counts[w] for w in STOP_WORDS if w in counts) / count,
        1 - len(set(lines)) / len(lines),
        sum(line.rstrip().endswith(ENDINGS) for line in lines) / len(lines),
        sum(last[c] for c in SYMBOLS) / count,
    ]


def _add_statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").fill_null("").cast(pa.large_binary())
        rows = [statistics(t.as_py()) for t in texts]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), *[pa.array(c, pa.float64()) for c in zip(*rows)]]
            if rows else [batch.column("id"), *[pa.array([], pa.float64())] * len(STATISTICS)],
            ["id", *STATISTICS],
        )


def text_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id and the statistics of each row's whole text (null: empty)."""
    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(
        F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_add_statistics, f"id {kind}, " + ", ".join(f"{s} double" for s in STATISTICS))


@dataclass(frozen=True)
class Rule:
    """A conjunction of bounds: (statistic, lower bound or None, upper bound or None)."""

    bounds: tuple[tuple[str, float | None, float | None], ...]

    def column(self) -> Column:
        met = F.lit(True)
        for name, low, high in self.bounds:
            if low is not None:
                met &= F.col(name) > low
            if high is not None:
                met &= F.col(name) <= high
        return met.cast("double")


def tree_rules(forest) -> list[Rule]:
    """The distinct rules of all paths of a fitted forest, in the order they are met."""
    rules: dict[Rule, None] = {}

    def walk(node, bounds: dict[str, tuple[float | None, float | None]]) -> None:
        if bounds:
            rules[Rule(tuple((n, *b) for n, b in sorted(bounds.items())))] = None
        if node.getClass().getSimpleName() == "LeafNode":
            return
        name, cut = STATISTICS[node.split().featureIndex()], node.split().threshold()
        low, high = bounds.get(name, (None, None))
        walk(node.leftChild(), bounds | {name: (low, cut if high is None else min(high, cut))})
        walk(node.rightChild(), bounds | {name: (cut if low is None else max(low, cut), high)})

    for tree in forest.trees:
        walk(tree._java_obj.rootNode(), {})
    return list(rules)


@dataclass
class QualityModel:
    """Weighted rules; ``score()`` is a column expression over the statistics."""

    intercept: float
    weighted: list[tuple[Rule, float]]

    def score(self) -> Column:
        total = F.lit(self.intercept)
        for rule, weight in self.weighted:
            total += F.lit(weight) * rule.column()
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))


def fit(stats: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS) -> QualityModel:
    """Learn from rows of ``labels`` (id, label 0 or 1).

    A label that is null or of an unknown id is not used. With more than ``fit_rows``
    labelled rows a sample by a hash of the id is taken, so the bound holds at any size.
    With no label at all, or labels of one class, the score is their smoothed mean.
    """
    known = staged(
        stats.join(labels.where("label in (0, 1)"), "id").select("id", "label", *STATISTICS), "quality-rows"
    )
    total = known.count()
    if total > fit_rows:
        part = F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(1 << 30)) < int(fit_rows / total * (1 << 30))
        known = staged(known.where(part), "quality-sample")
    good, rows = known.agg(F.sum("label"), F.count("label")).first()
    good = good or 0
    if good in (0, rows):
        mean = (good + 1) / (rows + 2)
        return QualityModel(math.log(mean / (1 - mean)), [])
    frame = known.select(
        F.col("label").cast("double").alias("label"),
        array_to_vector(F.array(*STATISTICS)).alias("features"), *STATISTICS,
    )
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt", minInstancesPerNode=2
    ).fit(frame)
    rules = tree_rules(forest)
    if not rules:
        return QualityModel(math.log(good / (rows - good)), [])
    fires = frame.select("label", array_to_vector(F.array(*[r.column() for r in rules])).alias("features"))
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=PENALTY, maxIter=100).fit(fires)
    weights = lasso.coefficients.toArray()
    return QualityModel(float(lasso.intercept), [(r, float(w)) for r, w in zip(rules, weights) if w])


def held_out(id_column: Column, parts: int = 5) -> Column:
    """Whether an id belongs to the part that is kept out of training (never for null)."""
    return F.coalesce(F.crc32(id_column.cast("string").cast("binary")) % parts == 0, F.lit(False))


def quality_scores(docs: DataFrame, labels: DataFrame, threshold: float = 0.3, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "quality") -> DataFrame:
    """One row per document: id, held_out, score, predicted.

    * The score is the probability of label 1; ``predicted`` is 1 from ``threshold`` on.
    * A null or empty text has statistics of zero and is scored like any other.
    * Ids that are null are scored and not learned from. Repeated rows are rows of their own.
    * Without documents there are no rows. Only the id, text and label columns are read.
    """
    stats = staged(text_statistics(docs, id_col, text_col), "quality-statistics")
    given = labels.select(F.col(id_col).alias("id"), F.col(label_col).alias("label"))
    model = fit(stats, given.where(~held_out(F.col("id"))))
    return stats.select(
        F.col("id").alias(id_col), held_out(F.col("id")).alias("held_out"), model.score().alias("score")
    ).withColumn("predicted", (F.col("score") >= threshold).cast("int"))


def keep_good(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents that are predicted good, with all their columns.

    A document goes if a row with its id is predicted bad; rows with a null id are judged
    together, and repeated rows alike. A null or empty text is scored like any other. Without
    documents there are no rows. Names of other columns do not matter.
    """
    found = quality_scores(docs, labels, id_col=id_col, **options)
    return without(docs, found.where("predicted = 0").select(F.col(id_col).alias("id")), id=F.col(id_col))

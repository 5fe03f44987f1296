"""Secret scan: candidates by pattern, false positives removed by a random forest.

Every long run of key characters is a candidate, and every value behind a secret's name
and an assignment. A forest trained on labelled findings
judges it by its length, its changes between kinds of characters, how much of it is made
of dictionary words, the path it lies in, and the words next to it. The trees become one
column expression, so scanning uses DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged

#: A run of key characters, base64 padding included.
CANDIDATE = r"[A-Za-z0-9_+/\-]{16,}={0,2}"
LEAST_RUN = 16
#: The name of a secret with an assignment, and then a value in quotes or without blanks.
NAMED = r"(?:token|secret|passw|pwd|key|auth|credential|bearer)[A-Za-z0-9_\-]{0,40}+[\"']?\s{0,8}(?:=>|:=|=|:)\s{0,8}"
ASSIGNED = rf"(?i){NAMED}(?:\"[^\"\n]{{6,}}+(?=\")|'[^'\n]{{6,}}+(?=')|[\"']?[^\s\"',;<>]{{6,}})"
LEAST_ASSIGNED = 10
#: Without a digit only longer runs are candidates.
LETTERS_ONLY = 20
#: Characters of the text kept on either side of a candidate, other candidates included.
CONTEXT = 48

#: The dictionary is all words of the corpus that occur so often, of so many letters.
WORD_COUNT = 5
LEAST_WORD = 3
LONGEST_WORD = 32
#: Characters of a candidate whose words are looked for together.
PART = 256
#: Slices over which rows of one word or one candidate are dealt in joins.
SLICES = 16

KEY_WORDS = r"(?i)(token|secret|passw|pwd|key|auth|credential|bearer|access)[A-Za-z_\-]*\W*$"
TEST_PATHS = r"(?i)(test|example|sample|mock|fixture|doc|vendor|node_modules)"

#: The forest is fitted on at most about this many labelled findings.
FIT_ROWS = 50_000
TREES = 10
DEPTH = 5
SEED = 11

FEATURES = [
    "length", "changes", "digits", "uppers", "distinct", "hex", "coverage", "path_depth", "test_path",
    "key_word", "assigned", "quoted", "inside_word",
]


def _context(least: int) -> tuple[str, str]:
    """The text before and after match j of ``found``, whose gaps are ``around``, as SQL.

    A context reaches over as many neighbouring matches of ``least`` characters as fit in.
    """
    near = -(-CONTEXT // least)
    before = [f"right(get({a}, j - {k}), {CONTEXT})" for k in range(near, 0, -1) for a in ("around", "found")]
    after = [f"left(get({a}, j + {k}), {CONTEXT})" for k in range(1, near + 1) for a in ("around", "found")]
    before.append(f"right(get(around, j), {CONTEXT})")
    after.append(f"left(get(around, j + {near + 1}), {CONTEXT})")
    return (f"right(concat_ws('', {', '.join(before)}), {CONTEXT})",
            f"left(concat_ws('', {', '.join(after)}), {CONTEXT})")


def candidates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               path_col: str = "source") -> DataFrame:
    """One row per candidate: id, path, nth (of its text), candidate, before, after.

    Assigned values that are no run of key characters are numbered behind the runs.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(path_col).cast("string"), F.lit("")).alias("path"),
        text.alias("text"),
    )

    def matches(pattern: str, least: int) -> DataFrame:
        before, after = _context(least)
        return texts.select(
            "id", "path", F.regexp_extract_all("text", F.lit(pattern), F.lit(0)).alias("found"),
            F.split("text", pattern, -1).alias("around"),
            F.size(F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))).alias("runs"),
        ).where(F.size("found") > 0).select("id", "path", "runs", F.explode(F.expr(
            "transform(found, (f, j) -> named_struct('nth', j + 1, 'candidate', f, "
            f"'before', {before}, 'after', {after}))"
        )).alias("f")).select("id", "path", "runs", "f.*")

    is_run = (F.length("candidate") >= LETTERS_ONLY) | F.col("candidate").rlike("[0-9]")
    head = F.regexp_extract("candidate", f"^(?i){NAMED}[\"']?", 0)
    assigned = (
        matches(ASSIGNED, LEAST_ASSIGNED)
        .withColumn("head", head)
        .withColumn("candidate", F.expr("substring(candidate, length(head) + 1)"))
        .withColumn("before", F.expr(f"right(concat(before, head), {CONTEXT})"))
        .where(~(F.col("candidate").rlike(f"^(?:{CANDIDATE})$") & is_run))
        .withColumn("nth", F.col("runs") + F.col("nth"))
    )
    columns = ["id", "path", "nth", "candidate", "before", "after"]
    return matches(CANDIDATE, LEAST_RUN).where(is_run).select(columns).union(assigned.select(columns))


def dictionary(docs: DataFrame, text_col: str = "text", times: int = WORD_COUNT) -> DataFrame:
    """All words a-z (word) that occur at least ``times`` times in the texts."""
    split = F.split(F.lower(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), "[^a-z]+")
    return (
        docs.select(F.explode(split).alias("word"))
        .where(F.length("word").between(LEAST_WORD, LONGEST_WORD)).groupBy("word").count()
        .where(F.col("count") >= times).select("word")
    )


def _dealt_join(rows: DataFrame, lookup: DataFrame, key: str, deal_by: list[str], how: str) -> DataFrame:
    """Join with one row per key, rows of a hot key dealt over slices."""
    dealt = rows.withColumn("_slice", F.pmod(F.xxhash64(*deal_by), F.lit(SLICES)).cast("int"))
    copies = lookup.withColumn("_slice", F.explode(F.sequence(F.lit(0), F.lit(SLICES - 1))))
    return dealt.join(copies, [key, "_slice"], how).drop("_slice")


def coverage(found: DataFrame, words: DataFrame) -> DataFrame:
    """How many characters of each candidate (by its MD5, ``digest``) lie in dictionary words."""
    text = F.lower("candidate")
    distinct = found.select("candidate").distinct()
    parts = distinct.select(
        F.md5("candidate").alias("digest"), F.posexplode(F.transform(
            F.sequence(F.lit(0), F.floor(F.length("candidate") / PART).cast("int")),
            lambda i: F.substring(text, i * PART + 1, F.lit(PART + LONGEST_WORD - 1)),
        )).alias("part", "text"),
    )
    # Letters from each place on; every beginning of them may be a word.
    places = parts.select(
        "digest", "part", "text", F.explode(F.sequence(F.lit(1), F.lit(PART))).alias("place")
    ).select(
        "digest", (F.col("part") * PART + F.col("place")).alias("start"),
        F.regexp_extract(F.substring("text", F.col("place"), F.lit(LONGEST_WORD)), "^[a-z]+", 0).alias("letters"),
    ).where(F.length("letters") >= LEAST_WORD)
    strings = places.select(
        "digest", "start", "letters", F.explode(F.sequence(F.lit(LEAST_WORD), F.length("letters"))).alias("size")
    ).select("digest", "start", "size", F.substring("letters", F.lit(1), F.col("size")).alias("word"))
    met = _dealt_join(strings, words, "word", ["digest", "start"], "inner")
    spans = met.groupBy("digest", "start").agg(F.max("size").alias("size"))
    return spans.groupBy("digest").agg(
        F.array_sort(F.collect_list(F.struct("start", (F.col("start") + F.col("size")).alias("stop")))).alias("spans")
    ).select("digest", F.expr(
        "aggregate(spans, named_struct('stop', 0, 'n', 0), (s, x) -> named_struct('stop', greatest(s.stop, x.stop), "
        "'n', s.n + greatest(0, x.stop - greatest(s.stop, x.start))), s -> s.n)"
    ).alias("covered"))


def with_features(found: DataFrame, words: DataFrame | list[str]) -> DataFrame:
    """Candidates with the statistics the forest judges by; ``words`` is the dictionary."""
    if isinstance(words, list):
        words = found.sparkSession.createDataFrame([(w,) for w in words], "word string")
    found = _dealt_join(
        found.withColumn("digest", F.md5("candidate")), coverage(found, words), "digest", ["id", "nth"], "left"
    )
    text, before = F.col("candidate"), F.col("before")
    lower = "abcdefghijklmnopqrstuvwxyz"
    kinds = F.translate(text, lower + lower.upper() + "0123456789", "a" * 26 + "A" * 26 + "9" * 10)
    size = F.length(text).cast("double")

    def share(pattern: str) -> Column:
        return 1 - F.length(F.regexp_replace(text, pattern, "")) / size

    return found.select(
        "*", size.alias("length"),
        (F.length(F.regexp_replace(kinds, r"(.)\1+", "$1")) - 1).cast("double").alias("changes"),
        share("[0-9]").alias("digits"), share("[A-Z]").alias("uppers"),
        (F.size(F.array_distinct(F.split(text, ""))) / size).alias("distinct"),
        share("[0-9a-f]").alias("hex"), (F.coalesce("covered", F.lit(0)) / size).alias("coverage"),
        F.length(F.regexp_replace("path", "[^/]", "")).cast("double").alias("path_depth"),
        F.col("path").rlike(TEST_PATHS).cast("double").alias("test_path"),
        before.rlike(KEY_WORDS).cast("double").alias("key_word"),
        before.rlike(r"[=:]\s*[\"']?$").cast("double").alias("assigned"),
        F.col("after").rlike("^[\"']").cast("double").alias("quoted"),
        (before.rlike(r"[^\s\x00-\x7F]$") | F.col("after").rlike(r"^[^\s\x00-\x7F]"))
        .cast("double").alias("inside_word"),
    )


def train(findings: DataFrame, fit_rows: int = FIT_ROWS) -> Column:
    """The probability of label 1 as an expression over the features.

    ``findings`` has the features and a label 0 or 1 (others are not used), and id and nth,
    by whose hash a sample is taken where there are more than ``fit_rows``. Without labels of
    both classes the expression is their smoothed mean.
    """
    known = findings.where("label in (0, 1)")
    good, rows = known.agg(F.sum("label"), F.count("label")).first()
    good = good or 0
    if good in (0, rows):
        return F.lit((good + 1) / (rows + 2))
    if rows > fit_rows:
        part = F.pmod(F.xxhash64(F.lit(SEED), "id", "nth"), F.lit(1 << 30))
        known = known.where(part < int(fit_rows / rows * (1 << 30)))
    frame = known.select(
        F.col("label").cast("double").alias("label"), array_to_vector(F.array(*FEATURES)).alias("features")
    )
    forest = RandomForestClassifier(
        numTrees=TREES, maxDepth=DEPTH, seed=SEED, featureSubsetStrategy="sqrt"
    ).fit(frame)

    def column(node) -> Column:
        if node.getClass().getSimpleName() == "LeafNode":
            return F.lit(float(node.impurityStats().prob(1.0)))
        name, cut = FEATURES[node.split().featureIndex()], node.split().threshold()
        return F.when(F.col(name) <= cut, column(node.leftChild())).otherwise(column(node.rightChild()))

    trees = [column(tree._java_obj.rootNode()) for tree in forest.trees]
    return reduce(lambda a, b: a + b, trees) / F.lit(float(len(trees)))


def scan(docs: DataFrame, label: Column, learn: Column, threshold: float = 0.5, id_col: str = "doc_id",
         text_col: str = "text", path_col: str = "source") -> DataFrame:
    """One row per candidate: id, nth, candidate, before, after, held_out, label, score, secret.

    ``label`` tells 0, 1 or null for a finding, over (id, path, candidate, before, after);
    rows where ``learn`` (over ``id``) is true are learned from, the others held out.

    * A null or empty text has no candidates; null ids and paths are allowed.
    * Repeated rows give repeated findings. Without texts, or without candidates, there
      are no rows. Other columns are ignored. Texts of any length are scanned whole.
    """
    plain = staged(candidates(docs, id_col, text_col, path_col), "secret-plain")
    found = staged(
        with_features(plain, dictionary(docs, text_col))
        .withColumn("label", label.cast("int"))
        .withColumn("held_out", ~F.coalesce(learn, F.lit(False))),
        "secret-candidates",
    )
    score = train(found.where(~F.col("held_out")))
    return found.select(
        F.col("id").alias(id_col), "nth", "candidate", "before", "after", "held_out", "label",
        score.alias("score"),
    ).withColumn("secret", F.col("score") >= threshold)

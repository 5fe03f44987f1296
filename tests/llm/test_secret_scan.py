"""The secret scan: candidates, features, and the forest on held-out findings."""

import random
import re
import string

import pytest
from pyspark.sql import functions as F

from daybook.llm import secret_scan
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def test_plan_has_no_python(spark):
    plan = QUERIES["op5_secret_scan"](spark, SF_DIR)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)


def test_query_finds_the_known_forms(spark):
    found = QUERIES["op5_secret_scan"](spark, SF_DIR).cache()
    assert found.where("label = 1 and not secret").count() == 0
    assert found.where("label = 0 and secret").count() == 0
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()}
    expected = {(i, m) for i, t in texts.items() for m in re.findall(secret_scan.CANDIDATE, t)
                if len(m) >= 20 or re.search("[0-9]", m)}
    assert {(r.doc_id, r.candidate) for r in found.collect()} == expected


def sample(seed):
    """Texts with keys of three forms and look-alikes: numbers, long words, paths, names in capitals."""
    rng = random.Random(seed)
    pick = lambda chars, n: "".join(rng.choice(chars) for _ in range(n))
    words = ["the", "and", "service", "update", "account", "there", "nation", "under"]
    rows = []
    for i in range(400):
        text = [" ".join(rng.choices(words, k=12))]
        if i % 2:
            text.append(rng.choice([f'token = "{pick("0123456789abcdef", 40)}"', "AKIA" + pick(string.ascii_uppercase + "234567", 16),
                                    f"password={pick('0123456789abcdef', 18)}"]))
        else:
            text.append(rng.choice([pick("0123456789", 16), "".join(rng.choices(words, k=4)), "/".join(rng.choices(words, k=5)),
                                    "_".join(rng.choices(words, k=4)).upper()]))
        rows.append((i, " ".join([*text, *rng.choices(words, k=5)]), rng.choice(["src/a.py", "tests/x/y.py", None]), i % 2))
    return rows


def test_forest_on_held_out_findings(spark):
    rows = sample(1)
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, label int")
    truth = {i: y for i, _, _, y in rows}
    label = F.when(F.col("id") % 2 == 1, 1).otherwise(0)
    found = secret_scan.scan(docs, label, learn=F.col("id") % 5 != 0).where("held_out").collect()
    assert len(found) > 50
    assert sum(r.secret == bool(truth[r.doc_id]) for r in found) / len(found) > 0.95


def test_features(spark):
    rows = [("the0123456789abcdefTHE", "x = \"", "\" y", "a/tests/b.py"), ("aaaaaaaaaaaaaaaaaaaa1", "é", "", "")]
    frame = spark.createDataFrame([(1, p, 1, c, b, a) for c, b, a, p in rows],
                                  "id long, path string, nth int, candidate string, before string, after string")
    first, second = secret_scan.with_features(frame, ["the", "then"]).collect()
    assert (first.length, first.changes, first.path_depth, first.test_path) == (22, 3, 2, 1)
    assert first.digits == pytest.approx(10 / 22)
    assert first.coverage == pytest.approx(6 / 22) and first.assigned == 1 and first.quoted == 1
    assert second.distinct == pytest.approx(2 / 21) and second.inside_word == 1 and second.key_word == 0


def test_rows_of_all_kinds(spark):
    key = "AKIA" + "Q" * 16
    rows = [(None, key, None), (1, None, "p"), (2, "", "p"), (3, f"{key} {key}", "p"), (3, f"{key} {key}", "p"),
            (4, "z" * 100_000, "p"), (5, "short", "p")]
    docs = spark.createDataFrame([(*r, "c", 0.5) for r in rows],
                                 "doc_id long, text string, source string, candidate string, score double")
    label = F.col("candidate").startswith("AKIA").cast("int")
    found = secret_scan.scan(docs, label, learn=F.lit(True)).collect()
    assert sorted((r.doc_id or 0, r.nth, r.label) for r in found) == [(0, 1, 1), (3, 1, 1), (3, 1, 1), (3, 2, 1), (3, 2, 1), (4, 1, 0)]
    assert secret_scan.scan(docs.where("false"), label, learn=F.lit(True)).count() == 0
    one = secret_scan.scan(docs.where("doc_id = 3"), label, learn=F.lit(True)).collect()
    assert {r.score for r in one} == {5 / 6}


def test_context_reaches_over_other_candidates(spark):
    value = "wJalrXUtnFEMI/K7MDENG/bPxRfiCYEXAMPLEKEY"
    rows = [(1, f"a aws_secret_access_key={value} z"), (2, f'x AWS_SECRET_ACCESS_KEY = "{value}" y'),
            (3, "é " + " ".join(f"{i:016d}" for i in range(9)) + " end")]
    docs = spark.createDataFrame([(*r, "p") for r in rows], "doc_id long, text string, source string")
    found = secret_scan.with_features(secret_scan.candidates(docs), []).collect()
    texts = dict(rows)
    for r in found:
        at = texts[r.id].index(r.candidate)
        assert r.before == texts[r.id][max(0, at - 48):at]
        assert r.after == texts[r.id][at + len(r.candidate):][:48]
    assert [(r.key_word, r.assigned) for r in found if r.candidate == value] == [(1, 1), (1, 1)]


def test_short_and_punctuated_values_and_long_names(spark):
    from daybook.llm.queries import _secret_label
    long = "0123456789abcdefABCD"
    rows = [(1, 'my password = "hunter2Xy9" end', "hunter2Xy9", 1), (2, "db_password='p@ss w0rd!x' end", "p@ss w0rd!x", 1),
            (3, f'access_token = "{long}"', long, 1), (4, f"client_secret: {long}", long, 1),
            (5, f"AUTH_TOKEN={long}", long, 1), (6, f'{{"client_secret_b": "{long}"}}', long, 1),
            (7, f"see {long} there", long, None), (8, "number 9807915762804490 in", "9807915762804490", 0),
            (9, "password: required", "required", None)]
    docs = spark.createDataFrame([(i, t, "p") for i, t, _, _ in rows], "doc_id long, text string, source string")
    found = secret_scan.candidates(docs).withColumn("label", _secret_label()).collect()
    assert sorted((r.id, r.candidate, r.label) for r in found) == [(i, c, y) for i, _, c, y in rows]
    texts = {i: t for i, t, _, _ in rows}
    for r in found:
        at = texts[r.id].index(r.candidate)
        assert r.before == texts[r.id][max(0, at - 48):at]
        assert r.after == texts[r.id][at + len(r.candidate):][:48]


def test_dictionary_beyond_the_most_frequent_words(spark):
    letters = "bcdfghjklm"
    words = [f"{a}o{b}i{c}" for a in letters for b in letters for c in letters[:3]]
    texts = [(i, " ".join(words)) for i in range(5)] + [(9, "rare " + words[-1] + "_" + words[-2] + words[-3] + "/x1x1")]
    docs = spark.createDataFrame([(*t, "p") for t in texts], "doc_id long, text string, source string")
    known = secret_scan.dictionary(docs)
    assert {r.word for r in known.collect()} == set(words)
    found = secret_scan.with_features(secret_scan.candidates(docs), known).collect()
    assert [r.coverage for r in found] == [pytest.approx(15 / 21)]
    long = spark.createDataFrame([(1, "p", 1, "1" * 250 + words[0] * 100 + "x", "", "")],
                                 "id long, path string, nth int, candidate string, before string, after string")
    assert secret_scan.with_features(long, known).first().coverage == pytest.approx(500 / 751)

"""Repeated passages of words against a dictionary of all windows."""

import hashlib
import random
import re

import numpy as np
import pytest

from daybook.llm import doubling
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, window):
    """(id, n_words, n_removed, sha256) of each row, by the smallest id of every window."""
    first, texts = {}, []
    for i, text in rows:
        words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode())
        texts.append((i, words))
        for k in range(len(words) - window + 1):
            name = tuple(words[k:k + window])
            if i is not None and (first.setdefault(name, i) is None or i < first[name]):
                first[name] = i
    out = []
    for i, words in texts:
        gone = bytearray(len(words))
        for k in range(len(words) - window + 1):
            low = first.get(tuple(words[k:k + window]))
            if low is not None and (i is None or low < i):
                gone[k:k + window] = b"\1" * window
        kept = b" ".join(w for w, g in zip(words, gone) if not g)
        out.append((i, len(words), sum(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def frame(spark, rows, kind="long"):
    return spark.createDataFrame([(i, t, 1, 2, "x") for i, t in rows], f"doc_id {kind}, text string, doc int, row int, id string")


def found(df, window):
    rows = doubling.repeated_passages(df, window).collect()
    for r in rows:
        assert r.n_removed == sum(s.b - s.a for s in r.spans) and (r.kept is None) == (r.n_removed == 0)
        assert (r.reach == 0) == (r.n_removed == 0) and (not r.reach or r.reach % window == 0 or r.reach >= window)
        if r.kept is not None:
            assert hashlib.sha256(r.kept.encode()).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str)


def passages(seed, n_docs, alphabet, length):
    """Documents of words, with passages copied between and within them."""
    rng = random.Random(seed)
    docs = [[rng.choice(alphabet) for _ in range(rng.randint(0, length))] for _ in range(n_docs)]
    for _ in range(n_docs):
        source, target = rng.choice(docs), rng.choice(docs)
        begin = rng.randint(0, len(source))
        place = rng.randint(0, len(target))
        target[place:place] = source[begin:begin + rng.randint(0, length)]
    return [(i, rng.choice([" ", "\n", " \t "]).join(d)) for i, d in enumerate(docs)]


WORDS = [f"w{i}" for i in range(5000)]


@pytest.mark.parametrize("window", [1, 2, 5, 8, 50])
def test_passages_between_documents(spark, window):
    rows = passages(window, 40, WORDS, 20 * window)
    assert found(frame(spark, rows), window) == brute(rows, window)


@pytest.mark.parametrize("window", [3, 8])
def test_periodic_texts(spark, window):
    """Few words, so that nearly every window repeats and hashes tie."""
    rows = passages(7, 25, ["a", "b"], 60) + [(100, "a " * 300), (101, "a " * 200 + "b"), (102, "a b " * 150)]
    assert found(frame(spark, rows), window) == brute(rows, window)


COPY = " ".join(f"c{i}" for i in range(60))


def test_odd_rows(spark):
    rows = [
        (5, COPY), (3, f"x {COPY} y"), (3, f"{COPY} z"), (4, None), (4, ""), (6, " \n"), (None, COPY), (None, f"{COPY} n"),
        (7, f"{COPY} {COPY}"), (8, " ".join(f"d{i}" for i in range(70)) + " " + " ".join(f"d{i}" for i in range(70))),
        (9, COPY), (9, COPY), (10, "É é " * 60), (11, "é É " * 60), (12, COPY.upper()),
    ]
    assert found(frame(spark, rows), 50) == brute(rows, 50)
    got = {r.doc_id: r for r in doubling.repeated_passages(frame(spark, rows), 50).collect()}
    assert got[8].n_removed == 0  # repeated within one document only
    assert got[7].n_removed == 120 and got[7].reach >= 50 and got[7].kept == ""


def test_ids_as_text(spark):
    rows = [("b", COPY), ("a:1", f"q {COPY}"), (None, COPY), ("1", "a:" + COPY), ("", COPY)]
    rows_of = [(r.doc_id, r.n_removed) for r in doubling.repeated_passages(frame(spark, rows, "string"), 50).collect()]
    assert sorted(rows_of, key=str) == sorted([("b", 60), ("a:1", 60), (None, 60), ("1", 59), ("", 0)], key=str)


def test_very_long_texts(spark):
    rng = random.Random(1)
    long = [rng.choice(WORDS) for _ in range(150_000)]
    rows = [(1, " ".join(long)), (2, " ".join(long[70_000:])), (3, "x" * 3_000_000), (4, " ".join(long[:49])), (5, "w " * 100_000)]
    got = {r.doc_id: r for r in doubling.repeated_passages(frame(spark, rows), 50).collect()}
    assert {i: (r.n_words, r.n_removed) for i, r in got.items()} == {
        1: (150_000, 0), 2: (80_000, 80_000), 3: (1, 0), 4: (49, 0), 5: (100_000, 0)}
    assert got[2].reach >= 50 * 512  # doubled until nothing repeats


def test_a_passage_in_very_many_documents(spark):
    rows = [(i, f"{COPY} own{i} " + " ".join(f"u{i}_{k}" for k in range(30))) for i in range(3000)]
    got = doubling.repeated_passages(frame(spark, rows), 50).collect()
    assert {(r.doc_id == 0, r.n_removed) for r in got} == {(True, 0), (False, 60)} and len(got) == 3000


def test_no_rows_and_a_wrong_window(spark):
    assert doubling.repeated_passages(frame(spark, []), 50).count() == 0
    assert found(frame(spark, [(1, None), (2, "a b")]), 2) == brute([(1, None), (2, "a b")], 2)
    with pytest.raises(ValueError):
        doubling.repeated_passages(frame(spark, []), 0)


def test_chosen_places_depend_on_their_surroundings_only():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 400).astype(np.uint64)
    whole = doubling._sparse(values, 12)
    part = doubling._sparse(values[100:300], 12)
    assert (whole[120:280] == part[20:180]).all() and 0 < whole.sum() < 120


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    rows = QUERIES["op11_substring_dedup"](spark, SF_DIR).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in rows), key=str) == brute(docs, 50)
    assert sum(r.n_removed > 0 for r in rows) > 50

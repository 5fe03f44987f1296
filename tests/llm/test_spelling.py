"""Neighbours of words against all deletions, insertions and replacements."""

import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from daybook.llm import spelling
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


def neighbours(words):
    """Near words of each word: those with a common form after one deletion, checked one by one."""
    words = set(words)
    deleted, replaced, near = defaultdict(set), defaultdict(set), defaultdict(set)
    for w in words:
        for i in range(len(w)):
            deleted[w[:i] + w[i + 1:]].add(w)
            replaced[w[:i], w[i + 1:]].add(w)
    for w in words:
        for x in deleted.get(w, ()):
            near[w].add(x)
            near[x].add(w)
    for group in replaced.values():
        for w in group:
            near[w] |= group - {w}
    return near


def variants(counts, ratio=10):
    near, form, out = neighbours(counts), {}, []
    for w, n in counts.items():
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= ratio * n else None
    for w, n in counts.items():
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] is not None else None))
    return sorted(out)


def found(df, **options):
    return sorted(tuple(r) for r in spelling.spelling_variants(df, **options).collect())


def frame(spark, counts):
    return spark.createDataFrame(list(counts.items()), "word string, n long")


def test_kinds_of_neighbours(spark):
    counts = {
        "letters": 1000, "leters": 10, "lettters": 9, "lettres": 8, "lettars": 100, "letter": 5, "xletters": 1, "lettersx": 101,
        "alone": 3, "aaaa": 7, "aaa": 70, "aaaaa": 1, "abcd": 2, "abdc": 2, "bcd": 20, "a": 4, "é": 40, "": 400, "éa": 1,
    }
    got = found(frame(spark, counts))
    assert got == [r if r[0] != "" else r for r in variants_with_empty(counts)]


def variants_with_empty(counts):
    """The empty word has no neighbours: it has no position to leave out, and is not searched."""
    rows = variants({w: n for w, n in counts.items() if w})
    return sorted([*rows, ("", None, "", counts[""], 0, None)])


def test_equal_counts_take_the_smallest_word(spark):
    counts = {"bcdefgh": 1, "acdefgh": 50, "zcdefgh": 50, "bcdefg": 50}
    assert found(frame(spark, counts))[2] == ("bcdefgh", "acdefgh", "acdefgh", 1, 3, 50)
    assert found(frame(spark, counts)) == variants(counts)


def test_roots_follow_long_chains(spark):
    word, counts = "a" * 12, {}
    for step in range(12):
        counts[word] = 10 ** (12 - step)
        word = word[:step] + "b" + word[step + 1:]
    got = found(frame(spark, counts))
    assert got == variants(counts) and {r[2] for r in got} == {"a" * 12}


def test_repeated_null_and_long_words(spark):
    long = "ab" * 20_000
    rows = [("word", 1), ("word", 2), (None, 5), (long, 30), (long[:-1], 3), ("word" + "\U0001f600", 40)]
    got = {r[0]: r[1:] for r in found(spark.createDataFrame(rows, "word string, n long"))}
    assert got["word"] == ("word\U0001f600",) * 2 + (3, 1, 40) and got[long[:-1]][0] == long and None not in got


def test_no_words(spark):
    assert found(frame(spark, {"x": 1}).where("false")) == []
    with pytest.raises(ValueError):
        spelling.spelling_variants(frame(spark, {"x": 1}), ratio=1)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.dictionaries(st.text("abñ", min_size=1, max_size=6), st.integers(1, 500), max_size=40))
def test_any_words(spark, counts):
    assert found(frame(spark, counts or {"a": 1}), ratio=3) == variants(counts or {"a": 1}, 3)


def test_groups_across_batches():
    """The same neighbours wherever batches break off."""
    rng = np.random.default_rng(5)
    members = sorted({(int(b), int(s), int(m)) for b, s, m in zip(rng.integers(0, 3, 60), rng.integers(0, 2, 60), rng.integers(0, 40, 60))})
    columns = [np.array(c, np.int64) for c in zip(*members)]
    whole = spelling.neighbours_in_groups(*columns)
    import pyarrow as pa

    for size in (1, 2, 7, 60):
        batches = [
            pa.RecordBatch.from_arrays([pa.array(c[i:i + size]) for c in columns], ["before", "behind", "member"])
            for i in range(0, len(members), size)
        ]
        got = pa.Table.from_batches(list(spelling._neighbours(iter(batches))))
        assert [got[n].to_pylist() for n in ("id", "n", "best")] == [w.tolist() for w in whole]


def words_of(rows):
    counts = Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2 and len(w) >= 7}


def test_vocabulary(spark, monkeypatch):
    text = "ÀBCDEFGH àbcdefgh straße×÷ÿ Straße×÷ÿ short seven77 sevenxx sevenxx under_scores scoresĀlong aaaaaaaa "
    rows = [(i, text * 3) for i in range(60)] + [(None, text), (7, None), (8, ""), (9, "a" * 500_000), (10, "a" * 500_000)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, word int")
    expected = words_of(rows)
    assert {r.word: r.n for r in spelling.vocabulary(df).collect()} == expected and len(expected) > 8
    assert spelling.vocabulary(df.where("false")).count() == 0


def test_query_against_brute_force(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    got = QUERIES["op12_spelling_variants"](spark, SF_DIR)
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = sorted(tuple(r) for r in got.collect())
    assert rows == variants(words_of(docs)) and sum(r[1] is not None for r in rows) > 100

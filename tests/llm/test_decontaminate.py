"""Benchmark decontamination against a search for every window."""

import re

import pytest

from daybook.llm import decontaminate
from daybook.llm.words import words_of

import numpy as np

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window):
    cuts = []
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        cuts += [(str(i) if i is not None else "", w[k:k + n]) for k in range(len(w) - n + 1) if n]
    out = []
    for i, t in docs:
        w, hit, names = words(t), set(), set()
        for item, cut in cuts:
            for k in range(len(w) - len(cut) + 1):
                if w[k:k + len(cut)] == cut:
                    hit.update(range(k, k + len(cut)))
                    names.add(item)
        out.append((i, len(w), len(hit), sorted(names)))
    return sorted(out, key=str)


ITEMS = [(1, "The quick brown fox jumps over the lazy dog today and runs home"), (2, "one two"), (3, "É"),
         (4, None), (5, " ,.! "), (None, "a b c d e f"), (6, "quick brown fox jumps over the lazy dog today and"),
         (7, "x x x x x x x x x x x"), (8, "one two")]
DOCS = [(1, "THE QUICK, brown fox; jumps over the lazy dog -- today and runs"), (2, "one two three one two"),
        (3, None), (4, ""), (5, "é"), (6, "éé café É"), (None, "zzz a b c d e f"), (7, "a b c d e g"),
        (8, "x " * 5000), (8, "x " * 9), (9, "one two"), (9, "one two"), (10, "one"), (11, "two one"),
        (12, "the quick brown fox jumps over the lazy dog")]


@pytest.mark.parametrize("block", [3, 250_000])
def test_against_all_windows(spark, block):
    docs = spark.createDataFrame([(*r, 0, "y") for r in DOCS], "doc_id long, text string, n_words int, id string")
    items = spark.createDataFrame([(*r, 1) for r in ITEMS], "item_id long, text string, items int")
    found = decontaminate.contamination(docs, items, block_windows=block).collect()
    for r in found:
        covered = {k for s in r.spans for k in range(s.starts, s.ends)}
        assert len(covered) == r.n_hit
    assert sorted(((r.doc_id, r.n_words, r.n_hit, r["items"]) for r in found), key=str) == brute(DOCS, ITEMS, 10)
    clean = decontaminate.keep_clean(docs, items, block_windows=block)
    assert clean.columns == docs.columns
    assert sorted(r.doc_id for r in clean.collect()) == [3, 4, 5, 7, 10, 11, 12]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert decontaminate.contamination(docs.where("false"), items).count() == 0
    assert {r.n_hit for r in decontaminate.contamination(docs, items.where("false")).collect()} == {0}
    assert decontaminate.keep_clean(docs, items.where("false")).count() == len(DOCS)


def test_words_of_neighbouring_texts_stay_apart():
    texts = ["ab", "cd ef", "", "9é", "-x-"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    found = words_of(data, np.cumsum([len(t.encode()) for t in texts]))
    assert [found.word(i).decode() for i in range(len(found.hashes))] == ["ab", "cd", "ef", "9é", "x"]
    assert found.text.tolist() == [0, 1, 1, 3, 4]
    assert found.shingles(2)[1].tolist() == [False, True, False, False]

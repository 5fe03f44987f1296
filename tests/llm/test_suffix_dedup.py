"""Repeated passages against a dictionary of all windows."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from daybook.llm import suffix_dedup
from daybook.llm.queries import QUERIES
from daybook.llm.suffix_array import longest_previous, repeated, suffix_order

SF_DIR = "/root/testdata/sf0.01"


def brute(rows, length, keep_first):
    """(id, n_bytes, spans, sha256) of each row by a set of all windows."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    counts = Counter()
    for _, t in rows:
        b = (t or "").encode()
        counts.update(b[i:i + length] for i in range(len(b) - length + 1))
    seen, out = set(), []
    for i, t in ordered:
        b = (t or "").encode()
        cover = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            w = b[k:k + length]
            if w in seen if keep_first else counts[w] > 1:
                cover[k:k + length] = True
            seen.add(w)
        turn = np.diff(np.concatenate(([False], cover, [False])).astype(int))
        spans = list(zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist()))
        left = bytes(np.frombuffer(b, np.uint8)[~cover])
        out.append((i, len(b), spans, hashlib.sha256(left).hexdigest()))
    return sorted(out, key=str)


def found(frame, **options):
    rows = suffix_dedup.repeated_spans(frame, **options).collect()
    for r in rows:
        assert (r.kept is None) == (not r.spans)
        if r.kept is not None:
            assert hashlib.sha256(r.kept).hexdigest() == r.kept_sha256
    return sorted(((r.doc_id, r.n_bytes, [tuple(s) for s in r.spans], r.kept_sha256) for r in rows), key=str)


def corpus(seed, docs=60):
    rng = random.Random(seed)
    words = ["ab", "cde", "é", "fgh", "ijk lm", "n\n", "opq", "r"]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    shared = [text(25) for _ in range(4)]
    rows = []
    for i in range(docs):
        parts = [text(rng.randint(0, 20))]
        for _ in range(rng.randint(0, 2)):
            parts += [rng.choice(shared), text(rng.randint(0, 20))]
        rows.append((i, "".join(parts)))
    return rows + [(docs, "xy " * 700), (docs + 1, "q" + "xy " * 300), (docs + 2, None), (docs + 3, "")]


def test_longest_previous_factor():
    text = b"abaabababbabbabaab"
    order = sorted(range(len(text)), key=lambda i: text[i:])

    def lcp(i, j):
        n = 0
        while max(i, j) + n < len(text) and text[i + n] == text[j + n]:
            n += 1
        return n

    common = [0] + [lcp(a, b) for a, b in zip(order, order[1:])]
    expected = [max([lcp(i, j) for j in range(i)], default=0) for i in range(len(text))]
    assert longest_previous(order, common) == expected


def test_suffix_order_and_repeats():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 99, 600).astype(np.uint8)
    starts = np.arange(len(data) - 7)
    order, common = suffix_order(data, starts, 8)
    windows = [data[s:s + 8].tobytes() for s in starts]
    assert [windows[i] for i in order] == sorted(windows)
    earlier, later = repeated(data, starts, 8)
    assert earlier.tolist() == [w in windows[:i] for i, w in enumerate(windows)]
    assert later.tolist() == [w in windows[i + 1:] for i, w in enumerate(windows)]
    assert common.max() == 8


@pytest.mark.parametrize("keep_first", [True, False])
def test_against_all_windows(spark, monkeypatch, keep_first):
    monkeypatch.setattr(suffix_dedup, "GROUP_PIECES", 5)  # so that hot anchors are dealt anew
    monkeypatch.setattr(suffix_dedup, "PIECE_WINDOWS", 64)
    monkeypatch.setattr(suffix_dedup, "ARRAY_WINDOWS", 500)
    rows = corpus(5)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"length": 40, "anchor": 16, "keep_first": keep_first}
    assert found(frame, **options) == brute(rows, 40, keep_first)


def test_odd_rows(spark):
    rows = [(1, "a" * 90), (None, "b" * 30 + "c" * 30), (2, "b" * 30 + "c" * 30), (2, "b" * 30 + "c" * 30),
            (3, None), (4, "short")]
    frame = spark.createDataFrame([(*r, 1, "x") for r in rows], "doc_id long, text string, at int, doc string")
    options = {"length": 40, "anchor": 16, "keep_first": False}
    assert found(frame, **options) == brute(rows, 40, False)
    assert found(frame.where("false"), **options) == []


def test_query_against_all_windows(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    expected = [(i, n, sum(b - a for a, b in s), len(s), h) for i, n, s, h in brute(rows, 400, False)]
    result = QUERIES["op8_suffix_dedup"](spark, SF_DIR)
    assert sorted((tuple(r) for r in result.collect()), key=str) == sorted(expected, key=str)


@pytest.mark.parametrize("keep_first", [True, False])
def test_more_run_lengths_of_one_byte_than_a_group_holds(spark, monkeypatch, keep_first):
    monkeypatch.setattr(suffix_dedup, "PIECE_WINDOWS", 150)
    lengths = suffix_dedup.GROUP_PIECES + 10
    rows = [(i, f"a{i}b" + "-" * (40 + i) + f"c{i}d") for i in range(lengths)]
    rows += [(lengths, "x" + "=" * 40 + "y"), (lengths + 1, "-" * 400)]
    random.Random(3).shuffle(rows)
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    options = {"length": 40, "anchor": 16, "keep_first": keep_first}
    assert found(frame, **options) == brute(rows, 40, keep_first)

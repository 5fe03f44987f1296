"""Encoding against a plain search over all segmentations, and exact round trips."""

import random

import pytest

from daybook.llm import sentencepiece_viterbi as sp
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def vocabulary():
    return sp.load_pieces()


def plain(text, vocabulary):
    """The best ids of ' ' + text by trying every piece at every place; longer last pieces win ties."""
    scores = {p: (i, s) for p, i, s in vocabulary["pieces"]}
    longest = max(map(len, scores))
    unknown = min(s for _, s in scores.values()) - sp.UNKNOWN_COST
    text = " " + text
    best = [(0.0, [])]
    for end in range(1, len(text) + 1):
        found = []
        for start in range(max(0, end - longest), end):
            piece = text[start:end]
            if piece in scores:
                found.append((best[start][0] + scores[piece][1], -start, best[start][1] + [scores[piece][0]]))
        if text[end - 1] not in scores:
            ids = [vocabulary["bytes"][b] for b in text[end - 1].encode()]
            found.append((best[end - 1][0] + unknown, 1 - end, best[end - 1][1] + ids))
        top = max(found, key=lambda f: f[:2])
        best.append((top[0], top[2]))
    return best[-1][1]


TEXTS = ["a", " ", "  ", "Hello  wörld\n\tx 漢字 ", "▁ a▁b ▁", "the the the", "🙂🙂 \x00\x1f", "   lead and trail   ",
         "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "é" * 40, "\n\n\n", "a\n b", "x" * 300]


def test_best_segmentation(vocabulary):
    encoder = sp.Encoder(vocabulary)
    rng = random.Random(3)
    texts = TEXTS + ["".join(rng.choice("etaoin shr \né.,") for _ in range(60)) for _ in range(30)]
    for text in texts:
        ids = [int.from_bytes(encoder.encode(text)[i:i + 4], "little") for i in range(0, len(encoder.encode(text)), 4)]
        assert ids == plain(text, vocabulary), text
        assert sp.decode(ids, vocabulary["table"]) == text


def test_parts_change_nothing(vocabulary):
    whole, parts = sp.Encoder(vocabulary), sp.Encoder(vocabulary)
    assert parts.parts
    whole.parts = False
    for text in TEXTS:
        assert whole.encode(text) == parts.encode(text)


def test_round_trip_of_all_documents(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    found = QUERIES["op9_sentencepiece"](spark, SF_DIR)
    assert found.where("round_trip").count() == docs.count()
    back = {r.doc_id: r.text for r in sp.decode_documents(found).collect()}
    assert back == {r.doc_id: r.text for r in docs.collect()}


def test_rows_of_all_kinds(spark, vocabulary, monkeypatch):
    monkeypatch.setattr(sp, "MEMORY", 2)
    rows = [(1, None), (2, ""), (None, "a b c d"), (None, "a b c d"), (3, "word " * 50_000), *enumerate(TEXTS, 10)]
    frame = spark.createDataFrame([(*r, [1], "x") for r in rows], "doc_id long, text string, pieces array<int>, same string")
    found = sp.encode_documents(frame)
    assert found.where("not round_trip or n_pieces <> size(pieces)").count() == 0
    assert sorted(((r.doc_id, r.text) for r in sp.decode_documents(found).collect()), key=str) == sorted(
        ((i, t or "") for i, t in rows), key=str)
    assert found.where("doc_id in (1, 2) and n_pieces = 0").count() == 2
    assert sp.encode_documents(frame.where("false")).count() == 0

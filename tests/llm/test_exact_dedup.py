"""Exact dedup on odd rows, hot groups and forced hash collisions."""

import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from daybook.llm import exact_dedup


def brute(rows):
    groups = defaultdict(list)
    for n, (i, t) in enumerate(rows):
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", t or "")].append((i is None, i or 0, n))
    out = []
    for text, members in groups.items():
        first = min(members)
        for m in members:
            out.append((None if m[0] else m[1], None if first[0] else first[1], len(members),
                        hashlib.sha256(text.encode()).hexdigest()))
    return sorted(out, key=str)


ROWS = ([(i, "same  text\n") for i in range(50, 350)] + [(7, "same text "), (7, "same text "), (None, "same text ")]
        + [(None, "no id"), (None, "no  id")] + [(1, None), (2, ""), (3, " "), (4, "\t\n ")]
        + [(400, "x" * 200_000), (401, "x" * 200_000), (402, "x" * 200_001), (403, "É"), (404, "É")])


def check(spark, **options):
    frame = spark.createDataFrame([(*r, "b", 1) for r in ROWS], "doc_id long, text string, hash string, row int")
    found = exact_dedup.exact_duplicates(frame, **options).collect()
    assert sorted(((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in found), key=str) == brute(ROWS)
    kept = defaultdict(int)
    for r in found:
        kept[r.text_sha256] += r.kept
        assert not r.kept or r.doc_id == r.keep_id
    assert set(kept.values()) == {1}
    return frame


def test_rows_of_all_kinds(spark):
    frame = check(spark)
    stay = exact_dedup.keep_first(frame).collect()
    assert len(stay) == len({r[3] for r in brute(ROWS)})
    assert stay[0].__fields__ == frame.columns
    assert {r.doc_id for r in stay} == {7, None, 1, 3, 400, 402, 403}


def test_collisions_are_told_apart_by_bytes(spark):
    check(spark, hashed=lambda text: F.unhex(F.lpad(F.hex(F.length(text) % 3), 2, "0")))


def test_empty(spark):
    frame = spark.createDataFrame([], "doc_id long, text string")
    assert exact_dedup.exact_duplicates(frame).count() == 0
    assert exact_dedup.keep_first(frame).count() == 0

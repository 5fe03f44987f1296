"""SimHash near-dedup against all pairs, and the parts it is made of."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from daybook.llm import simhash
from daybook.llm.bktree import BKTree, spanning_links
from daybook.llm.components import components
from daybook.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def roots(n, pairs):
    parent = list(range(n))

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for a, b in pairs:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return [find(i) for i in range(n)]


def close_points(count, seed):
    rng = random.Random(seed)
    points = [rng.getrandbits(64) for _ in range(count)]
    for _ in range(count):
        p = rng.choice(points)
        for _ in range(rng.randint(1, 6)):
            p ^= 1 << rng.randrange(64)
        points.append(p)
    return list(dict.fromkeys(points))


def test_tree_finds_what_all_pairs_find():
    points = np.array(close_points(400, 1), np.uint64)
    found = {(int(q), int(p)) for qs, ps in BKTree(points).within(points, 4) for q, p in zip(qs, ps)}
    near = np.bitwise_count(points[:, None] ^ points[None, :]) <= 4
    assert found == set(zip(*map(np.ndarray.tolist, np.nonzero(near))))


def test_spanning_links_join_the_same_sets():
    points = np.array(close_points(400, 2), np.uint64)
    a, b = spanning_links(points, 4)
    at = {int(p): i for i, p in enumerate(points)}
    pairs = np.nonzero(np.bitwise_count(points[:, None] ^ points[None, :]) <= 4)
    expected = roots(len(points), zip(*pairs))
    assert roots(len(points), [(at[int(x)], at[int(y)]) for x, y in zip(a, b)]) == expected
    assert len(a) == len(points) - len(set(expected))


@pytest.mark.parametrize("radius", [0, 1, 4])
def test_shards_miss_no_link(spark, radius):
    points = close_points(300, 3)
    signed = [p - (1 << 64) if p >> 63 else p for p in points]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    links = [(r.u, r.v) for r in simhash.near_links(frame, radius, shard_rows=2).collect()]
    at = {p: i for i, p in enumerate(signed)}
    array = np.array(points, np.uint64)
    pairs = np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= radius)
    assert roots(len(points), [(at[a], at[b]) for a, b in links]) == roots(len(points), zip(*pairs))


def test_components_of_chains_and_hubs(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    random.Random(4).shuffle(edges)
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert found == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)}


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


def brute(rows, shingle=4, radius=4):
    fps = [simhash.fingerprint((t or "").encode(), shingle) for _, t in rows]
    array = np.array(fps, np.uint64)
    pairs = np.nonzero(np.bitwise_count(array[:, None] ^ array[None, :]) <= radius)
    root = roots(len(rows), zip(*pairs))
    low = {}
    for (i, _), r in zip(rows, root):
        if i is not None:
            low[r] = min(i, low.get(r, i))
    return sorted(((i, format(f, "016x"), low.get(r)) for (i, _), f, r in zip(rows, fps, root)), key=str)


def test_fingerprint_matches_sparks_hash(spark):
    text = "The  quick\tBrown fox\n jumps over ÄÖ dogs"
    words = text.translate({c: c + 32 for c in range(65, 91)}).split()
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)]
    hashes = [r[0] for r in spark.createDataFrame([(s,) for s in shingles], "s string")
              .select(F.xxhash64("s")).collect()]
    expected = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert simhash.fingerprint(text.encode(), 4) == expected


def test_query_against_all_pairs(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").collect()]
    found = QUERIES["op4_simhash_near_dedup"](spark, SF_DIR).collect()
    assert sorted((tuple(r) for r in found), key=str) == brute(rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (None, "a b c d e"), (None, "only here x y"), (4, "a b c d e"),
            (4, "a b c d e"), (5, "word " * 30_000), (6, "word " * 30_001), (7, "x")]
    frame = spark.createDataFrame(
        [(i, t, "id", 0) for i, t in rows], "doc_id long, text string, row string, fp int"
    )
    found = simhash.near_duplicates(frame)
    assert sorted((tuple(r) for r in found.collect()), key=str) == brute(rows)
    assert {r.doc_id for r in simhash.keep_one(frame).collect()} == {1, 4, 5, 7, None}
    empty = simhash.near_duplicates(frame.where("false"))
    assert empty.count() == 0 and empty.columns == ["doc_id", "fingerprint", "component_id"]

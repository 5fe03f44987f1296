"""Spelling variants by a trie-node pair dictionary.

The words of a vocabulary make a trie, and their reversals a second one. Every node of both
has a number, so a word with one position left out is a pair of integers: the node of what
stands before the position, and the node of what stands behind it in the reversed trie. Two
words are one replacement apart exactly if they share such a pair at a left-out position.
They are one insertion apart exactly if the pair of a left-out position of the longer one is
the pair of a place between two positions of the shorter one. So one grouping by pairs of
integers finds all neighbours, and no distance is ever computed.

A group holds at most one word for each character at the left-out position and one shorter
word, so its size is bounded by the alphabet. A node that only one word passes through is in
no other word's pairs; pairs with such a node are not made. Groups give each member a count
and its best neighbour, never a list of pairs.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged

#: Contract of the query: letters of a run, the divisor that picks runs to shorten, the
#: least length and count of a word, and how much more frequent a form has to be.
LETTERS = "[A-Za-zÀ-ÿ]"
DIVISOR = 31
MIN_LENGTH = 7
MIN_COUNT = 2
RATIO = 10

#: Code points by which words are dealt over tasks. A prefix shorter than this is numbered
#: by its code points (21 bits each), a longer one by the task that holds all its words.
HEAD = 3
CODE_BITS = 21
#: Distinct words that a task counts before it hands the counts on.
COUNTED_WORDS = 200_000


# --- vocabulary ----------------------------------------------------------------

def _counted(letters: str, divisor: int, min_length: int):
    run_of = re.compile(f"{letters}{{{min_length},}}")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: Counter[bytes] = Counter()

        def counts() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([
                pa.array([w.decode() for w in seen], pa.string()),
                pa.array(list(seen.values()), pa.int64()),
            ], ["word", "n"])
            seen.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text")):
                if not text.is_valid:
                    continue
                own = f"{'' if doc is None else doc}:".encode()
                start = crc32(own)
                for run, n in Counter(run_of.findall(text.as_py())).items():
                    word = run.encode().lower()  # bytes: lowers A-Z only
                    h = crc32(word, start)
                    if h % divisor == 0:
                        run = word.decode()
                        if len(run) <= min_length:
                            continue
                        at = h % len(run)
                        word = (run[:at] + run[at + 1:]).encode()
                    seen[word] += n
                if len(seen) >= COUNTED_WORDS:
                    yield counts()
        if seen:
            yield counts()

    return count


def vocabulary(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT,
               divisor: int = DIVISOR, letters: str = LETTERS, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """Distinct words of the texts with their counts: (word, n).

    Words are maximal runs of ``letters`` with A-Z lowered. A run whose crc32 of
    ``<id>:<run>`` the divisor divides loses the code point at that number modulo the
    run's length. Words of fewer than ``min_length`` code points, and those counted fewer
    than ``min_count`` times overall, go.

    * A null text has no words; a null id counts as an empty one.
    * Repeated rows count each. No rows in, no words out. Other columns are ignored.
    """
    counted = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_counted(letters, divisor, min_length), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# --- node numbers -------------------------------------------------------------

def _shared(a: str, b: str) -> int:
    """Length of the common prefix."""
    for i, (x, y) in enumerate(zip(a, b)):
        if x != y:
            return i
    return min(len(a), len(b))


def _numbered(backward: bool, keep: list[str], into: str):
    """Add the numbers of the nodes on each word's path that other words pass through, too.

    Rows come sorted, so the words of a node follow each other: the path of the last word
    is all that is held. The list begins with the root; a node's depth is its place.
    """
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers of different tasks differ; those made of code points are negative.
        context = TaskContext.get()
        number = (context.partitionId() if context else 0) << 36
        last, path, pending = "", [0], None
        for batch in batches:
            words = batch.column("word").to_pylist()
            others = [batch.column(c).to_pylist() for c in keep]
            rows, nodes = [], []
            for i, word in enumerate(words):
                path_word = word[::-1] if backward else word
                same = _shared(last, path_word)
                if pending:
                    # Depths up to HEAD may be shared with words in other tasks.
                    rows.append(pending[0])
                    nodes.append(pending[1][:max(pending[2], same, HEAD) + 1])
                del path[same + 1:]
                for depth in range(len(path), len(path_word) + 1):
                    if depth <= HEAD:
                        code = 0
                        for c in path_word[:depth]:
                            code = code << CODE_BITS | (ord(c) + 1)
                        path.append(~code)
                    else:
                        number += 1
                        path.append(number)
                pending = ([word, *(o[i] for o in others)], list(path), same)
                last = path_word
            yield _paths(rows, nodes, batch, keep, into)
        if pending:
            yield _paths([pending[0]], [pending[1][:max(pending[2], HEAD) + 1]], batch, keep, into)

    return add


def _paths(rows: list[list], nodes: list[list[int]], like: pa.RecordBatch, keep: list[str],
           into: str) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in ["word", *keep]]
    return pa.RecordBatch.from_arrays([
        *(pa.array(list(c), like.schema.field(n).type) for c, n in zip(columns, ["word", *keep])),
        pa.array(nodes, pa.list_(pa.int64())),
    ], ["word", *keep, into])


def node_numbers(words: DataFrame) -> DataFrame:
    """Words (id, word) with the numbers of their shared trie nodes, forward and backward.

    ``forward[i]`` is the node of the first i code points, ``backward[i]`` that of the last i.
    Equal prefixes have equal numbers and different ones different numbers, over the whole
    vocabulary; likewise suffixes.
    """
    ahead = (
        words.select("word", "id").repartition(F.substring("word", 1, HEAD)).sortWithinPartitions("word")
        .mapInArrow(_numbered(False, ["id"], "forward"), "word string, id long, forward array<long>")
    )
    return (
        ahead.repartition(F.substring(F.reverse("word"), 1, HEAD)).sortWithinPartitions(F.reverse("word"))
        .mapInArrow(_numbered(True, ["id", "forward"], "backward"),
                    "word string, id long, forward array<long>, backward array<long>")
    )


# --- pairs and neighbours -----------------------------------------------------

#: A member of a group: 1 for a place between two positions, the word's id, and 1 for a
#: left-out position that ends a run of equal characters, in one integer.
BETWEEN = 1 << 62


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The pairs of nodes of each word's left-out positions and of the places between."""
    for batch in batches:
        before, behind, member = [], [], []

        def flush() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in (before, behind, member)], ["before", "behind", "member"]
            )
            for c in (before, behind, member):
                c.clear()
            return out

        columns = [batch.column(c).to_pylist() for c in ("word", "id", "forward", "backward")]
        for word, number, forward, backward in zip(*columns):
            length = len(word)
            # Leaving out position i: i code points before it, length - 1 - i behind it.
            for i in range(max(0, length - len(backward)), min(length, len(forward))):
                # Leaving out either of two equal neighbours gives the same word.
                last = i == length - 1 or word[i] != word[i + 1]
                before.append(forward[i])
                behind.append(backward[length - 1 - i])
                member.append(number << 1 | last)
            for i in range(max(0, length + 1 - len(backward)), min(length + 1, len(forward))):
                before.append(forward[i])
                behind.append(backward[length - i])
                member.append(BETWEEN | number << 1)
            if len(member) >= 1 << 17:
                yield flush()
        yield flush()


NONE = np.iinfo(np.int64).max


def neighbours_in_groups(before: np.ndarray, behind: np.ndarray,
                         member: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ids, counts and best (smallest) neighbours in whole groups, sorted by all three columns.

    A group has its left-out members first, by id, and at most one word between positions,
    which is last. Left-out members are neighbours of each other; the word between is a
    neighbour of those that end a run of equal characters.
    """
    if not len(member):
        return member, member, member
    new = np.ones(len(member), bool)
    new[1:] = (before[1:] != before[:-1]) | (behind[1:] != behind[:-1])
    start = np.flatnonzero(new)
    group = np.cumsum(new) - 1
    between = member >= BETWEEN
    ids = (member & (BETWEEN - 1)) >> 1
    last = (member & 1).astype(bool)
    left_out = np.add.reduceat((~between).astype(np.int64), start)
    size = np.diff(np.append(start, len(member)))
    # Best and second best of the left-out members; the word between, if there is one.
    best = np.where(left_out > 0, ids[start], NONE)
    second = np.where(left_out > 1, ids[np.minimum(start + 1, len(ids) - 1)], NONE)
    shorter = np.where(size > left_out, ids[np.minimum(start + left_out, len(ids) - 1)], NONE)
    ends = np.add.reduceat((last & ~between).astype(np.int64), start)
    best_end = np.minimum.reduceat(np.where(last & ~between, ids, NONE), start)

    count = np.where(between, ends[group], left_out[group] - 1 + (last & (shorter[group] != NONE)))
    other = np.where(ids == best[group], second[group], best[group])
    other = np.where(last, np.minimum(other, shorter[group]), other)
    near = np.where(between, best_end[group], other)
    some = count > 0
    return ids[some], count[some], near[some]


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pairs to (id, n, best); a group that a batch breaks off in is carried over."""
    held = [np.empty(0, np.int64)] * 3

    def result(columns: list[np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(c) for c in neighbours_in_groups(*columns)], ["id", "n", "best"]
        )

    for batch in batches:
        columns = [np.concatenate([h, batch.column(c).to_numpy()])
                   for h, c in zip(held, ("before", "behind", "member"))]
        if not len(columns[0]):
            continue
        open_ = (columns[0] == columns[0][-1]) & (columns[1] == columns[1][-1])
        cut = len(open_) - int(np.argmin(open_[::-1])) if not open_.all() else 0
        held = [c[cut:] for c in columns]
        yield result([c[:cut] for c in columns])
    yield result(held)


def near_words(words: DataFrame) -> DataFrame:
    """For words (id, word): id, number of words one edit away, and the smallest of their ids.

    Words are distinct and not empty. A word without such neighbours has no row.
    """
    numbered = staged(node_numbers(words), "spelling-nodes")
    pairs = numbered.mapInArrow(_pairs, "before long, behind long, member long")
    return (
        pairs.repartition("before", "behind").sortWithinPartitions("before", "behind", "member")
        .mapInArrow(_neighbours, "id long, n long, best long")
        .groupBy("id").agg(F.sum("n").alias("n_near"), F.min("best").alias("best"))
    )


# --- forms ---------------------------------------------------------------------

def spelling_variants(words: DataFrame, ratio: int = RATIO) -> DataFrame:
    """One row per word of (word, n): word, form, root, n, n_near, form_n.

    Words are near if exactly one inserted, deleted or replaced code point makes one the
    other. ``form`` is the near word of largest n (ties: the smallest by code points), if
    that n is at least ``ratio`` times the word's own, else null; ``form_n`` its n.
    ``root`` follows forms to the last one; it is the word itself if there is none.

    * A null word is left out. A word that comes twice counts as one with the sum of its n.
    * With a ratio over 1 no word is its own root's form, as n grows along forms.
    * No rows in, no rows out.
    """
    if ratio < 2:
        raise ValueError("a form has to be more frequent than its variant")
    # Ids follow (n descending, word), so the smallest id is the best neighbour.
    order = [F.col("n").desc(), F.col("word")]
    ranked = staged(
        words.where(F.col("word").isNotNull()).groupBy("word").agg(F.sum("n").alias("n"))
        .repartitionByRange(*order).sortWithinPartitions(*order)
        .withColumn("id", F.monotonically_increasing_id()),
        "spelling-words",
    )
    near = staged(near_words(ranked.where(F.col("word") != "")), "spelling-near")
    best = ranked.select(F.col("id").alias("best"), F.col("word").alias("form"), F.col("n").alias("form_n"))
    known = staged(
        ranked.join(near.join(best.hint("merge"), "best").hint("merge"), "id", "left").select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
            *[F.when(F.col("form_n") >= ratio * F.col("n"), F.col(c)).alias(c) for c in ("best", "form", "form_n")],
        ),
        "spelling-forms",
    )
    # Each step doubles the part of the way that is behind; n grows by the ratio per form.
    ways = staged(known.where(F.col("best").isNotNull()).select("id", F.col("best").alias("to")), "spelling-way")
    while True:
        on = ways.select(F.col("id").alias("to"), F.col("to").alias("further"))
        step = ways.join(on.hint("merge"), "to", "left")
        if step.where(F.col("further").isNotNull()).isEmpty():
            break
        ways = staged(step.select("id", F.coalesce("further", "to").alias("to")), "spelling-way")
    roots = ways.join(
        ranked.select(F.col("id").alias("to"), F.col("word").alias("root")).hint("merge"), "to"
    ).select("id", "root")
    return known.join(roots.hint("merge"), "id", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

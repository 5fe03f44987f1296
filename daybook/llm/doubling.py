"""Removal of repeated passages of words by level-wise doubling.

A passage is a window of consecutive words; a window goes if the same words also start in
a document with a smaller id. Lengths double, and only what repeats at one length alone
is looked at again at twice that length:

1. Half a window. Each full window is represented by the smallest hash among its half-length
   windows, so equal windows share it, and consecutive windows mostly share one. Only
   windows whose half repeats in another document go on (all others are unique).
2. Full windows, then windows of 2, 4, 8, ... times the length, at places chosen by their
   representatives (fewer for each length), until none repeats any more. A window that
   repeats in a smaller document proves at once that every full window inside it goes.
3. Full windows that are not proved yet are decided one by one, if a smaller document holds
   their half: these are the ends of passages. So are, as witnesses, the unproved windows of
   other documents with the same half.

Windows are compared by 128 bits of two independent polynomial hashes. Groups are combined
before a shuffle (smallest and largest id), and only texts with candidates are kept, so a
passage in a third of all documents costs one row per task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import reduce
from itertools import count

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged, text_chunks
from daybook.llm.words import BASE, INVERSE, mixed, powers

#: Words of a window.
WINDOW = 50
#: One of so many places in a row is doubled at the first two lengths, of twice as many at the next ...
SPARSE = 3

SPACE = np.zeros(256, bool)
SPACE[[32, *range(9, 14)]] = True

#: Odd bases of the two hashes of words and of windows, and the inverses modulo 2^64.
BASES = (BASE, 0xD1342543DE82EF95)
INVERSES = (INVERSE, pow(BASES[1], -1, 1 << 64))
STEPS = (0xAEF17502108EF2D9, 0xDB4F0B9175AE2165)
STEP_INVERSES = tuple(pow(s, -1, 1 << 64) for s in STEPS)


class Chunk:
    """Words of several texts: where they lie, whose they are, and prefix sums of hashes."""

    def __init__(self, data: np.ndarray, text_ends: np.ndarray):
        inside = ~SPACE[data]
        first = np.zeros(len(data) + 1, bool)  # where a text begins a word cannot go on
        first[0] = True
        first[text_ends] = True
        before = np.concatenate(([False], inside))
        after = np.concatenate((inside, [False]))
        self.data = data
        self.starts = np.flatnonzero(after & (~before | first))
        self.ends = np.flatnonzero(before & (~after | first))
        self.text = np.searchsorted(text_ends, self.starts, "right")
        #: Number of the first word of each text, and of the word behind its last one.
        self.first = np.searchsorted(self.text, np.arange(len(text_ends) + 1))
        values = data.astype(np.uint64) + np.uint64(1)
        self.sums = []
        for base, inverse, step in zip(BASES, INVERSES, STEPS):
            sums = np.zeros(len(data) + 1, np.uint64)
            np.cumsum(values * powers(base, len(data)), out=sums[1:])
            words = mixed((sums[self.ends] - sums[self.starts]) * powers(inverse, len(data) + 1)[self.starts])
            total = np.zeros(len(words) + 1, np.uint64)
            np.cumsum(words * powers(step, len(words)), out=total[1:])
            self.sums.append(total)

    def names(self, at: np.ndarray, length: int | np.ndarray, which: int) -> np.ndarray:
        """Hashes of the windows of ``length`` words that begin at words ``at``."""
        sums = self.sums[which]
        return mixed((sums[at + length] - sums[at]) * powers(STEP_INVERSES[which], len(sums))[at])

    def windows(self, length: int) -> np.ndarray:
        """Places of the windows that lie within one text."""
        if len(self.text) < length:
            return np.empty(0, np.int64)
        return np.flatnonzero(self.text[:len(self.text) - length + 1] == self.text[length - 1:])

    def representatives(self, window: int) -> tuple[np.ndarray, np.ndarray]:
        """Full windows, and of each the smallest hash of the half-length windows in it."""
        at = self.windows(window)
        if not len(at):
            return at, np.empty(0, np.uint64)
        half = -(-window // 2)
        low = self.names(np.arange(len(self.text) - half + 1), half, 0)
        width, wanted = 1, window - half + 1
        while width < wanted:
            step = min(width, wanted - width)
            low = np.minimum(low[:-step], low[step:])
            width += step
        return at, low[at]


def _lists(owner: np.ndarray, texts: int, *values: np.ndarray) -> list[pa.Array]:
    """One list per text of each array of values; ``owner`` is sorted."""
    offsets = pa.array(np.searchsorted(owner, np.arange(texts + 1)).astype(np.int32))
    return [pa.ListArray.from_arrays(offsets, pa.array(v)) for v in values]


def _base(window: int):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, ends in text_chunks(batch.column("text")):
                part = batch.slice(first, len(ends))
                chunk = Chunk(data, ends)
                at, low = chunk.representatives(window)
                # One key per text and representative.
                owner = chunk.text[at]
                new = np.ones(len(at), bool)
                new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
                order = np.lexsort((low[new], owner[new]))
                owner, low = owner[new][order], low[new][order]
                new = np.ones(len(low), bool)
                new[1:] = (low[1:] != low[:-1]) | (owner[1:] != owner[:-1])
                keys, = _lists(owner[new], len(ends), low[new].view(np.int64))
                starts = np.concatenate(([0], ends[:-1]))
                sha = [
                    hashlib.sha256(b" ".join(data[a:b].tobytes().split())).digest()
                    for a, b in zip(starts.tolist(), ends.tolist())
                ]
                yield pa.RecordBatch.from_arrays([
                    part.column("row"), part.column("doc"), part.column("id"),
                    pa.array(np.diff(chunk.first).astype(np.int64)), pa.array(sha, pa.binary()), keys,
                ], ["row", "doc", "id", "n_words", "sha", "keys"])

    return read


def _sliding(lower: np.ufunc, values: np.ndarray, width: int) -> np.ndarray:
    """The smallest (or largest) of each ``width`` values in a row."""
    done = 1
    while done < width and len(values):
        step = min(done, width - done)
        values = lower(values[:-step], values[step:])
        done += step
    return values


def _sparse(low: np.ndarray, width: int) -> np.ndarray:
    """Which values are the smallest of some ``width`` values in a row."""
    if len(low) < width:
        return np.zeros(len(low), bool)
    edge = np.zeros(width - 1, low.dtype)
    return _sliding(np.maximum, np.concatenate((edge, _sliding(np.minimum, low, width), edge)), width) == low


def _candidates(window: int):
    """Candidate windows of texts, as runs of one representative, and windows to double."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, ends in text_chunks(batch.column("text")):
                part = batch.slice(first, len(ends))
                chunk = Chunk(data, ends)
                at, low = chunk.representatives(window)
                owner = chunk.text[at]
                held = _asked(low, owner, batch.column("keys"), first, len(ends))
                at, low, owner = at[held], low[held], owner[held]
                place = (at - chunk.first[owner]).astype(np.int32)
                new = np.ones(len(at) + 1, bool)
                new[1:-1] = (at[1:] != at[:-1] + 1) | (owner[1:] != owner[:-1]) | (low[1:] != low[:-1])
                begin, end = np.flatnonzero(new[:-1]), np.flatnonzero(new[1:])
                runs = _lists(owner[begin], len(ends), place[begin], place[end] + np.int32(1),
                              low[begin].view(np.int64))

                # Each start is doubled as long as it is chosen and its text is long enough.
                left = chunk.first[owner[begin] + 1] - at[begin]
                depth = np.zeros(len(begin), np.int64)
                for level in count():
                    on = (depth == level) & (left >= window << level)
                    on &= _sparse(low[begin], SPARSE << max(level - 1, 0))
                    if not on.any():
                        break
                    depth[on] += 1
                some = depth > 0
                begin, depth = begin[some], depth[some]
                start = np.repeat(at[begin], depth)
                offsets = np.concatenate(([0], np.cumsum(depth)))
                length = window << (np.arange(len(start)) - np.repeat(offsets[:-1], depth))
                names = [
                    pa.ListArray.from_arrays(
                        pa.array(offsets.astype(np.int32)), pa.array(chunk.names(start, length, k).view(np.int64))
                    ) for k in (0, 1)
                ]
                doubled = _lists(owner[begin], len(ends), place[begin], *names)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc"), part.column("id"), part.column("text"), *runs, *doubled],
                    ["doc", "id", "text", "from", "to", "key", "at", "xs", "ys"],
                )

    return read


def _asked(low: np.ndarray, owner: np.ndarray, keys: pa.Array, first: int, texts: int) -> np.ndarray:
    """Which windows have a representative among the keys of their text."""
    held = np.zeros(len(low), bool)
    edges = np.searchsorted(owner, np.arange(texts + 1))
    for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
        held[a:b] = np.isin(low[a:b], _numbers(keys, first + i).view(np.uint64))
    return held


def _numbers(column: pa.Array, i: int) -> np.ndarray:
    values = column[i].values
    return np.empty(0, np.int64) if values is None else values.to_numpy(zero_copy_only=False).astype(np.int64)


def _covered(size: int, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """Which of ``size`` places lie in one of the ranges."""
    depth = np.zeros(size + 1, np.int64)
    np.add.at(depth, starts, 1)
    np.add.at(depth, stops, -1)
    return np.cumsum(depth)[:size] > 0


def _undecided(window: int):
    """Representatives that a smaller document holds, too, of windows without a proof."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.empty(0, np.int64)]
            for i in range(batch.num_rows):
                begin, end, key, proved_from, proved_to = (
                    _numbers(batch.column(c), i) for c in ("from", "to", "key", "a", "b")
                )
                free = ~_covered(int(end.max(initial=0)), proved_from,
                                 np.minimum(proved_to - (window - 1), end.max(initial=0)))
                so_far = np.concatenate(([0], np.cumsum(free)))
                open_ = key[so_far[end] > so_far[begin]]
                found.append(open_[np.isin(open_, _numbers(batch.column("later"), i))])
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(np.concatenate(found)))], ["key"])

    return read


def _unproved(window: int):
    """Windows with a representative that is asked for and without a proof: (doc, id, at, x, y)."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, data, ends in text_chunks(batch.column("text")):
                chunk = Chunk(data, ends)
                at, low = chunk.representatives(window)
                owner = chunk.text[at]
                held = _asked(low, owner, batch.column("keys"), first, len(ends))
                edges = np.searchsorted(owner, np.arange(len(ends) + 1))
                for i, (a, b) in enumerate(zip(edges[:-1], edges[1:])):
                    proved_from, proved_to = (_numbers(batch.column(c), first + i) for c in ("a", "b"))
                    # A window is proved if it lies inside one proof.
                    held[a:b] &= ~_covered(b - a, proved_from, proved_to - (window - 1))
                at, owner = at[held], owner[held]
                row = pa.array(first + owner)
                yield pa.RecordBatch.from_arrays([
                    batch.column("doc").take(row), batch.column("id").take(row),
                    pa.array((at - chunk.first[owner]).astype(np.int32)),
                    *(pa.array(chunk.names(at, window, k).view(np.int64)) for k in (0, 1)),
                ], ["doc", "id", "at", "x", "y"])

    return read


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with ranges of words to what is left of them."""
    span = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    for batch in batches:
        removed, spans, kept = [], [], []
        for i, text in enumerate(batch.column("text")):
            words = text.as_py().encode().split()
            gone = _covered(len(words), _numbers(batch.column("a"), i), _numbers(batch.column("b"), i))
            edges = np.flatnonzero(np.diff(np.concatenate(([False], gone, [False]))))
            spans.append([{"a": int(a), "b": int(b)} for a, b in zip(edges[::2], edges[1::2])])
            removed.append(int(gone.sum()))
            kept.append(b" ".join(words[a] for a in np.flatnonzero(~gone).tolist()))
        yield pa.RecordBatch.from_arrays([
            batch.column("doc"), pa.array(removed, pa.int64()), pa.array(spans, span),
            pa.array([k.decode() for k in kept], pa.string()),
            pa.array([hashlib.sha256(k).digest() for k in kept], pa.binary()), batch.column("reach"),
        ], ["doc", "n_removed", "spans", "kept", "kept_sha", "reach"])


def _earlier(first: Column, own: Column) -> Column:
    """A null id is larger than any other, and no id is smaller than itself."""
    return first.isNotNull() & (own.isNull() | (first < own))


def _repeated(rows: DataFrame, by: list[str]) -> DataFrame:
    """Groups that hold two different ids, with the smallest one; combined before the shuffle."""
    return rows.groupBy(*by).agg(
        F.min("id").alias("first"), F.max("id").alias("last"), F.max(F.col("id").isNull()).alias("none"),
    ).where("last > first or (none and first is not null)").select(*by, "first")


def repeated_passages(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """One row per document: id, n_words, n_removed, spans, reach, kept, kept_sha256.

    Words are runs of anything but ASCII white space, unchanged. ``spans`` are the maximal
    ranges of words (from, to) covered by windows of ``window`` words whose words also start
    in a document with a smaller id. Windows are judged on the input, not on what is left.
    ``reach`` is the longest of the lengths ``window``, twice, four times ... at which one of
    the document's doubled windows was met again in a smaller document, 0 if nothing goes.
    ``kept`` is the words that are left joined by one space, null where nothing was removed;
    ``kept_sha256`` is its SHA-256, or that of all words so joined.

    * A null text has no words; nor has an empty one. A text with fewer words than a window
      loses nothing.
    * Rows with the same id are one document in the order: they take nothing from each
      other, also where they are equal; a passage repeated within one document stays.
    * A null id comes after every other; null ids take nothing from each other.
    * No rows in, no rows out. Other columns of the input are ignored. Texts of any length
      are read whole.
    """
    if window < 1:
        raise ValueError("a window has one word at least")
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    # A document is known by a hash of its id and text: the texts are read again, not stored.
    name = F.col("id").cast("string")
    doc = F.unhex(F.md5(F.concat(
        F.when(name.isNull(), "n").otherwise(F.concat(F.lit("v"), F.length(name), F.lit(":"), name)).cast("binary"),
        F.col("text").cast("binary"),
    )))
    texts = texts.select(doc.alias("doc"), "id", "text")
    base = staged(
        texts.withColumn("row", F.monotonically_increasing_id())
        .mapInArrow(_base(window), f"row long, doc binary, id {kind}, n_words long, sha binary, keys array<long>"),
        "doubling-base",
    )
    halves = base.select("row", "id", F.explode("keys").alias("key"))
    # Groups that are read back are shuffled on either side of the join that follows, and only
    # such a join is split where one group has very many rows.
    again = staged(_few(_repeated(halves, ["key"])), "doubling-again")
    met = halves.join(again.hint("merge"), "key").groupBy("row").agg(
        F.collect_list("key").alias("keys"),
        F.collect_list(F.when(_earlier(F.col("first"), F.col("id")), F.col("key"))).alias("later"),
    )
    hits = staged(met.join(base.select("row", "doc").hint("merge"), "row").drop("row"), "doubling-halves")
    held = staged(
        # A text of fewer bytes has no window; equal documents are looked at once.
        texts.where(F.octet_length("text") >= 2 * window - 1)
        .join(hits.select("doc", "keys").hint("merge"), "doc").dropDuplicates(["doc"])
        .mapInArrow(_candidates(window), f"doc binary, id {kind}, text string, from array<int>, to array<int>, "
                    "key array<long>, at array<int>, xs array<array<long>>, ys array<array<long>>"),
        "doubling-candidates",
    )
    proofs = _doubled(held, window)
    proved = staged(
        _few(proofs.groupBy("doc").agg(F.collect_list("at").alias("a"), F.collect_list("stop").alias("b"))),
        "doubling-proofs",
    )
    later = hits.where(F.size("later") > 0).select("doc", "later").dropDuplicates(["doc"])
    wanted = (
        held.select("doc", "from", "to", "key").join(later.hint("merge"), "doc").join(proved.hint("merge"), "doc", "left")
        .mapInArrow(_undecided(window), "key long").distinct()
    )
    asked = held.select("doc", F.explode(F.array_distinct("key")).alias("key")).join(
        wanted.hint("merge"), "key", "left_semi"
    ).groupBy("doc").agg(F.collect_list("key").alias("keys"))
    rest = staged(
        held.select("doc", "id", "text").join(asked.hint("merge"), "doc").join(proved.hint("merge"), "doc", "left")
        .mapInArrow(_unproved(window), f"doc binary, id {kind}, at int, x long, y long"),
        "doubling-rest",
    )
    twice = staged(_few(_repeated(rest, ["x", "y"])), "doubling-twice")
    single = rest.join(twice.hint("merge"), ["x", "y"]).where(
        _earlier(F.col("first"), F.col("id"))
    ).select("doc", "at", (F.col("at") + window).alias("stop"))
    ranges = proofs.unionByName(single).groupBy("doc").agg(
        F.collect_list("at").alias("a"), F.collect_list("stop").alias("b"),
        F.max(F.col("stop") - F.col("at")).cast("long").alias("reach"),
    )
    gone = held.select("doc", "text").join(ranges.hint("merge"), "doc").mapInArrow(
        _removed, "doc binary, n_removed long, spans array<struct<a:long,b:long>>, kept string, "
        "kept_sha binary, reach long"
    )
    return base.select("doc", "id", "n_words", "sha").join(gone.hint("merge"), "doc", "left").select(
        F.col("id").alias(id_col), "n_words", F.coalesce("n_removed", F.lit(0).cast("long")).alias("n_removed"),
        F.coalesce("spans", F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")).alias("spans"),
        F.coalesce("reach", F.lit(0).cast("long")).alias("reach"), "kept",
        F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"),
    )


def _few(df: DataFrame) -> DataFrame:
    """Fewer partitions, and files, for a frame that is far smaller than the texts."""
    wide = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.coalesce(max(1, wide // 8))


def _doubled(held: DataFrame, window: int) -> DataFrame:
    """Ranges (doc, at, stop) whose words start in a smaller document, at doubled lengths."""
    alive = held.select("doc", "id", F.inline(F.arrays_zip("at", "xs", "ys")))
    found = []
    for level in count():
        here = alive.where(F.size("xs") > level).select(
            "doc", "id", "at", "xs", "ys", F.col("xs")[level].alias("x"), F.col("ys")[level].alias("y")
        )
        # Only what repeats at one length is looked at again at twice that length.
        alive = staged(
            _few(here.join(_repeated(here.select("id", "x", "y"), ["x", "y"]).hint("merge"), ["x", "y"]).drop("x", "y")),
            f"doubling-{window << level}",
        )
        found.append(alive.where(_earlier(F.col("first"), F.col("id"))).select(
            "doc", "at", (F.col("at") + (window << level)).alias("stop")
        ))
        if alive.isEmpty():
            return reduce(DataFrame.unionByName, found)
        alive = alive.drop("first")

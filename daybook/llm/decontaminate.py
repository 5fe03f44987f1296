"""Benchmark decontamination by a prefix-filtered join of word shingles.

A window of an item can only occur in a text that holds every shingle of the window, so
it is enough to look for one: the one that is rarest in the corpus. A text that has it is
a candidate if the whole window fits into the text around that place, and a candidate
counts after all its words have been compared.

The item windows are the query set. They are cut into blocks of at most ``BLOCK_WINDOWS``
(window, item) pairs; each block is sent to all tasks and meets every text.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import staged, text_chunks, without
from daybook.llm.words import Words, words_of

WINDOW = 10
SHINGLE = 5

#: Pairs of a window and an item in one block; bounds what is broadcast at once.
BLOCK_WINDOWS = 250_000


def _windows(window: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items, found = batch.column("item").to_pylist(), {"item": [], "window": []}
            for first, data, ends in text_chunks(batch.column("text")):
                words = words_of(data, ends)
                bounds = np.searchsorted(words.text, np.arange(len(ends) + 1))
                for row, (a, b) in enumerate(zip(bounds, bounds[1:])):
                    line = [words.word(i).decode() for i in range(a, b)]
                    width = min(window, len(line))
                    for at in range(len(line) - width + 1 if line else 0):
                        found["item"].append(items[first + row])
                        found["window"].append(" ".join(line[at:at + width]))
            yield pa.RecordBatch.from_pydict(found, pa.schema([("item", pa.string()), ("window", pa.string())]))

    return cut


def item_windows(items: DataFrame, window: int = WINDOW, id_col: str = "item_id",
                 text_col: str = "text") -> DataFrame:
    """Distinct windows of the items: window (words joined by a space) and its items."""
    return (
        items.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                     F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_windows(window), "item string, window string")
        .groupBy("window").agg(F.collect_set("item").alias("items"))
    )


class Block:
    """The windows of one block, and their shingles by hash."""

    def __init__(self, windows: list[str], items: list[list[str]], shingle: int):
        self.items = items
        self.words = [w.encode().split(b" ") for w in windows]
        joined = [w.encode() for w in windows]
        data = np.frombuffer(b"".join(joined), np.uint8)
        ends = np.cumsum([len(w) for w in joined], dtype=np.int64)
        self.hashes = words_of(data, ends)
        self.first = np.searchsorted(self.hashes.text, np.arange(len(windows) + 1))
        lengths = np.diff(self.first)
        #: By width: shingle hash, its window, its offset there. A window shorter than a
        #: shingle is one shingle of its own width.
        self.shingles: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        for width in sorted({min(shingle, int(n)) for n in lengths}):
            hashes, whole = self.hashes.shingles(width)
            window = self.hashes.text[:len(hashes)]
            whole &= np.minimum(lengths[window], shingle) == width
            at = np.flatnonzero(whole)
            self.shingles[width] = hashes[at], window[at], at - self.first[window[at]]

    def prefixes(self, counts: dict[int, dict[int, int]]) -> tuple:
        """By width, the rarest shingle of each window; the windows' words; their items."""
        by_width = {}
        for width, (hashes, window, offset) in self.shingles.items():
            known = counts.get(width, {})
            rarity = np.array([known.get(int(h), 0) for h in hashes], np.int64)
            order = np.lexsort((offset, hashes, rarity, window))
            first = order[np.r_[True, np.diff(window[order]) > 0]]
            # A shingle the corpus does not hold rules its window out.
            first = first[rarity[first] > 0]
            first = first[np.argsort(hashes[first], kind="stable")]
            by_width[width] = hashes[first], window[first], offset[first]
        return by_width, self.words, self.items


def occurrences(by_width: dict, windows: list[list[bytes]], words: Words,
                bounds: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(first word, end, window) of each occurrence of a window in a chunk of texts."""
    for width, (hashes, window, offset) in by_width.items():
        found, whole = words.shingles(width)
        if not len(found) or not len(hashes):
            continue
        low, high = np.searchsorted(hashes, found), np.searchsorted(hashes, found, "right")
        for at in np.flatnonzero((high > low) & whole).tolist():
            text = words.text[at]
            for k in range(low[at], high[at]):
                wanted = windows[window[k]]
                start = at - int(offset[k])
                end = start + len(wanted)
                # Positional and length bounds: the window must fit into this text.
                if start < bounds[text] or end > bounds[text + 1]:
                    continue
                if all(words.word(start + i) == w for i, w in enumerate(wanted)):
                    yield start, end, int(window[k])


def _count(broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sought = {width: np.unique(h) for width, (h, _, _) in broadcast.value.items()}
        totals = {width: np.zeros(len(h), np.int64) for width, h in sought.items()}
        for batch in batches:
            for _, data, ends in text_chunks(batch.column("text")):
                words = words_of(data, ends)
                for width, hashes in sought.items():
                    found, whole = words.shingles(width)
                    at = np.minimum(np.searchsorted(hashes, found), len(hashes) - 1)
                    hit = at[(hashes[at] == found) & whole]
                    totals[width] += np.bincount(hit, minlength=len(hashes))
        for width, hashes in sought.items():
            seen = totals[width] > 0
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(int(seen.sum()), width, np.int32)),
                 pa.array(hashes[seen].view(np.int64)), pa.array(totals[width][seen])],
                ["width", "hash", "n"],
            )

    return run


def _hits(broadcast):
    schema = pa.schema([
        ("id", pa.string()), ("content", pa.binary()), ("starts", pa.list_(pa.int64())),
        ("ends", pa.list_(pa.int64())), ("items", pa.list_(pa.string())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        by_width, windows, names = broadcast.value
        for batch in batches:
            rows = {name: [] for name in schema.names}
            ids = batch.column("id")
            for first, data, ends in text_chunks(batch.column("text")):
                words = words_of(data, ends)
                bounds = np.searchsorted(words.text, np.arange(len(ends) + 1))
                edge = np.zeros(len(words.hashes) + 1, np.int64)
                items: dict[int, set[str]] = {}
                for start, end, window in occurrences(by_width, windows, words, bounds):
                    edge[start] += 1
                    edge[end] -= 1
                    items.setdefault(int(words.text[start]), set()).update(names[window])
                hit = np.cumsum(edge) > 0
                for text, found in items.items():
                    a, b = bounds[text], bounds[text + 1]
                    turns = np.diff(np.concatenate(([False], hit[a:b], [False])).astype(np.int8))
                    rows["id"].append(ids[first + text].as_py())
                    rows["content"].append(_content(data, ends, text))
                    rows["starts"].append(np.flatnonzero(turns == 1))
                    rows["ends"].append(np.flatnonzero(turns == -1))
                    rows["items"].append(sorted(found))
            yield pa.RecordBatch.from_pydict(rows, schema)

    return run


def _content(data: np.ndarray, ends: np.ndarray, text: int) -> bytes:
    return hashlib.md5(data[ends[text - 1] if text else 0:ends[text]]).digest()


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        counts, contents = [], []
        for _, data, ends in text_chunks(batch.column("text")):
            words = words_of(data, ends)
            counts += np.bincount(words.text, minlength=len(ends)).tolist()
            contents += [_content(data, ends, t) for t in range(len(ends))]
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(contents, pa.binary()), pa.array(counts, pa.int64())],
            ["id", "content", "n_words"],
        )


def contamination(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE,
                  id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", block_windows: int = BLOCK_WINDOWS) -> DataFrame:
    """One row per document: id, n_words, n_hit, spans, items.

    ``spans`` are the maximal runs of hit words (first, end), ``items`` the sorted ids, as
    strings, of the items with a window that occurs.

    * A null or empty text has no words and no hit; an item without words has no window.
      An item of fewer words than ``window`` is one window.
    * A null id is an id like any other, also of an item (then the empty string). Repeated
      rows, and rows with the same id and other text, each get a row of their own.
    * Without documents there are no rows, without items no hits. Other columns are ignored.
    * Texts of any length are read whole.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).cast("string").alias("id"),
                        F.col(text_col).cast("string").alias("text"))
    base = staged(texts.mapInArrow(_base, "id string, content binary, n_words long"), "decon-base")

    windows = staged(item_windows(items, window, item_col, item_text_col), "decon-windows")
    pairs = windows.agg(F.sum(F.size("items"))).first()[0] or 0
    blocks = math.ceil(pairs / block_windows)
    number = F.pmod(F.xxhash64("window"), F.lit(max(blocks, 1)))
    hits = None
    for i in range(blocks):
        table = windows.where(number == i).toArrow()
        if not table.num_rows:
            continue
        block = Block(table["window"].to_pylist(), table["items"].to_pylist(), shingle)
        sought = spark.sparkContext.broadcast(block.shingles)
        rarity = (
            texts.select("text").mapInArrow(_count(sought), "width int, hash long, n long")
            .groupBy("width", "hash").agg(F.sum("n").alias("n")).toArrow()
        )
        counts: dict[int, dict[int, int]] = {}
        for width, h, n in zip(*(rarity[c].to_pylist() for c in ("width", "hash", "n"))):
            counts.setdefault(width, {})[h % (1 << 64)] = n
        prefixes = spark.sparkContext.broadcast(block.prefixes(counts))
        found = staged(
            texts.mapInArrow(_hits(prefixes), "id string, content binary, starts array<long>, "
                             "ends array<long>, items array<string>").distinct(),
            "decon-hits",
        )
        hits = found if hits is None else hits.union(found)
    if hits is None:
        empty = "id string, content binary, starts array<long>, ends array<long>, items array<string>"
        hits = spark.createDataFrame([], empty)
    key = [F.coalesce("id", F.lit("")).alias("_id"), F.col("id").isNull().alias("_none"), "content"]
    per_doc = hits.select(*key, "starts", "ends", "items").groupBy("_id", "_none", "content").agg(
        F.flatten(F.collect_list(F.arrays_zip("starts", "ends"))).alias("spans"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    runs = F.expr("array_distinct(flatten(transform(spans, s -> sequence(s.starts, s.ends - 1))))")
    return (
        base.select("id", "n_words", *key).join(per_doc, ["_id", "_none", "content"], "left")
        .select(
            F.col("id").cast(kind).alias(id_col), "n_words",
            F.coalesce(F.size(runs), F.lit(0)).cast("long").alias("n_hit"),
            F.coalesce("spans", F.expr("cast(array() as array<struct<starts: bigint, ends: bigint>>)")).alias("spans"),
            F.coalesce("items", F.expr("cast(array() as array<string>)")).alias("items"),
        )
    )


def keep_clean(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """The documents without any hit, with all their columns.

    A document goes if a row with its id is hit; rows with a null id are judged together, and
    repeated rows alike. Without items, or without documents, nothing goes. Names of other
    columns do not matter.
    """
    found = contamination(docs, items, id_col=id_col, **options)
    return without(docs, found.where("n_hit > 0").select(F.col(id_col).alias("id")), id=F.col(id_col))

"""Removal of repeated passages with suffix arrays and longest-previous-factor arrays.

A passage is repeated if a string of ``length`` bytes occurs twice. To find all of them
without one suffix array over the corpus, each window of that length is dealt by an
anchor, the smallest hash of the shorter strings in it: equal windows have equal anchors.
Neighbouring windows with the same anchor form a piece. Only anchors that occur again
can hold a repeat. Pieces with the same bytes are counted and kept once; pieces of an
anchor with different bytes go into one suffix array, whose longest-previous-factor array
tells which windows occur earlier (and, read backwards, later).

An anchor with very many different pieces is dealt anew by anchors of longer strings, up
to whole windows, so no task holds all pieces around a passage that everyone shares. Where
the anchor is a whole window, all windows of a key are one string: their number decides.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.common import slices_for, staged, text_chunks, with_group_totals
from daybook.llm.suffix_array import repeated
from daybook.llm.words import BASE, INVERSE, mixed, powers

LENGTH = 400
ANCHOR = 160

#: Windows of one piece at most; a longer run with one anchor is cut.
PIECE_WINDOWS = 2048
#: Different pieces of one anchor that go into one suffix array.
GROUP_PIECES = 96
#: Windows that a task puts into one suffix array, of one anchor or several.
ARRAY_WINDOWS = 40_000
#: Bytes of one text that are looked at together; a longer one is cut with an overlap.
TEXT_BYTES = 1 << 22


def anchor_runs(data: np.ndarray, ends: np.ndarray, length: int, anchor: int):
    """Pieces of the texts that end at ``ends``, as arrays.

    Of each piece: its text, first window, number of windows, key, and whether its anchor
    may occur in it again; without that, no window of the piece can repeat inside it.
    """
    if len(data) < length:
        return [np.empty(0, np.int64)] * 3 + [np.empty(0, np.uint64), np.empty(0, bool)]
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(BASE, len(data)), out=sums[1:])
    hashes = mixed((sums[anchor:] - sums[:-anchor]) * powers(INVERSE, len(data) + 1)[:len(data) - anchor + 1])
    low, width, size = hashes, length - anchor + 1, 1
    while size * 2 <= width:
        low, size = np.minimum(low[:-size], low[size:]), size * 2
    if size < width:
        low = np.minimum(low[:size - width], low[width - size:])
    begins = np.concatenate(([0], ends[:-1]))
    text = np.searchsorted(ends, np.arange(len(low)), "right")
    inside = ends[np.minimum(text, len(ends) - 1)] - np.arange(len(low)) >= length
    change = np.ones(len(low), bool)
    change[1:] = (low[1:] != low[:-1]) | (text[1:] != text[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(change)
    count = np.diff(np.append(first, len(low)))
    first, count = first[inside[first]], count[inside[first]]
    # Cut long runs.
    parts = -(-count // PIECE_WINDOWS)
    which = np.repeat(np.arange(len(first)), parts)
    nth = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    first = first[which] + nth * PIECE_WINDOWS
    count = np.minimum(count[which] - nth * PIECE_WINDOWS, PIECE_WINDOWS)
    key = low[first]
    again = _occurs_again(hashes, key, first, first + count + width - 1, width)
    return text[first], first - begins[text[first]], count, key, again


def _occurs_again(hashes: np.ndarray, key: np.ndarray, a: np.ndarray, b: np.ndarray, width: int) -> np.ndarray:
    """Whether each key occurs twice among the hashes from a to b.

    Smallest hashes of so many are small: only the small ones are put in order. A key
    that is not small is taken to occur again.
    """
    bound = np.uint64(min(1.0, 16 / width) * (2**64 - 2**12))
    places = np.flatnonzero(hashes <= bound)
    values, rank = np.unique(hashes[places], return_inverse=True)
    order = np.sort((rank.astype(np.int64) << 40) + places)
    if not len(order):
        return np.ones(len(key), bool)
    at = np.minimum(np.searchsorted(values, key), len(values) - 1) << 40
    times = np.searchsorted(order, at + b) - np.searchsorted(order, at + a)
    return (key > bound) | (times > 1)


def _doc_key(number: str | None, text: memoryview | bytes) -> bytes:
    return hashlib.md5((b"n" if number is None else b"v" + number.encode()) + b"\0" + bytes(text)).digest()


def _texts(batch: pa.RecordBatch) -> Iterator[tuple[str | None, np.ndarray]]:
    ids = batch.column("id").to_pylist()
    for first, data, ends in text_chunks(batch.column("text")):
        at = 0
        for row, end in enumerate(ends.tolist()):
            yield ids[first + row], data[at:end]
            at = end


def _contents(data: np.ndarray, where: np.ndarray, count: np.ndarray, length: int) -> np.ndarray:
    whole = data.tobytes()
    return np.array([xxhash.xxh3_64_intdigest(whole[a:a + n + length - 1])
                     for a, n in zip(where.tolist(), count.tolist())], np.uint64)


def _cut(length: int, anchor: int):
    """Documents to pieces: doc, at, n, key, content, again."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("id").to_pylist()
            for first, data, ends in text_chunks(batch.column("text")):
                begins = np.concatenate(([0], ends[:-1]))
                docs = [_doc_key(ids[first + i], data[a:b]) for i, (a, b) in enumerate(zip(begins, ends))]
                found = []
                if len(ends) == 1 and ends[0] > TEXT_BYTES:
                    for a in range(0, int(ends[0]) - length + 1, TEXT_BYTES):
                        part = data[a:a + TEXT_BYTES + length - 1]
                        text, at, *rest = anchor_runs(part, np.array([len(part)]), length, anchor)
                        found.append((text, at + a, *rest))
                else:
                    found.append(anchor_runs(data, ends, length, anchor))
                text, at, n, key, again = (np.concatenate(c) for c in zip(*found))
                content = _contents(data, begins[text] + at, n, length)
                yield pa.RecordBatch.from_arrays([
                    pa.array([docs[t] for t in text.tolist()], pa.binary()), pa.array(at.astype(np.int64)),
                    pa.array(n.astype(np.int32)), pa.array(key.view(np.int64)), pa.array(content.view(np.int64)),
                    pa.array(again),
                ], ["doc", "at", "n", "key", "content", "again"])

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pack = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        docs, texts = [], []
        for number, text in _texts(batch):
            docs.append(_doc_key(number, text))
            texts.append(pack.compress(text.tobytes()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(docs, pa.binary()), pa.array(texts, pa.binary())], ["doc", "packed"]
        )


def _base(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        docs, sizes, shas = [], [], []
        for number, text in _texts(batch):
            docs.append(_doc_key(number, text))
            sizes.append(len(text))
            shas.append(hashlib.sha256(text).digest())
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(docs, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(shas, pa.binary())], ["id", "doc", "n_bytes", "sha"],
        )


def _slices(length: int):
    """Documents with the pieces wanted of them to the pieces with their bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            wanted = batch.column("wanted")
            size = wanted.value_lengths().to_numpy(zero_copy_only=False)
            flat = wanted.flatten()
            at, n = (flat.field(f).to_numpy(zero_copy_only=False).tolist() for f in ("at", "n"))
            data, k = [], 0
            for packed, count in zip(batch.column("packed"), size.tolist()):
                text = unpack.decompress(packed.as_py())
                for _ in range(count):
                    data.append(text[at[k]:at[k] + n[k] + length - 1])
                    k += 1
            yield pa.RecordBatch.from_arrays(
                [flat.field("key"), flat.field("content"), pa.array(data, pa.binary())],
                ["key", "content", "data"],
            )

    return run


def _finer(length: int, anchor: int):
    """Pieces to the smaller pieces that longer anchors cut them into."""
    kinds = {"data": pa.binary(), "n": pa.int32(), "again": pa.bool_(), "at": pa.list_(pa.int64())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data = batch.column("data").to_pylist()
            columns = {c: batch.column(c).to_pylist() for c in ("key", "content")}
            rows = {c: [] for c in ("owner_key", "owner_content", "at", "n", "key", "content", "again", "data")}
            for i, text in enumerate(data):
                array = np.frombuffer(text, np.uint8)
                _, at, n, key, again = anchor_runs(array, np.array([len(array)]), length, anchor)
                content = _contents(array, at, n, length).view(np.int64).tolist()
                places: dict[tuple[int, int], list[int]] = {}
                for j, own in enumerate(zip(key.view(np.int64).tolist(), content)):
                    places.setdefault(own, []).append(j)
                # A text that goes round and round has the same piece many times: one row.
                for (own_key, own_content), found in places.items():
                    first, count = int(at[found[0]]), int(n[found[0]])
                    rows["owner_key"].append(columns["key"][i])
                    rows["owner_content"].append(columns["content"][i])
                    rows["at"].append(at[found].tolist())
                    rows["n"].append(count)
                    rows["key"].append(own_key)
                    rows["content"].append(own_content)
                    rows["again"].append(bool(again[found[0]]))
                    rows["data"].append(text[first:first + count + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, kinds.get(c, pa.int64())) for c, v in rows.items()], list(rows),
            )

    return run


def _search(length: int):
    """Pieces in order of key and first place to the runs of their windows that occur again."""
    runs = pa.list_(pa.struct([("a", pa.int32()), ("b", pa.int32())]))
    schema = pa.schema([("key", pa.int64()), ("content", pa.int64()), ("earlier", runs), ("later", runs)])

    def runs_of(flags: np.ndarray) -> list[dict]:
        turn = np.diff(np.concatenate(([False], flags, [False])).astype(np.int8))
        return [{"a": a, "b": b} for a, b in
                zip(np.flatnonzero(turn == 1).tolist(), np.flatnonzero(turn == -1).tolist())]

    def searched(pieces: list[tuple[int, int, int, bytes]]) -> pa.RecordBatch:
        sizes = [len(p[3]) for p in pieces]
        counts = [p[2] for p in pieces]
        begins = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        starts = np.concatenate([np.arange(b, b + n) for b, n in zip(begins, counts)])
        data = np.frombuffer(b"".join(p[3] for p in pieces), np.uint8)
        earlier, later = repeated(data, starts, length)
        bounds = np.concatenate(([0], np.cumsum(counts)))
        rows = [
            {"key": key, "content": content, "earlier": runs_of(earlier[a:b]), "later": runs_of(later[a:b])}
            for (key, content, _, _), a, b in zip(pieces, bounds, bounds[1:])
        ]
        return pa.RecordBatch.from_pylist(rows, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        windows = 0
        for batch in batches:
            columns = [batch.column(c).to_pylist() for c in ("key", "content", "n", "data")]
            for piece in zip(*columns):
                if windows >= ARRAY_WINDOWS and piece[0] != held[-1][0]:
                    yield searched(held)
                    held, windows = [], 0
                held.append(piece)
                windows += piece[2]
        if held:
            yield searched(held)

    return run


def _full() -> Column:
    return F.array(F.struct(F.lit(0).alias("a"), F.col("n").alias("b")))


def _repeats(pieces: DataFrame, fetch, length: int, anchor: int, keep_first: bool) -> DataFrame:
    """The windows that are to go: owner, at, n, runs.

    ``pieces`` has owner, at, n, key, content, again, times (how often the owner has the
    piece) and ord (its first place). ``runs`` holds for that first place and may be null;
    any further place of the owner goes whole.
    ``fetch`` gives the bytes of distinct pieces (key, content, n, first).
    """
    rows = pieces.count()
    slices = slices_for(rows)
    dealt = pieces.withColumn("_slice", F.pmod(F.xxhash64("ord"), F.lit(slices)).cast("int"))
    parts = dealt.groupBy("key", "content", "_slice").agg(
        F.sum("times").alias("c"), F.min("ord").alias("first"), F.min("n").alias("n"),
        F.max("again").alias("again"),
    )
    distinct = parts.groupBy("key", "content").agg(
        F.sum("c").alias("c"), F.min("first").alias("first"), F.min("n").alias("n"),
        F.max("again").alias("again"), F.collect_list("_slice").alias("slices"),
    )
    distinct = staged(
        with_group_totals(distinct, ["key"], {"d": ("sum", F.lit(1).cast("long"))}, ["content"], slices),
        "suffix-distinct",
    )
    # A lone piece can hold a repeat inside itself only if its anchor occurs in it again.
    mixed_up = distinct.where("d > 1 or again")
    data = staged(fetch(mixed_up.select("key", "content", "n", "c", "first", "d")), "suffix-data")

    search = (
        data.where(F.col("d") <= GROUP_PIECES).select("key", "content", "n", "first", "data")
        .repartition("key").sortWithinPartitions("key", "first")
        .mapInArrow(_search(length), "key long, content long, earlier array<struct<a:int,b:int>>, "
                    "later array<struct<a:int,b:int>>")
    )
    found = search.select(
        "key", "content", (F.col("earlier") if keep_first else F.concat("earlier", "later")).alias("runs")
    ).where(F.size("runs") > 0)
    many = data.where(F.col("d") > GROUP_PIECES)
    if many.limit(1).count():
        found = found.union(_split(many, length, anchor, keep_first) if anchor < length
                            else _counted(many, length, keep_first))
    found = staged(found, "suffix-found")

    again = distinct.join(found.hint("merge"), ["key", "content"], "left").where("c > 1 or runs is not null")
    back = again.select("key", "content", "c", "first", "runs", F.explode("slices").alias("_slice"))
    met = dealt.join(back.hint("merge"), ["key", "content", "_slice"])
    if keep_first:
        runs = F.when(F.col("ord") == F.col("first"), F.col("runs")).otherwise(_full())
    else:
        runs = F.when(F.col("c") > 1, _full()).otherwise(F.col("runs"))
    return met.select("owner", "at", "n", "times", runs.alias("runs")).where("runs is not null or times > 1")


def _counted(many: DataFrame, length: int, keep_first: bool) -> DataFrame:
    """Runs of windows of pieces whose anchor is a whole window, by how often that string occurs."""
    # The string itself stands beside its hash; of one byte, so at most PIECE_WINDOWS different pieces.
    pieces = many.select("key", "content", "n", "c", "first", F.md5(F.substring("data", 1, length)).alias("same"))
    strings = pieces.groupBy("key", "same").agg(
        F.sum(F.col("n") * F.col("c")).alias("windows"), F.min("first").alias("earliest")
    )
    start = F.lit(0)
    if keep_first:
        start = F.when(F.col("first") == F.col("earliest"), 1).otherwise(0)
    return pieces.join(strings.hint("merge"), ["key", "same"]).where("windows > 1").select(
        "key", "content", F.array(F.struct(start.cast("int").alias("a"), F.col("n").alias("b"))).alias("runs")
    ).where("runs[0].a < runs[0].b")


def _split(many: DataFrame, length: int, anchor: int, keep_first: bool) -> DataFrame:
    """Runs of windows of pieces whose anchor has very many: found with longer anchors."""
    finer = length - (length - anchor) // 4
    smaller = staged(
        many.select("key", "content", "data").mapInArrow(
            _finer(length, finer), "owner_key long, owner_content long, at array<long>, n int, key long, "
            "content long, again boolean, data binary"
        ).join(
            many.select(
                F.col("key").alias("owner_key"), F.col("content").alias("owner_content"), "first"
            ).hint("merge"), ["owner_key", "owner_content"],
        ).select(
            F.struct(F.col("owner_key").alias("key"), F.col("owner_content").alias("content")).alias("owner"),
            "at", "n", "key", "content", "again", "data", F.size("at").cast("long").alias("times"),
            F.col("first").withField("place", F.col("first.place") + F.col("at")[0]).alias("ord"),
        ),
        "suffix-finer",
    )
    # Anchors that occur once hold no repeat.
    kept = staged(
        with_group_totals(
            smaller, ["key"], {"seen": ("sum", F.col("times")), "any": ("max", F.col("again"))},
            ["ord"], slices_for(smaller.count()),
        ).where("seen > 1 or any").drop("seen", "any"),
        "suffix-kept",
    )

    def fetch(wanted: DataFrame) -> DataFrame:
        bytes_of = kept.select("key", "content", "ord", "data").withColumnRenamed("ord", "first")
        # Files of much alike pieces are small: no measure for a broadcast.
        return wanted.join(
            bytes_of.dropDuplicates(["key", "content", "first"]).hint("merge"), ["key", "content", "first"]
        )

    gone = _repeats(kept, fetch, length, finer, keep_first)
    moved = lambda runs, at: F.transform(runs, lambda r: F.struct(
        (r["a"] + at).cast("int").alias("a"), (r["b"] + at).cast("int").alias("b")
    ))
    further = F.transform(F.slice("at", 2, F.size("at")), lambda at: F.struct(
        at.cast("int").alias("a"), (at + F.col("n")).cast("int").alias("b")
    ))
    none = F.array().cast("array<struct<a:int,b:int>>")
    return gone.select(
        "owner.*", F.concat(F.coalesce(moved(F.col("runs"), F.col("at")[0]), none), further).alias("runs")
    ).groupBy("key", "content").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def repeated_spans(docs: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, keep_first: bool = True,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, n_bytes, spans, kept (bytes that are left), kept_sha256.

    Texts are looked at as UTF-8 bytes. ``spans`` are the maximal runs (from, to) of bytes
    covered by a string of ``length`` bytes that occurs elsewhere: earlier, in order of id
    and place, if ``keep_first``, so that the first copy stays; anywhere, if not.
    Occurrences are judged on the input, and a match never crosses documents.

    * A null or empty text, or one shorter than ``length``, has no span.
    * Null ids come last. Repeated rows are documents of their own; with ``keep_first``
      rows that are equal in id and text are judged alike.
    * Without documents there are no rows. Other columns are ignored. Texts of any length
      are looked at whole. ``kept`` is null where nothing was removed.
    """
    kind = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).cast("string").alias("id"),
                        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    base = staged(texts.mapInArrow(_base, "id string, doc binary, n_bytes long, sha binary"), "suffix-base")
    packed = texts.where(F.octet_length("text") >= length).mapInArrow(_packed, "doc binary, packed binary")
    cut = staged(
        texts.where(F.octet_length("text") >= length)
        .mapInArrow(_cut(length, anchor), "doc binary, at long, n int, key long, content long, again boolean"),
        "suffix-pieces",
    )
    seen = staged(
        cut.groupBy("key").agg(F.count(F.lit(1)).alias("c"), F.max("again").alias("again"))
        .where("c > 1 or again").select("key"),
        "suffix-keys",
    )
    # An order over documents is only needed to keep the first copy.
    place = F.col("id").cast(kind) if keep_first else F.lit(0)
    kept = cut.join(seen.hint("merge"), "key", "left_semi")
    if keep_first:
        kept = kept.join(base.select("doc", "id").distinct(), "doc")
    kept = staged(
        kept.select(F.col("doc").alias("owner"), "at", "n", "key", "content", "again", F.lit(1).cast("long").alias("times"), F.struct(
            place.isNull().alias("none"), place.alias("id"), F.col("doc"), F.col("at").alias("place")
        ).alias("ord")),
        "suffix-again",
    )

    def fetch(wanted: DataFrame) -> DataFrame:
        per_doc = wanted.groupBy(F.col("first.doc").alias("doc")).agg(F.collect_list(F.struct(
            F.col("first.place").alias("at"), "n", "key", "content"
        )).alias("wanted"))
        sliced = packed.join(per_doc.hint("merge"), "doc").dropDuplicates(["doc"]).mapInArrow(
            _slices(length), "key long, content long, data binary"
        )
        return wanted.join(sliced.hint("merge"), ["key", "content"])

    gone = _repeats(kept, fetch, length, anchor, keep_first)
    spans = gone.select(F.col("owner").alias("doc"), F.explode(F.transform("runs", lambda r: F.struct(
        (F.col("at") + r["a"]).alias("a"), (F.col("at") + r["b"] + (length - 1)).alias("b")
    ))).alias("span")).distinct().groupBy("doc").agg(F.array_sort(F.collect_list("span")).alias("cover"))
    left = staged(
        packed.join(spans.hint("merge"), "doc").dropDuplicates(["doc"]).select("doc", "packed", "cover").mapInArrow(
            _removed, "doc binary, spans array<struct<a:long,b:long>>, kept binary, sha binary"
        ).withColumnRenamed("sha", "kept_sha"),
        "suffix-left",
    )
    return base.join(left, "doc", "left").select(
        F.col("id").cast(kind).alias(id_col), "n_bytes",
        F.coalesce("spans", F.expr("cast(array() as array<struct<a:bigint,b:bigint>>)")).alias("spans"),
        "kept", F.lower(F.hex(F.coalesce("kept_sha", "sha"))).alias("kept_sha256"),
    )


def _removed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents with sorted, overlapping spans to maximal spans and what is left."""
    unpack = zstandard.ZstdDecompressor()
    spans_type = pa.list_(pa.struct([("a", pa.int64()), ("b", pa.int64())]))
    for batch in batches:
        spans, kept = [], []
        for packed, cover in zip(batch.column("packed"), batch.column("cover").to_pylist()):
            text = unpack.decompress(packed.as_py())
            merged: list[list[int]] = []
            for span in cover:
                if merged and span["a"] <= merged[-1][1]:
                    merged[-1][1] = max(merged[-1][1], span["b"])
                else:
                    merged.append([span["a"], span["b"]])
            edges = [0, *(x for m in merged for x in m), len(text)]
            kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            spans.append([{"a": a, "b": b} for a, b in merged])
        yield pa.RecordBatch.from_arrays([
            batch.column("doc"), pa.array(spans, spans_type), pa.array(kept, pa.binary()),
            pa.array([hashlib.sha256(k).digest() for k in kept], pa.binary()),
        ], ["doc", "spans", "kept", "sha"])

"""SimHash near-duplicate detection with BK-trees over shards of the fingerprints.

Equal fingerprints are grouped first. By the pigeonhole principle two fingerprints that
differ in at most r bits agree in one of r + 1 blocks of their bits, so each distinct
fingerprint is dealt to one shard per block, and a shard is searched with a BK-tree. A
shard with very many fingerprints is dealt again by blocks of its other bits. Shards
travel by shuffle, not by broadcast: together they are as large as the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from daybook.llm.bktree import spanning_links
from daybook.llm.common import slices_for, staged, with_group_totals, without
from daybook.llm.components import components

BITS = 64
SEED = 42

#: A shard with more distinct fingerprints than this is dealt again.
SHARD_ROWS = 2048


def fingerprint(text: bytes, shingle: int) -> int:
    """The SimHash of a text's word shingles; zero for a text without words."""
    words = text.lower().split()  # bytes: lowers A-Z and splits at ASCII white space only
    if not words:
        return 0
    width = min(shingle, len(words))
    line = b" ".join(words)
    ends = list(accumulate(map(len, words), lambda a, b: a + b + 1))
    starts = [0, *(e + 1 for e in ends[:-1])]
    hashes = np.array(
        [xxhash.xxh64_intdigest(line[a:b], SEED) for a, b in zip(starts, ends[width - 1:])], "<u8"
    )
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    over_half = bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)
    return int(np.packbits(over_half, bitorder="little").view("<u8")[0])


def _fingerprints(shingle: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").fill_null("").cast(pa.large_binary())
            values = np.array([fingerprint(t.as_py(), shingle) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(values.view(np.int64))], ["id", "fp"]
            )

    return add


def _block(value: Column, low: int, width: int) -> Column:
    """Bits ``low`` to ``low + width`` of a 64-bit value."""
    return F.shiftrightunsigned(F.shiftleft(value, BITS - low - width), BITS - width)


def _blocks(total: int, radius: int) -> list[tuple[int, int]]:
    """Cut ``total`` bits into ``radius + 1`` blocks of nearly equal width: (low, width)."""
    cuts = [total * i // (radius + 1) for i in range(radius + 2)]
    return [(a, b - a) for a, b in zip(cuts, cuts[1:])]


def _dealt(values: DataFrame, radius: int, shard_rows: int) -> DataFrame:
    """Each fingerprint once per shard it belongs to: (block, key, block2, key2, fp)."""
    first = _blocks(BITS, radius)
    parts = F.array(*[
        F.struct(F.lit(i).alias("block"), _block(F.col("fp"), low, width).alias("key"))
        for i, (low, width) in enumerate(first)
    ])
    dealt = values.select("fp", F.inline(parts))
    # At most (radius + 1) * 2^width shards exist, whatever the number of documents.
    full = dealt.groupBy("block", "key").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("n") > shard_rows
    ).select("block", "key", F.lit(True).alias("full"))
    marked = dealt.join(F.broadcast(full) if first[-1][1] <= 16 else full, ["block", "key"], "left")

    def again(block: int, low: int, width: int) -> Column:
        # The bits outside this block, moved together, cut into blocks in their turn.
        high = F.shiftrightunsigned("fp", low + width) if low + width < BITS else F.lit(0).cast("long")
        rest = F.shiftleft(high, low).bitwiseOR(
            _block(F.col("fp"), 0, low) if low else F.lit(0).cast("long")
        )
        return F.array(*[
            F.struct(F.lit(i).alias("block2"), _block(rest, a, w).alias("key2"))
            for i, (a, w) in enumerate(_blocks(BITS - width, radius))
        ])

    whole = F.array(F.struct(F.lit(-1).alias("block2"), F.lit(0).cast("long").alias("key2")))
    if radius == 0:
        return marked.select("block", "key", F.inline(whole), "fp")
    deal = F.when(F.col("full").isNull(), whole)
    for i, (low, width) in enumerate(first):
        deal = deal.when(F.col("block") == i, again(i, low, width))
    return marked.select("block", "key", "fp", F.inline(deal))


def _shard_links(radius: int):
    keys = ["block", "key", "block2", "key2"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: list[np.ndarray] = []  # the shard that the last batch broke off in
        shard = None
        a_parts: list[np.ndarray] = []
        b_parts: list[np.ndarray] = []

        def close() -> None:
            points = np.concatenate(kept)
            if len(points) > 1:
                a, b = spanning_links(points.view(np.uint64), radius)
                a_parts.append(a.view(np.int64))
                b_parts.append(b.view(np.int64))

        def links() -> pa.RecordBatch:
            columns = [np.concatenate(p) if p else np.empty(0, np.int64) for p in (a_parts, b_parts)]
            a_parts.clear()
            b_parts.clear()
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            columns = [batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys]
            fp = batch.column("fp").to_numpy(zero_copy_only=False)
            change = np.zeros(len(fp) - 1, bool)
            for c in columns:
                change |= c[1:] != c[:-1]
            starts = [0, *(np.flatnonzero(change) + 1).tolist()]
            for start, end in zip(starts, [*starts[1:], len(fp)]):
                here = tuple(int(c[start]) for c in columns)
                if here != shard and kept:
                    close()
                    kept.clear()
                shard = here
                kept.append(fp[start:end])
            yield links()
        if kept:
            close()
            yield links()

    return search


def near_links(values: DataFrame, radius: int, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Links (u, v) between distinct fingerprints, enough to connect all that are close."""
    keys = ["block", "key", "block2", "key2"]
    dealt = _dealt(values, radius, shard_rows)
    return (
        dealt.repartition(*keys).sortWithinPartitions(*keys, "fp")
        .mapInArrow(_shard_links(radius), "u long, v long")
    )


def near_duplicates(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
                    text_col: str = "text", shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per input row: id, fingerprint (16 hex digits), component_id.

    * ``component_id`` is the smallest id among the rows reachable by links of at most
      ``radius`` differing bits, the row itself included.
    * A null or empty text, or one without words, has fingerprint zero and is linked
      like any other. A text of fewer words than ``shingle`` is one shingle.
    * A null id gets the component of its fingerprint; it is never a component's id
      unless no other row of the component has one.
    * Repeated rows and ties appear once per row. No rows in, no rows out. Other columns
      of the input are ignored.
    """
    keys = staged(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
        .mapInArrow(_fingerprints(shingle), f"id {docs.schema[id_col].dataType.simpleString()}, fp long")
        .withColumn("row", F.monotonically_increasing_id()),
        "simhash-keys",
    )
    slices = slices_for(keys.count())
    grouped = staged(
        with_group_totals(keys, ["fp"], {"low": ("min", F.col("id"))}, ["row"], slices),
        "simhash-groups",
    )
    values = staged(grouped.groupBy("fp").agg(F.min("low").alias("low")), "simhash-values")
    roots = staged(
        components(near_links(values.select("fp"), radius, shard_rows)), "simhash-roots"
    )
    linked = with_group_totals(
        values.join(roots, values["fp"] == roots["node"]).select("fp", "low", "root"),
        ["root"], {"component": ("min", F.col("low"))}, ["fp"], slices,
    ).select(F.col("fp").alias("linked_fp"), "component")
    dealt = grouped.withColumn("_slice", F.pmod(F.xxhash64("row"), F.lit(slices)).cast("int"))
    slots = dealt.select("fp", "_slice").distinct().join(
        linked, F.col("fp") == F.col("linked_fp")
    ).drop("linked_fp")
    return dealt.join(slots, ["fp", "_slice"], "left").select(
        F.col("id").alias(id_col),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.coalesce("component", "low").alias("component_id"),
    )


def keep_one(docs: DataFrame, shingle: int = 4, radius: int = 4, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """The document with the smallest id of each group, with all its columns.

    Ids are taken to name documents, as after exact dedup: a row stays if its id is its
    component's. Rows with a null id cannot be told apart and all stay. Repeated rows are
    judged alike; without documents there are no rows. Names of other columns do not matter.
    """
    found = near_duplicates(docs, shingle, radius, id_col, text_col)
    # An id whose rows have different texts stays if one of them is the first of its group.
    gone = found.where(F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("id")).agg(
        F.max(F.col(id_col) == F.col("component_id")).alias("stays")
    ).where(~F.col("stays")).select("id")
    return without(docs, gone, id=F.col(id_col))

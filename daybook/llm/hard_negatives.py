"""Hard negatives from rotated one-bit codes.

Vectors are turned by one random rotation and stored as the signs of their components: one
bit per dimension, as a unit vector c. Beside the code stand the alignment of the vector with
it (a = <r, c> for the turned vector r) and the length of the rest, e = sqrt(|r|^2 - a^2). The
turned query q is stored as integers of a few bits; <c, q> is then a sum of popcounts over its
bit planes, up to an error that is known. As the rest of r is at a right angle to c,

    <r, q> = a <c, q> + <rest, q>,   |<rest, q>| <= e sqrt(|q|^2 - <c, q>^2)   (Cauchy-Schwarz)

gives an interval that is certain to hold the score, not only likely. The rows with the best
estimates (the middles) are scored with integers first; rows whose interval cannot reach the
last wanted one of these are left out, all others are scored, too. So the result is exact; the
codes only save work, and the more the nearer the wanted rows are. Among vectors without any
near ones the intervals are too wide to leave rows out: one bit per dimension keeps about 0.8
of a vector's length.

All rows are cut into blocks of a fixed number of rows, the anchors into packs; every pack
meets every block. A block hands on its best few rows per anchor, which are ranked once more
over all blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from daybook.llm.common import staged

#: Components are integers, the floor of so many times the value.
SCALE = 256
#: Larger integers cannot give scores of 64 bits; such rows take no part.
MAX_COMPONENT = 1 << 26
#: Rows of a block, anchors of a pack, bits of a query's components.
BLOCK_ROWS = 16_384
PACK_ANCHORS = 512
#: Packs that meet a block in one task.
PACKS_AT_ONCE = 8
QUERY_BITS = 6
SEED = 42
#: Rows that are scored first, for each wanted one.
PROBES = 4
#: Relative slack of the intervals for rounding in floating point.
SLACK = 1e-9

ROW_BITS = 33


# --- integer vectors -------------------------------------------------------------

def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keep, packed = [], []
        for i, vector in enumerate(batch.column("vector")):
            if not vector.is_valid or vector.values.null_count:
                continue
            x = vector.values.to_numpy(zero_copy_only=False).astype(np.float64)
            if not np.isfinite(x).all():
                continue
            with np.errstate(over="ignore"):
                x = np.floor(SCALE * x)
            if len(x) and np.abs(x).max() > MAX_COMPONENT:
                continue
            keep.append(i)
            packed.append(x.astype("<i4").tobytes())
        yield pa.RecordBatch.from_arrays([
            batch.column("id").take(pa.array(keep, pa.int64())),
            batch.column("label").take(pa.array(keep, pa.int64())), pa.array(packed, pa.binary()),
            batch.column("asked").take(pa.array(keep, pa.int64())),
        ], ["id", "label", "packed", "asked"])


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, label: Column, asked: Column) -> DataFrame:
    """Rows that take part, once per id: (id, label, packed, asked), packed as 32-bit integers."""
    clean = rows.select(
        F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
        F.coalesce(asked, F.lit(False)).alias("asked"), F.col(vector_col).alias("vector"),
    ).where("id is not null and label is not null").mapInArrow(
        _integers, "id long, label long, packed binary, asked boolean"
    )
    return clean.groupBy("id").agg(F.min(F.struct("label", "packed", "asked")).alias("r")).select("id", "r.*")


# --- codes -------------------------------------------------------------------------

def rotation(dims: int) -> np.ndarray:
    """A random orthogonal matrix, the same in every task."""
    q, r = np.linalg.qr(np.random.default_rng(SEED).standard_normal((dims, dims)))
    return q * np.sign(np.diag(r))


def _unpacked(packed: list[bytes], dims: int) -> np.ndarray:
    """Vectors as rows of integers; a shorter one ends in zeros."""
    out = np.zeros((len(packed), dims), np.int64)
    for row, value in zip(out, packed):
        x = np.frombuffer(value, "<i4")
        row[:len(x)] = x
    return out


def _bits(matrix: np.ndarray) -> np.ndarray:
    """Rows of booleans as 64-bit words."""
    width = -(-matrix.shape[1] // 64) * 8
    packed = np.zeros((len(matrix), width), np.uint8)
    bits = np.packbits(matrix, axis=1, bitorder="little")
    packed[:, :bits.shape[1]] = bits
    return packed.view("<u8")


def codes(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code words, alignment with the code's unit vector, and length of the rest."""
    dims = vectors.shape[1]
    turned = vectors @ rotation(dims).T
    aligned = np.abs(turned).sum(axis=1) / np.sqrt(dims)
    rest = (turned * turned).sum(axis=1) - aligned * aligned
    return _bits(turned >= 0), aligned, np.sqrt(np.maximum(rest, 0))


def _blocks(dims: int, block_rows: int):
    """Rows sorted by block to one row per block: its ids, labels, integers and codes."""
    columns = ["block", "ids", "labels", "ints", "words", "aligned", "rest"]

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, ids, labels, packed = None, [], [], []

        def block() -> pa.RecordBatch:
            ints = _unpacked(packed, dims)
            words, aligned, rest = codes(ints)
            out = [number, np.array(ids, "<i8"), np.array(labels, "<i8"), ints.astype("<i4"), words,
                   aligned.astype("<f8"), rest.astype("<f8")]
            for held in (ids, labels, packed):
                held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([out[0]], pa.int64()), *(pa.array([c.tobytes()], pa.binary()) for c in out[1:])], columns
            )

        for batch in batches:
            for b, i, label, value in zip(*(batch.column(c).to_pylist() for c in ("block", "id", "label", "packed"))):
                if packed and (b != number or len(packed) == block_rows):
                    yield block()
                number = b
                ids.append(i)
                labels.append(label)
                packed.append(value)
        if packed:
            yield block()

    return pack


class Block:
    """A block as arrays, and certain intervals of the scores of all its rows."""

    def __init__(self, row: dict, dims: int):
        self.ids = np.frombuffer(row["ids"], "<i8")
        self.labels = np.frombuffer(row["labels"], "<i8")
        self.ints = np.frombuffer(row["ints"], "<i4").reshape(len(self.ids), dims)
        self.words = np.frombuffer(row["words"], "<u8").reshape(len(self.ids), -(-dims // 64))
        self.aligned = np.frombuffer(row["aligned"], "<f8")
        self.rest = np.frombuffer(row["rest"], "<f8")
        self.dims = dims
        #: Rows scored with integers so far.
        self.scored = 0

    def intervals(self, query: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bounds of the inner products with an integer vector."""
        dims = self.dims
        turned = rotation_of(dims) @ query.astype(np.float64)
        low = turned.min()
        step = (turned.max() - low) / ((1 << QUERY_BITS) - 1) or 1.0
        whole = np.rint((turned - low) / step).astype(np.int64)
        # <signs, whole> by popcounts: twice the bits under the code less all bits, per plane.
        signed = np.full(len(self.ids), -whole.sum(), np.int64)
        for plane in range(QUERY_BITS):
            words = _bits((whole >> plane & 1).astype(bool)[None, :])[0]
            under = np.bitwise_count(self.words & words).sum(axis=1, dtype=np.int64)
            signed += under << (plane + 1)
        ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        root = np.sqrt(dims)
        along = (step * signed + low * (2 * ones - dims)) / root
        error = np.abs(turned - (low + step * whole)).sum() / root
        length = float((turned * turned).sum())
        # The rest of the query is longest where <c, q> may be nearest to zero.
        nearest = np.maximum(np.abs(along) - error, 0)
        wide = self.aligned * error + self.rest * np.sqrt(np.maximum(length - nearest * nearest, 0))
        middle = self.aligned * along
        wide += SLACK * (np.sqrt(length) * np.hypot(self.aligned, self.rest)) + SLACK
        return middle - wide, middle + wide

    def scores(self, which: np.ndarray, query: np.ndarray) -> np.ndarray:
        """Exact inner products: in floating point only where every sum stays exact."""
        if not len(which):
            return np.empty(0, np.int64)
        self.scored += len(which)
        rows = self.ints[which]
        largest = float(max(np.abs(rows).max(initial=0), 1)) * float(max(np.abs(query).max(initial=0), 1))
        if largest * max(self.dims, 1) < 2 ** 53:
            return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
        return rows.astype(np.int64) @ query


_rotations: dict[int, np.ndarray] = {}


def rotation_of(dims: int) -> np.ndarray:
    if dims not in _rotations:
        _rotations[dims] = rotation(dims)
    return _rotations[dims]


def _best(scores: np.ndarray, ids: np.ndarray, count: int) -> np.ndarray:
    """Places of the first ``count`` rows by score descending, id."""
    return np.lexsort((ids, -scores))[:count]


def _kth(values: np.ndarray, count: int) -> float:
    """The ``count``-th largest value; minus infinity if there are fewer."""
    return float(np.partition(values, len(values) - count)[len(values) - count]) if len(values) >= count else -np.inf


def _top(values: np.ndarray, count: int) -> np.ndarray:
    """Places of the ``count`` largest values, in no order."""
    return np.argpartition(values, -count)[-count:] if len(values) > count else np.arange(len(values))


def nearest_of_label(block: Block, anchor: int, label: int, query: np.ndarray, count: int):
    """Ids and scores of the first rows with the anchor's label in a block, the anchor left out."""
    same = np.flatnonzero((block.labels == label) & (block.ids != anchor))
    if not len(same):
        return same, same
    low, high = block.intervals(query)
    low, high = low[same], high[same]
    probes = same[_top(low + high, PROBES * count)]
    reach = same[high >= max(_kth(low, count), _kth(block.scores(probes, query), count))]
    scores = block.scores(reach, query)
    best = _best(scores, block.ids[reach], count)
    return block.ids[reach][best], scores[best]


def negatives_in_bands(block: Block, label: int, query: np.ndarray, positives: np.ndarray, count: int,
                       floor: int, ceiling: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Per positive score: the first rows of other labels between the two shares of it, in per cent."""
    other = np.flatnonzero(block.labels != label)
    empty = np.empty(0, np.int64)
    if not len(other):
        return [(empty, empty)] * len(positives)
    low, high = block.intervals(query)
    low, high = low[other], high[other]
    middle = (low + high) / 2
    wanted = np.zeros(len(other), bool)
    for score in positives.tolist():
        bottom, top = floor * score / 100, ceiling * score / 100
        inside = np.flatnonzero((high >= bottom) & (low <= top))
        # Rows that are in the band, as their interval or their score says, bound what others have to reach.
        sure = _kth(low[inside][(low[inside] >= bottom) & (high[inside] <= top)], count)
        likely = inside[middle[inside] <= top]
        probes = block.scores(other[likely[_top(middle[likely], PROBES * count)]], query)
        reached = _kth(probes[(floor * score <= 100 * probes) & (100 * probes <= ceiling * score)], count)
        wanted[inside[high[inside] >= max(sure, reached)]] = True
    other = other[wanted]
    scores = block.scores(other, query)
    ids = block.ids[other]
    out = []
    for score in positives.tolist():
        held = np.flatnonzero((floor * score <= 100 * scores) & (100 * scores <= ceiling * score))
        held = held[_best(scores[held], ids[held], count)]
        out.append((ids[held], scores[held]))
    return out


def _positives(dims: int, count: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, dims)
                anchors, ids, scores = [], [], []
                for anchor in row["anchors"]:
                    query = _unpacked([anchor["packed"]], dims)[0]
                    best, score = nearest_of_label(block, anchor["id"], anchor["label"], query, count)
                    anchors.append(np.full(len(best), anchor["id"]))
                    ids.append(best)
                    scores.append(score)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in (anchors, ids, scores)],
                    ["anchor_id", "positive_id", "positive_score"],
                )

    return search


def _negatives(dims: int, count: int, floor: int, ceiling: int):
    names = ["anchor_id", "positive_id", "positive_score", "negative_id", "negative_score"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                block = Block(row, dims)
                columns: list[list[np.ndarray]] = [[np.empty(0, np.int64)] for _ in names]
                for anchor in row["anchors"]:
                    query = _unpacked([anchor["packed"]], dims)[0]
                    positives = anchor["positives"]
                    found = negatives_in_bands(
                        block, anchor["label"], query, np.array([p["score"] for p in positives], np.int64),
                        count, floor, ceiling,
                    )
                    for positive, (ids, scores) in zip(positives, found):
                        known = (anchor["id"], positive["id"], positive["score"])
                        for column, value in zip(columns, [*known, ids, scores]):
                            column.append(np.full(len(ids), value) if isinstance(value, int) else value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c).astype(np.int64)) for c in columns], names
                )

    return search


# --- the operator -------------------------------------------------------------------

def _first(rows: DataFrame, by: list[str], score: str, row: str, count: int) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.col(score).desc(), F.col(row))
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= count)


def _met(packs: DataFrame, blocks: DataFrame, count: int, slices: int) -> DataFrame:
    """Packs of anchors beside every block.

    A pack is sent to all block numbers, a block to all slices of the packs, so one task
    meets one block and one slice of packs at most, however many there are. Joined by merge:
    blocks are too large to be counted on a broadcast.
    """
    numbers = F.sequence(F.lit(0), F.lit(count - 1)).cast("array<long>")
    dealt = packs.withColumn("slice", F.pmod("pack", F.lit(slices))).withColumn("block", F.explode(numbers))
    places = F.sequence(F.lit(0), F.lit(slices - 1)).cast("array<long>")
    return dealt.join(blocks.withColumn("slice", F.explode(places)).hint("merge"), ["block", "slice"])


def hard_negatives(rows: DataFrame, label: Column, anchor: Column, positives: int = 5, negatives: int = 10,
                   floor: int = 30, ceiling: int = 90, id_col: str = "vec_id",
                   vector_col: str = "embedding", block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For each anchor and positive the first negatives in a band of scores.

    Components become floor(256 * x); a score is the inner product of these integers, larger
    ones first, ties by the smaller id. Anchors are the rows where ``anchor`` holds, their
    positives the first ``positives`` other rows of the same label. Negatives are the first
    ``negatives`` rows of other labels with a score of ``floor`` to ``ceiling`` per cent of the
    positive's. Columns: anchor_id, positive_id, rank (from 1), negative_id, positive_score,
    negative_score.

    * Rows with a null id, label or vector, or a null or non-finite component, take no part,
      nor do rows with an integer component beyond 2^26: their scores need not fit 64 bits.
    * A shorter vector ends in zeros; an empty one is all zeros.
    * An id that comes several times is one row: that of the smallest label, then vector.
    * A positive with a negative score has an empty band. An anchor without other rows of
      its label, or without a row in the band, gives no rows; nor does an empty table.
    * ``label`` and ``anchor`` are expressions over the input's columns; other columns are
      not read.
    """
    unique = staged(
        integer_vectors(rows, id_col, vector_col, label, anchor).withColumn("at", F.monotonically_increasing_id()),
        "negatives-rows",
    )
    kind = rows.schema[id_col].dataType
    part = F.shiftright("at", ROW_BITS)
    # One row per task that wrote the rows: these few numbers are what is collected and broadcast.
    sizes = unique.groupBy(part.alias("part")).agg(
        F.count(F.lit(1)).alias("n"), F.max(F.octet_length("packed")).alias("bytes")
    ).orderBy("part").collect()
    total = sum(r["n"] for r in sizes)
    dims, count = max([1, *(r["bytes"] // 4 for r in sizes)]), max(1, -(-total // block_rows))
    before = [0, *accumulate(r["n"] for r in sizes)]
    offsets = rows.sparkSession.createDataFrame(
        [(r["part"], n) for r, n in zip(sizes, before)], "part long, before long"
    )
    place = F.col("before") + F.col("at").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    unique = unique.withColumn("part", part).join(F.broadcast(offsets), "part").select(
        "id", "label", "packed", "asked", F.floor(place / block_rows).cast("long").alias("block")
    )
    blocks = staged(
        unique.repartition("block").sortWithinPartitions("block", "id")
        .mapInArrow(_blocks(dims, block_rows), "block long, ids binary, labels binary, ints binary, "
                    "words binary, aligned binary, rest binary"),
        "negatives-blocks",
    )
    asked = unique.where("asked")
    n_packs = -(-asked.count() // PACK_ANCHORS) or 1
    slices = -(-n_packs // PACKS_AT_ONCE)
    pack = F.pmod(F.xxhash64("id"), F.lit(n_packs))
    packs = asked.groupBy(pack.alias("pack")).agg(F.collect_list(F.struct("id", "label", "packed")).alias("anchors"))
    found = _met(packs, blocks, count, slices).mapInArrow(
        _positives(dims, positives), "anchor_id long, positive_id long, positive_score long"
    )
    known = staged(_first(found, ["anchor_id"], "positive_score", "positive_id", positives), "negatives-positives")

    listed = known.groupBy(F.col("anchor_id").alias("id")).agg(
        F.collect_list(F.struct(F.col("positive_id").alias("id"), F.col("positive_score").alias("score"))).alias("positives")
    )
    packs = asked.join(listed, "id").groupBy(pack.alias("pack")).agg(
        F.collect_list(F.struct("id", "label", "packed", "positives")).alias("anchors")
    )
    found = _met(packs, blocks, count, slices).mapInArrow(
        _negatives(dims, negatives, floor, ceiling),
        "anchor_id long, positive_id long, positive_score long, negative_id long, negative_score long",
    )
    ranked = _first(found, ["anchor_id", "positive_id", "positive_score"], "negative_score", "negative_id", negatives)
    return ranked.select(
        F.col("anchor_id").cast(kind), F.col("positive_id").cast(kind), F.col("rank").cast("int").alias("rank"),
        F.col("negative_id").cast(kind), "positive_score", "negative_score",
    )

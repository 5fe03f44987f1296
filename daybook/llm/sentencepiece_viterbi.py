"""SentencePiece encoding and decoding: Aho-Corasick over the pieces, one Viterbi pass.

The automaton reports, at every position, all pieces that end there (it follows its
output links); each relaxes the best score of that position. The best segmentation is
the one with the highest sum of piece scores; of equal sums, the one whose last piece is
longest, and so on backwards. A character that is no piece becomes its bytes.

Spaces stand for themselves here, not for the mark that the vocabulary file uses, so a
text that holds the mark itself also comes back unchanged.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
#: Below the lowest piece score, as much as a character that is no piece costs.
UNKNOWN_COST = 10.0
#: Distinct words whose pieces a task remembers.
MEMORY = 300_000

MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def load_pieces(model_file: str = MODEL) -> dict:
    """The vocabulary as plain data: texts, ids and scores of pieces, and ids of bytes."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=model_file)
    pieces, bytes_ids, table = [], [0] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            bytes_ids[int(piece[3:5], 16)] = i
            table.append(bytes([int(piece[3:5], 16)]))
        elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
            table.append(b"")
        else:
            piece = piece.replace(MARK, " ")
            pieces.append((piece, i, model.get_score(i)))
            table.append(piece.encode())
    return {"pieces": pieces, "bytes": bytes_ids, "table": table}


class Encoder:
    """Encodes texts with a loaded vocabulary."""

    def __init__(self, vocabulary: dict):
        self.automaton = ahocorasick.Automaton()
        for piece, number, score in vocabulary["pieces"]:
            self.automaton.add_word(piece, (len(piece), number, score))
        self.automaton.make_automaton()
        self.bytes_ids = vocabulary["bytes"]
        pieces = [p for p, _, _ in vocabulary["pieces"]]
        self.single = {p for p in pieces if len(p) == 1}
        self.unknown = min(s for _, _, s in vocabulary["pieces"]) - UNKNOWN_COST
        # No piece has a space behind another character: then a text falls into parts in
        # front of each run of spaces, and each part can be encoded by itself.
        self.parts = all(" " not in p.lstrip(" ") for p in pieces)
        self.known: dict[str, bytes] = {}

    def best(self, text: str) -> list[int]:
        """The ids of the best segmentation, in one pass over the text."""
        size = len(text)
        score = [0.0] + [-np.inf] * size
        came = [(0, 0)] * (size + 1)  # start and id of the best last piece; id -1: bytes
        open_at = 1  # positions before this one are final
        for last, (length, number, worth) in self.automaton.iter(text):
            end = last + 1
            while open_at <= end:
                if text[open_at - 1] not in self.single:
                    score[open_at] = score[open_at - 1] + self.unknown
                    came[open_at] = (open_at - 1, -1)
                open_at += 1
            total = score[end - length] + worth
            # Longer pieces are reported first and win ties, also against bytes.
            if total > score[end] or (total == score[end] and end - length < came[end][0]):
                score[end], came[end] = total, (end - length, number)
        for at in range(open_at, size + 1):
            score[at], came[at] = score[at - 1] + self.unknown, (at - 1, -1)
        ids: list[int] = []
        at = size
        while at:
            start, number = came[at]
            if number < 0:
                ids += [self.bytes_ids[b] for b in reversed(text[start:at].encode())]
            else:
                ids.append(number)
            at = start
        return ids[::-1]

    def encode(self, text: str) -> bytes:
        """The ids of a whole text as 32-bit integers; none for an empty text."""
        if not text:
            return b""
        if not self.parts:
            return np.array(self.best(" " + text), np.int32).tobytes()
        parts = text.split(" ")
        if "" in parts:  # spaces in a row belong to one part
            parts = [p[1:] for p in re.findall(r" +[^ ]*", " " + text)]
        known = self.known
        found = []
        for part in parts:
            ids = known.get(part)
            if ids is None:
                if len(known) >= MEMORY:
                    known.clear()
                ids = known[part] = np.array(self.best(" " + part), np.int32).tobytes()
            found.append(ids)
        return b"".join(found)


def decode(ids: list[int], table: list[bytes]) -> str:
    """The text that was encoded; the space put in front of it is taken off."""
    return b"".join([table[i] for i in ids]).decode("utf-8", "replace")[1:]


def _encoding(broadcast):
    schema = pa.schema([("id", pa.string()), ("pieces", pa.list_(pa.int32())), ("same", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = broadcast.value
        encoder, table = Encoder(vocabulary), vocabulary["table"]
        for batch in batches:
            texts = batch.column("text").fill_null("").to_pylist()
            encoded = [encoder.encode(t) for t in texts]
            same = [decode(np.frombuffer(e, np.int32).tolist(), table) == t for e, t in zip(encoded, texts)]
            offsets = np.concatenate(([0], np.cumsum([len(e) // 4 for e in encoded]))).astype(np.int32)
            values = pa.array(np.frombuffer(b"".join(encoded), np.int32))
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(same)],
                schema=schema,
            )

    return run


def encode_documents(docs: DataFrame, model_file: str = MODEL, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """One row per document: id, pieces (ids), n_pieces, round_trip.

    ``round_trip`` tells whether the ids decode to exactly the text.

    * A null or empty text has no pieces. A null id stays null; repeated rows are rows of
      their own. Without documents there are no rows. Other columns are ignored.
    * Texts of any length are encoded whole. The vocabulary is read on the driver and
      sent to the tasks; its size does not depend on the corpus.
    """
    spark = docs.sparkSession
    vocabulary = spark.sparkContext.broadcast(load_pieces(model_file))
    found = docs.select(
        F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text")
    ).mapInArrow(_encoding(vocabulary), "id string, pieces array<int>, same boolean")
    return found.select(
        F.col("id").cast(docs.schema[id_col].dataType).alias(id_col), "pieces",
        F.size("pieces").cast("long").alias("n_pieces"), F.col("same").alias("round_trip"),
    )


def decode_documents(encoded: DataFrame, model_file: str = MODEL, id_col: str = "doc_id",
                     pieces_col: str = "pieces") -> DataFrame:
    """One row per row: id and the decoded text; null or no pieces give an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(load_pieces(model_file)["table"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [decode(ids or [], vocabulary.value) for ids in batch.column("pieces").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(texts, pa.string())], ["id", "text"]
            )

    found = encoded.select(F.col(id_col).cast("string").alias("id"), F.col(pieces_col).alias("pieces"))
    return found.mapInArrow(run, "id string, text string").select(
        F.col("id").cast(encoded.schema[id_col].dataType).alias(id_col), "text"
    )

"""Language-model scoring of whole documents with a gated recurrent model.

Counts cover all training texts. The most frequent words are the head of the model; all
other words belong to tail classes by their spelling. Training goes over all training
texts once, in rounds: in each, every task trains on its part from the same weights, and
the results are averaged. The head grows until it covers most tokens, and the number of
classes grows with it and with the vocabulary. A document's probability is that of each token's class and
head word, by the model, times the share of a tail word in its class, by the counts.

Words with a count of their own are sent to the tasks up to a fixed number; the counts of
all other words meet the documents in a join.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from daybook.llm import gru
from daybook.llm.common import staged
from daybook.llm.quality import held_out

#: The token behind each text; no word can hold a space.
END = b" "

#: Least number of head words, and the share of all tokens that they cover at least.
HEAD_WORDS = 2000
HEAD_SHARE = 0.6
#: Least numbers of head words of a class and of tail classes.
CLASS_WORDS = 50
TAIL_CLASSES = 48
STATE = 16
SEED = 5

#: Words whose counts are sent to all tasks.
KNOWN_WORDS = 200_000
#: Distinct words that a task counts before it passes them on.
COUNTER_WORDS = 400_000

ROUNDS = 3
LANES = 256
STEPS = 24
#: Scores are the same with any number of lanes.
SCORE_LANES = 1024
#: Bytes of text that are put into lanes together, a longer text alone.
LANE_BYTES = 32 << 20
#: The same in scoring, where a token takes some 80 bytes of a task; scores are the same with any number.
SCORE_BYTES = 8 << 20
#: Partial sums of weights that a task adds up.
FAN = 16
#: Partial sums of weights that reach the driver.
SUMS = 32
#: Bytes of partial sums that reach the driver together, or one sum.
SUM_BYTES = 16 << 20


def _spelling_tables() -> tuple[np.ndarray, np.ndarray]:
    """Of a byte: the kind of ending it makes, and whether it counts as a letter's punctuation."""
    ending = 3 + np.arange(256) % 4
    ending[[i for i in range(128) if chr(i).isalnum()] + [*range(128, 256)]] = 0
    ending[[46, 44]] = 1, 2
    punctuation = np.zeros(256, bool)
    punctuation[list(b".,;:!?#$%&*'\")")] = True
    return ending, punctuation


ENDING, PUNCTUATION = _spelling_tables()


def signatures(words: pa.Array) -> np.ndarray:
    """For each word a number below 301 that its spelling gives: its ending and its letters."""
    bounds = np.frombuffer(words.buffers()[1], np.int32)[words.offset:words.offset + len(words) + 1]
    data = np.frombuffer(words.buffers()[2] or b"", np.uint8)[:bounds[-1]]
    starts, ends = bounds[:-1], bounds[1:]
    # The last byte that is no punctuation, and the first beyond ASCII, or a place outside the word.
    letters = np.append(-1, np.flatnonzero(~PUNCTUATION[data]))
    letter = letters[np.searchsorted(letters, ends) - 1]
    beyond = np.append(np.flatnonzero(data >= 128), len(data))
    high = beyond[np.searchsorted(beyond, starts)]
    found = np.where(letter >= starts, data[letter], 0).astype(np.int32) - 97
    found[(found < 0) | (found > 25)] = 26
    inside = high < ends
    found[inside] = 27 + data[np.minimum(high[inside] + 1, ends[inside] - 1)] % 16
    return ENDING[data[ends - 1]] * 43 + found


def _words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words of texts one after another, A-Z lowered, and of which text each is."""
    found = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))  # lowers and splits at ASCII only
    words = found.flatten().cast(pa.binary())
    text = np.repeat(np.arange(len(texts), dtype=np.int32), pc.list_value_length(found).to_numpy(zero_copy_only=False))
    empty = pc.equal(pc.binary_length(words), 0)  # beside leading and trailing white space
    if pc.any(empty).as_py():
        words, text = words.filter(pc.invert(empty)), text[~empty.to_numpy(zero_copy_only=False)]
    return words, text


def _groups(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[pa.RecordBatch]:
    """Rows of about ``most`` bytes of text; a longer text ends its group."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
        ends, first = np.cumsum(sizes, dtype=np.int64), 0
        while first < len(ends):
            before = ends[first - 1] if first else 0
            last = min(int(np.searchsorted(ends, before + most)) + 1, len(ends))
            yield batch.slice(first, last - first)
            first = last


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    schema = pa.schema([("word", pa.binary()), ("spelling", pa.int32()), ("c", pa.int64())])

    def counted() -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(held)
        if len(held) > 1:
            table = table.group_by("word", use_threads=False).aggregate([("c", "sum")]).rename_columns(["word", "c"])
        for part in table.combine_chunks().to_batches():
            spelling = pa.array(signatures(part.column("word")), pa.int32())
            yield pa.RecordBatch.from_arrays([part.column("word"), spelling, part.column("c")], schema=schema)

    held: list[pa.RecordBatch] = []
    for batch in _groups(batches, SCORE_BYTES):
        words, _ = _words(batch.column("text"))
        counts = words.value_counts()
        for word, c in ((counts.field("values"), counts.field("counts")), ([END], [len(batch)])):
            held.append(pa.RecordBatch.from_arrays([pa.array(word, pa.binary()), pa.array(c, pa.int64())], ["word", "c"]))
        if sum(map(len, held)) > COUNTER_WORDS:
            yield from counted()
            held.clear()
    if held:
        yield from counted()


def word_counts(texts: DataFrame) -> DataFrame:
    """Counts (word, spelling, c) of all tokens of a column ``text``; the end of a text is one."""
    return texts.select("text").mapInArrow(_count, "word binary, spelling int, c long").groupBy(
        "word", "spelling"
    ).agg(F.sum("c").alias("c"))


def _plan(counts: DataFrame) -> dict:
    """What tasks need to know of the counts, as plain data, of ``KNOWN_WORDS`` words at most."""
    power = F.floor(F.log2("c"))
    sums = counts.groupBy("spelling", power.alias("power")).agg(F.sum("c").alias("n"), F.count("c").alias("v")).collect()
    total, distinct = sum(r["n"] for r in sums), sum(r["v"] for r in sums)
    by_spelling: dict[int, tuple[int, int]] = {}
    by_power: Counter[int] = Counter()
    for r in sums:
        n, v = by_spelling.get(r["spelling"], (0, 0))
        by_spelling[r["spelling"]] = n + r["n"], v + r["v"]
        by_power[r["power"]] += r["v"]
    # Only words as frequent as the most frequent ones are sorted.
    enough = [p for p in by_power if sum(v for q, v in by_power.items() if q >= p) >= KNOWN_WORDS]
    top = counts.where(power >= max(enough, default=0)).orderBy(F.desc("c"), "word").limit(KNOWN_WORDS).toArrow()
    words, spellings, counted = (top[c].to_pylist() for c in ("word", "spelling", "c"))

    covering = int(np.searchsorted(np.cumsum(np.array(counted, np.int64)), HEAD_SHARE * total)) + 1
    head = [i for i in range(min(max(HEAD_WORDS, covering), len(words)))]
    if END in words and words.index(END) not in head:
        head.append(words.index(END))
    in_head = set(head)
    mass = {s: list(nv) for s, nv in by_spelling.items()}
    for i in head:
        mass[spellings[i]][0] -= counted[i]
        mass[spellings[i]][1] -= 1
    # The tail classes with most tokens; all other spellings, met or not, share the last one.
    tails = max(TAIL_CLASSES, math.isqrt(distinct) // 8)
    named = sorted((s for s in mass if mass[s][1] > 0), key=lambda s: (-mass[s][0], s))[:tails - 1]
    # Head words of a class are similar in spelling and, within it, in frequency.
    head.sort(key=lambda i: (spellings[i], -counted[i], words[i]))
    width = max(CLASS_WORDS, math.isqrt(len(head)))
    bounds = [*range(0, len(head), width), len(head)] if head else [0]
    first_tail = len(bounds) - 1
    tail_of = [first_tail + (named.index(s) if s in named else len(named)) for s in range(301)]
    classes = first_tail + len(named) + 1
    tail_n, tail_v = [0] * classes, [0] * classes
    for s, (n, v) in mass.items():
        tail_n[tail_of[s]] += n
        tail_v[tail_of[s]] += v
    share = [0.1 / (n + 0.1 * (v + 1)) for n, v in zip(tail_n, tail_v)]
    class_n = [sum(counted[i] for i in head[a:b]) for a, b in zip(bounds, bounds[1:])]
    class_n += [tail_n[k] + 0.1 * (tail_v[k] + 1) for k in range(first_tail, classes)]
    number = {words[i]: at for at, i in enumerate(head)}
    # Of a word: input of the model, class, head word, log10 of the base and of its share in the class.
    rows = []
    for word, spelling, c in zip(words, spellings, counted):
        at = number.get(word, -1)
        kind = int(np.searchsorted(bounds, at, "right")) - 1 if at >= 0 else tail_of[spelling]
        rows.append((
            at if at >= 0 else len(head) + kind - first_tail, kind, at,
            math.log10((c + 0.1) / (total + 0.1 * (distinct + 1))),
            0.0 if at >= 0 else math.log10((c + 0.1) * share[kind] / 0.1),
        ))
    # All other words of a tail class share a row; what counts say of them comes from a join.
    rows += [(len(head) + k - first_tail, k, -1, 0.0, 0.0) for k in range(first_tail, classes)]
    table = np.array(rows, np.float64)
    return {
        "total": total, "distinct": distinct, "known": {w: i for i, w in enumerate(words)},
        "ids": table[:, :3].astype(np.int32), "logs": table[:, 3:], "tail_of": tail_of, "head": len(head),
        "bounds": bounds, "classes": classes, "share": share,
        "class_log": np.log(np.maximum(class_n, 0.1)).astype(np.float32),
        "word_log": np.log([counted[i] for i in head] or [1]).astype(np.float32)[:len(head)],
    }


def _shape(plan: dict) -> dict:
    return {"inputs": plan["head"] + plan["classes"] - len(plan["bounds"]) + 1, "state": STATE,
            "classes": plan["classes"], "head_bounds": plan["bounds"]}


def _known(plan: dict) -> pa.Array:
    return pa.array(list(plan["known"]), pa.binary())


def _encoded(texts: pa.Array, plan: dict, known: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array, np.ndarray, np.ndarray]:
    """Rows of the plan's tables for all tokens, where each text ends, and all other words.

    These are the words that are not ``known``, with the text and the tail class of each.
    """
    words, text = _words(texts)
    found = pc.fill_null(pc.index_in(words, value_set=known), -1).to_numpy(zero_copy_only=False)
    offsets = np.append(0, np.cumsum(np.bincount(text, minlength=len(texts)) + 1))
    rows = np.full(offsets[-1], plan["known"].get(END, -1), np.int32)
    places = np.arange(len(text)) + text  # each text before adds its end
    rows[places] = found
    missing = found < 0
    other, at, text = words.filter(pa.array(missing)), places[missing], text[missing]
    if END not in plan["known"]:
        other = pa.concat_arrays([other, pa.array([END] * len(texts), pa.binary())])
        at, text = np.append(at, offsets[1:] - 1), np.append(text, np.arange(len(texts)))
    kinds = np.array(plan["tail_of"], np.int32)[signatures(other)]
    rows[at] = len(plan["known"]) - len(plan["bounds"]) + 1 + kinds
    return rows, offsets, other, text, kinds


def _ids(plan: dict, rows: np.ndarray) -> list[np.ndarray]:
    return [plan["ids"][rows, k] for k in range(3)]


def _training(broadcast, weights):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = broadcast.value
        shape = gru.Shape(**_shape(plan))
        trainer = gru.Trainer(weights.value, shape)
        known = _known(plan)
        for batch in _groups(batches, LANE_BYTES):
            # Words take more room than their rows, so fewer are split at once.
            parts = [_encoded(part.column("text"), plan, known)[:2] for part in _groups(iter([batch]), SCORE_BYTES)]
            rows = np.concatenate([part for part, _ in parts])
            offsets = np.append(0, np.cumsum(np.concatenate([np.diff(ends) for _, ends in parts])))
            gru.train(trainer, offsets, *_ids(plan, rows), LANES, STEPS)
        if trainer.tokens:
            yield pa.RecordBatch.from_arrays(
                [pa.array([trainer.tokens], pa.int64()),
                 pa.array([(trainer.vector.astype(np.float64) * trainer.tokens).tobytes()], pa.binary())],
                ["tokens", "sum"],
            )

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    tokens, total = 0, None
    for batch in batches:
        for n, part in zip(batch.column("tokens").to_pylist(), batch.column("sum")):
            values = np.frombuffer(part.as_py(), np.float64)
            tokens, total = tokens + n, values if total is None else total + values
    if total is not None:
        yield pa.RecordBatch.from_arrays(
            [pa.array([tokens], pa.int64()), pa.array([total.tobytes()], pa.binary())], ["tokens", "sum"]
        )


def fan_in(count: int, least: int) -> list[int]:
    """Numbers of partial sums, level by level, from ``count`` down to ``least`` or fewer."""
    levels = []
    while count > least:
        count = max(least, -(-count // FAN))
        levels.append(count)
    return levels


def train_model(texts: DataFrame, plan: dict, broadcast) -> np.ndarray:
    """Weights after one pass over all texts (id, text), dealt to rounds by a hash of the id."""
    vector = gru.initial(gru.Shape(**_shape(plan)), plan["class_log"], plan["word_log"], SEED)
    if not plan["total"]:
        return vector
    kind = "tokens long, sum binary"
    parts = max(1, min(SUMS, SUM_BYTES // (8 * len(vector))))
    spark = texts.sparkSession
    for number in range(ROUNDS):
        part = texts.where(F.pmod(F.xxhash64(F.lit(SEED), "id"), F.lit(ROUNDS)) == number)
        trained = part.mapInArrow(_training(broadcast, spark.sparkContext.broadcast(vector)), kind)
        # Partial sums, so that the driver and each task add a bounded number of vectors at any size.
        for count in fan_in(part.rdd.getNumPartitions(), parts):
            trained = trained.repartition(count).mapInArrow(_added, kind)
        sums = trained.collect()
        tokens = sum(r["tokens"] for r in sums)
        if tokens:
            vector = (sum(np.frombuffer(r["sum"], np.float64) for r in sums) / tokens).astype(np.float32)
    return vector


def _scoring(broadcast, weights):
    schema = pa.schema([
        ("id", pa.string()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("base", pa.float64()),
        ("model", pa.float64()), ("words", pa.list_(pa.binary())), ("kinds", pa.list_(pa.int32())),
        ("times", pa.list_(pa.int32())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = broadcast.value
        shape = gru.Shape(**_shape(plan))
        model = gru.split(weights.value, shape)
        known = _known(plan)
        for batch in _groups(batches, SCORE_BYTES):
            rows, offsets, other, text, kinds = _encoded(batch.column("text"), plan, known)
            logs = gru.score(model, shape, offsets, *_ids(plan, rows), SCORE_LANES, STEPS) / math.log(10)
            base, share = plan["logs"][rows, 0], plan["logs"][rows, 1]
            sums = [np.add.reduceat(v, offsets[:-1]) for v in (base, logs + share)]
            counts = np.diff(offsets)
            missing = np.bincount(text, minlength=len(counts))
            # Each other word of a text once, with the times it occurs there.
            coded = other.dictionary_encode()
            number, width = coded.indices.to_numpy(), max(1, len(coded.dictionary))
            pairs, first, times = np.unique(text.astype(np.int64) * width + number, return_index=True, return_counts=True)
            bounds = pa.array(np.searchsorted(pairs // width, np.arange(len(counts) + 1)), pa.int32())
            lists = [other.take(pa.array(first)), pa.array(kinds[first], pa.int32()), pa.array(times, pa.int32())]
            yield pa.RecordBatch.from_arrays([
                batch.column("id").cast(pa.string()), pa.array(counts), pa.array(counts - missing),
                pa.array(sums[0]), pa.array(sums[1]),
                *[pa.ListArray.from_arrays(bounds, values) for values in lists],
            ], schema=schema)

    return run


def score_documents(docs: DataFrame, parts: int = 10, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Texts whose id's CRC-32 is divisible by ``parts`` are held out; the model and the base
    learn from all others. Scores are log10 probabilities of the whole text and its end.

    * A null or empty text is its end alone. A null id is scored, not learned from.
    * Repeated rows count as often as they occur and get a row each. Without documents
      there are no rows; without texts to learn from every token has probability one in
      the base, and the model knows classes of no words.
    * Texts of any length are read whole; the state is carried through all of them. Other
      columns are ignored.
    """
    spark = docs.sparkSession
    kind = docs.schema[id_col].dataType
    texts = docs.select(F.col(id_col).cast("string").alias("id"), F.col(text_col).cast("string").alias("text"))
    learn = texts.where(F.col("id").isNotNull() & ~held_out(F.col("id"), parts))
    counts = staged(word_counts(learn), "lm-counts")
    plan = _plan(counts)
    broadcast = spark.sparkContext.broadcast(plan)
    weights = spark.sparkContext.broadcast(train_model(learn, plan, broadcast))
    scored = staged(
        texts.mapInArrow(
            _scoring(broadcast, weights), "id string, n_tokens long, n_known long, base double, "
            "model double, words array<binary>, kinds array<int>, times array<int>"
        ).withColumn("row", F.monotonically_increasing_id()),
        "lm-scored",
    )
    total, distinct = plan["total"], plan["distinct"]
    share = F.array(*[F.lit(s) for s in plan["share"]])
    count = F.coalesce("c", F.lit(0)) + 0.1
    rest = (
        scored.select("row", F.explode(F.arrays_zip("words", "kinds", "times")).alias("t"))
        .select("row", F.col("t.words").alias("word"), F.col("t.kinds").alias("k"), F.col("t.times").alias("n"))
        .join(counts.select("word", "c").hint("merge"), "word", "left")
        .groupBy("row").agg(
            F.sum(F.when(F.col("c") > 0, F.col("n")).otherwise(0)).alias("more"),
            F.sum(F.col("n") * F.log10(count / F.lit(total + 0.1 * (distinct + 1)))).alias("base_rest"),
            F.sum(F.col("n") * F.log10(count * F.get(share, F.col("k")) / 0.1)).alias("model_rest"),
        )
    )
    return scored.drop("words", "kinds", "times").join(rest, "row", "left").select(
        F.col("id").cast(kind).alias(id_col), held_out(F.col("id"), parts).alias("held_out"), "n_tokens",
        (F.col("n_known") + F.coalesce("more", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"),
        (F.col("model") + F.coalesce("model_rest", F.lit(0.0))).alias("score"),
    )

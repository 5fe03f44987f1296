"""A gated recurrent language model in numpy with a class-factored softmax.

The probability of a word is that of its class times that of the word in its class. Only
the most frequent words (the head) have weights of their own; the words of a tail class
share one input vector, and their share of the class comes from counts, outside.

Tokens run in lanes: each lane holds whole documents one after another. The state is
carried from window to window and set to zero where a document begins.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

RATE = 0.08
CLIP = 5.0


@dataclass
class Shape:
    """Sizes of the model: inputs (head words, then tail classes), state, head words by class.

    ``head_bounds[k]`` to ``head_bounds[k + 1]`` are the head words of class k; classes
    from ``len(head_bounds) - 1`` on are tail classes.
    """

    inputs: int
    state: int
    classes: int
    head_bounds: list[int]

    def parts(self) -> dict[str, tuple[int, ...]]:
        head = self.head_bounds[-1]
        return {
            "gates": (self.inputs, 3 * self.state), "again": (self.state, 3 * self.state),
            "to_class": (self.state, self.classes), "class_bias": (self.classes,),
            "to_word": (head, self.state), "word_bias": (head,),
        }


def split(vector: np.ndarray, shape: Shape) -> dict[str, np.ndarray]:
    """Named views of one vector that holds all weights."""
    weights, at = {}, 0
    for name, size in shape.parts().items():
        count = int(np.prod(size))
        weights[name] = vector[at:at + count].reshape(size)
        at += count
    return weights


def initial(shape: Shape, class_log: np.ndarray, word_log: np.ndarray, seed: int) -> np.ndarray:
    """Weights that give each class and head word its share in the counts, whatever the state."""
    vector = np.zeros(sum(int(np.prod(s)) for s in shape.parts().values()), np.float32)
    weights, rng = split(vector, shape), np.random.default_rng(seed)
    weights["gates"][:] = rng.normal(0, 0.4, weights["gates"].shape)
    weights["again"][:] = rng.normal(0, 1 / np.sqrt(shape.state), weights["again"].shape)
    weights["class_bias"][:] = class_log
    weights["word_bias"][:] = word_log
    return vector


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def _step(weights, state, x, h):
    """One step of the cell for all lanes, with the inputs' part of the gates in ``x``.

    State and gates have a column for each lane, so that their parts lie together. Returns
    the new state; ``x`` becomes keep, reset and new, and ``h`` the state's part.
    """
    size = len(state)
    np.matmul(weights["again"].T, state, out=h)
    x[:2 * size] += h[:2 * size]
    _sigmoid(x[:2 * size])
    keep, reset, new = x[:size], x[size:2 * size], x[2 * size:]
    new += reset * h[2 * size:]
    np.tanh(new, out=new)
    state = state - new
    state *= keep
    state += new
    return state


#: Logits that lie this close together need no maximum of their own in each row.
SAFE_RANGE = 60.0
#: Tokens that a softmax takes together, over all classes and over the words of one class.
CLASS_TILE = 64
WORD_TILE = 32
#: Tokens that are scored together, or those of one window.
SCORE_TOKENS = 16_000
#: Values of a softmax that are held at once; they stay in the cache.
HELD = 1 << 17


def _narrow(numbers: np.ndarray, end: int) -> np.ndarray:
    """Numbers below ``end`` in a type that sorts fastest."""
    return numbers.astype(np.uint16) if end <= 1 << 16 else numbers


def _first(ordered: np.ndarray) -> np.ndarray:
    """Where a new value begins."""
    return np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1])))[:len(ordered)]


def _softmax(tiles, of, matrix, bias, learn: bool):
    """Log of the sum of exponentials for each row of each tile, and what learning needs.

    ``tiles`` is tiles x rows x (state, one); a row of zeros is no token. Tile i has the
    words ``matrix[of[i]]`` (words x state) and ``bias[of[i]]``, minus infinity where there
    is none; ``of`` ascends. With ``learn`` also returns each row's mean of the matrix, and
    the sum over all rows of (state, one) times each probability.
    """
    width, size = matrix.shape[1:]
    top = bias.max(axis=1, keepdims=True)
    # States lie between -1 and 1, so this bounds all logits without looking at them.
    low = np.where(np.isfinite(bias), bias, top).min(axis=1, keepdims=True)
    safe = float((top - low).max() + 2 * (np.abs(matrix) @ np.ones(size, np.float32)).max()) < SAFE_RANGE
    weight = np.exp(bias - top) if safe else np.isfinite(bias).astype(np.float32)
    if learn:
        turned = np.empty((len(matrix), width, size + 1), np.float32)
        np.multiply(matrix, weight[:, :, None], out=turned[:, :, :size])
        turned[:, :, size] = weight
        means = np.empty((*tiles.shape[:2], size), np.float32)
        added = np.zeros((len(matrix), size + 1, width), np.float32)
    else:
        turned = weight[:, :, None]
    logs = np.empty(tiles.shape[:2], np.float32)
    matrix = np.ascontiguousarray(matrix.transpose(0, 2, 1))
    count = max(1, HELD // (tiles.shape[1] * width))
    held = np.empty((min(count, len(tiles)), tiles.shape[1], width), np.float32)
    for a in range(0, len(tiles), count):
        rows, kinds = tiles[a:a + count], of[a:a + count] if len(matrix) > 1 else slice(None)
        found = np.matmul(rows[:, :, :size], matrix[kinds], out=held[:len(rows)])
        if safe:
            shift = top[kinds]
        else:
            found += bias[kinds][:, None, :]
            shift = found.max(axis=2)
            found -= shift[:, :, None]
        np.exp(found, out=found)
        sums = found @ turned[kinds]
        total = sums[:, :, -1]
        logs[a:a + count] = np.log(total) + shift
        if learn:
            np.divide(sums[:, :, :size], total[:, :, None], out=means[a:a + count])
            part = (rows / total[:, :, None]).transpose(0, 2, 1) @ found
            if len(matrix) == 1:
                added[0] += part.sum(axis=0)
                continue
            first = _first(of[a:a + count])
            size_of = np.diff(np.append(first, len(rows)))
            added[of[a + first]] += part[first]
            for low, more in zip(first[size_of > 1].tolist(), size_of[size_of > 1].tolist()):
                added[of[a + low]] += part[low + 1:low + more].sum(axis=0)
    if not learn:
        return logs, None, None
    added *= weight[:, None, :]
    return logs, means, added


def output(weights, shape: Shape, states, classes, words, gradient=None):
    """Natural log probability of each token; with ``gradient``, adds that of their sum.

    ``words`` is the head word of a token, or -1 in a tail class. Returns the log
    probabilities and, with ``gradient``, the gradient for the states.
    """
    size, learn, count, head = shape.state, gradient is not None, len(states), shape.head_bounds[-1]
    # By class and, within it, by word: the head words of a class follow one another.
    order = np.argsort(_narrow(np.where(words >= 0, words, head + classes), head + shape.classes), kind="stable")
    classes, words = classes[order], words[order]
    rows = np.zeros((-(-count // CLASS_TILE) * CLASS_TILE, size + 1), np.float32)
    rows[:count, :size] = states[order]
    rows[:count, size] = 1
    states = rows[:count, :size]
    own = weights["to_class"].T[classes]
    logs, means, added = _softmax(
        rows.reshape(-1, CLASS_TILE, size + 1), np.zeros(len(rows) // CLASS_TILE, np.intp),
        np.ascontiguousarray(weights["to_class"].T)[None], weights["class_bias"][None], learn,
    )
    found = np.einsum("ij,ij->i", states, own) + weights["class_bias"][classes] - logs.ravel()[:count]
    if learn:
        first = _first(classes)
        met = np.add.reduceat(rows[:count], first)
        gradient["to_class"] -= added[0, :size]
        gradient["class_bias"] -= added[0, size]
        gradient["to_class"][:, classes[first]] += met[:, :size].T
        gradient["class_bias"][classes[first]] += met[:, size]
        back = own - means.reshape(-1, size)[:count]

    inside = int(np.count_nonzero(words >= 0))
    if inside:
        kinds, words = classes[:inside], words[:inside]
        bounds = np.searchsorted(kinds, np.arange(len(shape.head_bounds)))
        tiles = -(-np.diff(bounds) // WORD_TILE)
        of = np.repeat(np.arange(len(tiles)), tiles)
        # Each class begins a tile of its own.
        slot = np.arange(inside) + ((np.cumsum(tiles) - tiles) * WORD_TILE - bounds[:-1])[kinds]
        tiled = np.zeros((len(of) * WORD_TILE, size + 1), np.float32)
        tiled[slot] = rows[:inside]
        widths = np.diff(shape.head_bounds)
        width = int(widths.max())
        place = np.arange(head) + np.repeat(np.arange(len(widths)) * width - shape.head_bounds[:-1], widths)
        matrix = np.zeros((len(widths) * width, size), np.float32)
        matrix[place] = weights["to_word"]
        bias = np.full(len(widths) * width, -np.inf, np.float32)
        bias[place] = weights["word_bias"]
        own = weights["to_word"][words]
        logs, means, added = _softmax(
            tiled.reshape(-1, WORD_TILE, size + 1), of,
            matrix.reshape(-1, width, size), bias.reshape(-1, width), learn,
        )
        found[:inside] += np.einsum("ij,ij->i", states[:inside], own) + weights["word_bias"][words] - logs.ravel()[slot]
        if learn:
            first = _first(words)
            met = np.add.reduceat(rows[:inside], first)
            added = added.transpose(0, 2, 1).reshape(-1, size + 1)[place]
            gradient["to_word"] -= added[:, :size]
            gradient["word_bias"] -= added[:, size]
            gradient["to_word"][words[first]] += met[:, :size]
            gradient["word_bias"][words[first]] += met[:, size]
            back[:inside] += own - means.reshape(-1, size)[slot]

    logs = np.empty(count, np.float64)
    logs[order] = found
    if not learn:
        return logs, None
    turned = np.empty_like(back)
    turned[order] = back
    return logs, turned


def window_gradient(weights, shape: Shape, state, inputs, starts, classes, words, live, gradient):
    """Truncated back-propagation over one window of steps x lanes.

    The gradient of the mean log probability is added to the parts that ``gradient`` has.
    ``live`` masks tokens that exist. Returns the log sum, the state, and the inputs whose
    gates have a gradient, with that.
    """
    steps, lanes = inputs.shape
    size = shape.state
    before = np.empty((steps, size, lanes), np.float32)
    x = np.ascontiguousarray(weights["gates"][inputs].transpose(0, 2, 1))
    h = np.empty_like(x)
    state = np.ascontiguousarray(state.T)
    begins = starts.any(axis=1)
    for t in range(steps):
        if begins[t]:
            state = np.where(starts[t], np.float32(0), state)
        before[t] = state
        state = _step(weights, state, x[t], h[t])
    keep, reset, new, h_new = x[:, :size], x[:, size:2 * size], x[:, 2 * size:], h[:, 2 * size:]
    scale = np.float32(1 / max(1, live.sum()))
    part = {n: np.zeros_like(weights[n]) for n in ("to_class", "class_bias", "to_word", "word_bias")}
    found, back = output(weights, shape, before.transpose(0, 2, 1)[live], classes[live], words[live], part)
    for name, value in part.items():
        gradient[name] += value * scale
    into = np.zeros((steps, lanes, size), np.float32)
    into[live] = back * scale
    into = np.ascontiguousarray(into.transpose(0, 2, 1))
    gates = np.empty((steps, 3 * size, lanes), np.float32)
    through = np.empty((steps, 3 * size, lanes), np.float32)
    later = np.zeros((size, lanes), np.float32)
    rest = 1 - keep
    to_keep = before - new
    to_keep *= keep
    to_keep *= rest
    to_new = new * new
    np.subtract(1, to_new, out=to_new)
    to_new *= rest
    to_reset = 1 - reset
    to_reset *= reset
    to_reset *= h_new
    for t in range(steps - 1, -1, -1):
        here, back_h = gates[t], through[t]
        np.multiply(later, to_keep[t], out=here[:size])
        np.multiply(later, to_new[t], out=here[2 * size:])
        np.multiply(here[2 * size:], to_reset[t], out=here[size:2 * size])
        back_h[:2 * size] = here[:2 * size]
        np.multiply(here[2 * size:], reset[t], out=back_h[2 * size:])
        later *= keep[t]
        later += weights["again"] @ back_h
        later += into[t]
        if begins[t]:
            later[:, starts[t]] = 0
    gradient["again"] += (before @ through.transpose(0, 2, 1)).sum(axis=0)
    flat = inputs.ravel()
    order = np.argsort(_narrow(flat, shape.inputs), kind="stable")
    flat = flat[order]
    first = _first(flat)
    values = np.add.reduceat(gates.transpose(0, 2, 1).reshape(-1, 3 * size)[order], first)
    if "gates" in gradient:
        gradient["gates"][flat[first]] += values
    return float(found.sum()), np.ascontiguousarray(state.T), flat[first], values


class Trainer:
    """Adagrad over windows, from given weights."""

    def __init__(self, vector: np.ndarray, shape: Shape, rate: float = RATE):
        self.vector, self.shape, self.rate = vector.copy(), shape, rate
        self.weights = split(self.vector, shape)
        self.squares = np.full(len(vector), 1e-6, np.float32)
        self.gate_squares = split(self.squares, shape)["gates"]
        self.gradient = np.zeros_like(self.vector)
        self.parts = {n: part for n, part in split(self.gradient, shape).items() if n != "gates"}
        self.tokens = 0

    def window(self, state, inputs, starts, classes, words, live):
        total, state, met, some = window_gradient(
            self.weights, self.shape, state, inputs, starts, classes, words, live, self.parts
        )
        # All other gates have no gradient and stay as they are.
        after = self.gate_squares.size
        rest = self.gradient[after:]
        norm = float(np.sqrt(some.ravel() @ some.ravel() + rest @ rest))
        if norm > CLIP:
            some *= np.float32(CLIP / norm)
            rest *= np.float32(CLIP / norm)
        squares = self.gate_squares[met] + some * some
        self.gate_squares[met] = squares
        some *= np.float32(self.rate)
        some /= np.sqrt(squares, out=squares)
        self.weights["gates"][met] += some
        squares = rest * rest
        self.squares[after:] += squares
        rest *= np.float32(self.rate)
        rest /= np.sqrt(self.squares[after:], out=squares)
        self.vector[after:] += rest
        rest[:] = 0
        self.tokens += int(live.sum())
        return total, state


def lanes_of(lengths: np.ndarray, count: int) -> list[list[int]]:
    """Deal documents to lanes, the longest first and each to the shortest lane; longest lane first."""
    import heapq

    count = max(1, min(count, len(lengths)))
    heap = [(0, i, []) for i in range(count)]
    for doc in np.argsort(-lengths, kind="stable").tolist():
        total, i, docs = heap[0]
        docs.append(doc)
        heapq.heapreplace(heap, (total + int(lengths[doc]), i, docs))
    return [docs for _, _, docs in sorted(heap, key=lambda x: (-x[0], x[1])) if docs]


def in_lanes(offsets: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each lane's tokens lie: positions (steps x lanes, -1 beyond a lane's end), and starts."""
    lengths = np.diff(offsets)
    lanes = [np.concatenate([np.arange(offsets[d], offsets[d + 1]) for d in docs])
             for docs in lanes_of(lengths, count)]
    places = np.full((max(map(len, lanes), default=0), len(lanes)), -1, np.int32)
    for i, lane in enumerate(lanes):
        places[:len(lane), i] = lane
    first = np.zeros(int(offsets[-1]) + 1, bool)
    first[offsets[:-1]] = True
    return places, first[places] & (places >= 0)


def windows(places: np.ndarray, starts: np.ndarray, steps: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Windows of steps over the lanes that are not over yet (lanes come longest first)."""
    for a in range(0, len(places), steps):
        lanes = int((places[a] >= 0).sum())
        yield places[a:a + steps, :lanes], starts[a:a + steps, :lanes]


def train(trainer: Trainer, offsets, inputs, classes, words, lanes: int, steps: int) -> None:
    places, starts = in_lanes(offsets, lanes)
    state = np.zeros((places.shape[1], trainer.shape.state), np.float32)
    for place, start in windows(places, starts, steps):
        at = np.maximum(place, 0)
        _, state = trainer.window(state[:place.shape[1]], inputs[at], start, classes[at], words[at], place >= 0)


def score(weights, shape: Shape, offsets, inputs, classes, words, lanes: int, steps: int) -> np.ndarray:
    """Natural log probability of every token, each document read from its beginning."""
    found = np.zeros(int(offsets[-1]), np.float64)
    places, starts = in_lanes(offsets, lanes)
    state = np.zeros((shape.state, places.shape[1]), np.float32)
    # States wait for those of later windows, which have few lanes where a document is long.
    states, where, waiting = [], [], 0

    def put() -> None:
        at = np.concatenate(where)
        found[at] = output(weights, shape, np.concatenate(states), classes[at], words[at])[0]

    for place, start in windows(places, starts, steps):
        state = np.ascontiguousarray(state[:, :place.shape[1]])
        before = np.empty((len(place), *state.shape), np.float32)
        x = np.ascontiguousarray(weights["gates"][inputs[np.maximum(place, 0)]].transpose(0, 2, 1))
        h = np.empty(x.shape[1:], np.float32)
        begins = start.any(axis=1)
        for t in range(len(place)):
            if begins[t]:
                state = np.where(start[t], np.float32(0), state)
            before[t] = state
            state = _step(weights, state, x[t], h)
        live = place >= 0
        states.append(before.transpose(0, 2, 1)[live])
        where.append(place[live])
        waiting += len(where[-1])
        if waiting >= SCORE_TOKENS:
            put()
            states, where, waiting = [], [], 0
    if waiting:
        put()
    return found

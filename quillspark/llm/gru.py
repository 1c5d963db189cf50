"""A gated recurrent language model in numpy: truncated backpropagation, a softmax over classes and one within the class.

Symbols are 0 (any rarer word), 1 (the end of a text) and the modelled words from 2 on, the most frequent
first; one more symbol stands for the beginning. Classes are stretches of symbols of about equal
frequency, so a token costs as many outputs as there are classes and words in its class.

States and gates are kept as (state, lane), so that every step works on long rows. Texts are laid end to end in lanes of about equal length, the longest first, and lanes run side by side
in windows of WINDOW steps. State goes from window to window, gradients do not; a text begins with no state.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

RARE, END = 0, 1
HIDDEN, WINDOW, LANES = 16, 32, 512
#: Tokens of a stretch that is learnt from in one lane; longer texts are several, so that no lane is left alone.
STRETCH = 1024
#: Rate of the updates, and the bound of a gradient's entries, of means over the tokens of a full window.
RATE, CLIP = 0.03, 1.0
#: Rows of outputs that are worked on at once, so that their logits stay in a core's cache.
ROWS = 2048
#: How far logits may lie below their bound for a sum of exponentials in 32 bits to need no maximum by row.
SAFE = 60.0
#: Sum of squared gradients before the first.
FIRST_SQUARE = 1e-9
F32 = np.float32


def classes_of(counts: np.ndarray, n_classes: int) -> np.ndarray:
    """First symbol of each class, and the number of symbols at the end; the first two symbols are classes of their own."""
    words = counts[2:].astype(np.float64) + 1
    mass = np.cumsum(words)
    of = np.minimum((mass - words / 2) / max(mass[-1], 1) * n_classes, n_classes - 1).astype(np.int64) if len(words) else np.empty(0, dtype=np.int64)
    first = np.flatnonzero(np.r_[True, of[1:] != of[:-1]]) if len(of) else np.empty(0, dtype=np.int64)
    return np.r_[0, 1, first + 2, len(counts)]


@dataclass
class Model:
    """Parameters, and the sums of squared gradients by which updates shrink."""

    starts: np.ndarray
    arrays: dict[str, np.ndarray]
    squares: dict[str, np.ndarray]

    @classmethod
    def new(cls, counts: np.ndarray, n_classes: int, hidden: int = HIDDEN, seed: int = 7) -> Model:
        """A model that gives each symbol its frequency, whatever came before."""
        rng = np.random.default_rng(seed)
        starts, n = classes_of(counts, n_classes), len(counts)
        own = np.log(counts + 1.0)
        mass = np.array([np.logaddexp.reduce(own[i:j]) for i, j in zip(starts[:-1], starts[1:])])
        arrays = {
            "inputs": rng.normal(0, 0.3, (n + 1, 3 * hidden)),
            "state": rng.normal(0, 0.5 / np.sqrt(hidden), (hidden, 3 * hidden)),
            "classes": np.zeros((hidden, len(starts) - 1)),
            "class_bias": mass - np.logaddexp.reduce(mass),
            "words": rng.normal(0, 0.01, (n, hidden)),
            "word_bias": own,
        }
        arrays = {k: v.astype(F32) for k, v in arrays.items()}
        return cls(starts, arrays, {k: np.full_like(v, FIRST_SQUARE) for k, v in arrays.items()})

    def class_of(self) -> np.ndarray:
        """The class of each symbol."""
        return np.repeat(np.arange(len(self.starts) - 1, dtype=np.int16), np.diff(self.starts))

    def flat(self) -> np.ndarray:
        return np.concatenate([*(a.reshape(-1) for a in self.arrays.values()), *(a.reshape(-1) for a in self.squares.values())])

    def filled(self, flat: np.ndarray) -> Model:
        """A model of this shape with the values of flat()."""
        at, sets = 0, []
        for some in (self.arrays, self.squares):
            sets.append({})
            for k, v in some.items():
                sets[-1][k] = flat[at : at + v.size].reshape(v.shape).astype(F32)
                at += v.size
        return Model(self.starts, *sets)


@dataclass
class Lanes:
    """Texts in lanes: what goes in and what should come out (-1 behind the end), and where each text lies."""

    given: np.ndarray
    wanted: np.ndarray
    lengths: np.ndarray
    lane: np.ndarray
    start: np.ndarray


def lanes_of(texts: list[np.ndarray], begin: int) -> Lanes:
    """texts, symbols that end with END, in as many lanes as there are texts, at most LANES."""
    size = np.array([len(t) for t in texts])
    n = max(1, min(LANES, len(texts)))
    load = np.zeros(n, dtype=np.int64)
    lane, start = np.empty(len(texts), dtype=np.int64), np.empty(len(texts), dtype=np.int64)
    for k in np.argsort(-size, kind="stable").tolist():
        to = int(load.argmin())
        lane[k], start[k] = to, load[to]
        load[to] += size[k]
    order = np.argsort(-load, kind="stable")
    place = np.empty(n, dtype=np.int64)
    place[order] = np.arange(n)
    lane = place[lane]
    load = load[order]
    given, wanted = np.full((int(load.max()), n), begin, dtype=np.int32), np.full((int(load.max()), n), -1, dtype=np.int32)
    for k, t in enumerate(texts):
        i, j = start[k], start[k] + len(t)
        wanted[i:j, lane[k]] = t
        given[i + 1 : j, lane[k]] = t[:-1]
    return Lanes(given, wanted, load, lane, start)


def _forward(a: dict[str, np.ndarray], given: np.ndarray, h: np.ndarray, begin: int, keep_all: bool):
    """States after each step, and for learning what they were made of."""
    steps, n = given.shape
    width = len(h)
    # Gates take half of what goes in: the logistic function by the hyperbolic tangent, which cannot overflow.
    half = np.repeat(np.array([0.5, 1], dtype=F32), [2 * width, width])
    x = np.ascontiguousarray((a["inputs"] * half).take(given, axis=0).transpose(0, 2, 1))
    turned = np.ascontiguousarray((a["state"] * half).T)
    hs = np.empty((steps + 1, width, n), dtype=F32)
    hs[0] = h
    kept = np.empty((steps, 4 * width, n), dtype=F32) if keep_all else None
    room = np.empty((4 * width, n), dtype=F32)
    goes_on = given != begin
    stops = ~goes_on.all(axis=1)
    for t in range(steps):
        before = hs[t] * goes_on[t] if stops[t] else hs[t]
        g = kept[t] if keep_all else room
        np.matmul(turned, before, out=g[: 3 * width])
        gates, gn, new = g[: 2 * width], g[2 * width : 3 * width], g[3 * width :]
        gates += x[t, : 2 * width]
        np.tanh(gates, out=gates)
        gates += 1
        gates *= 0.5
        np.multiply(gates[width:], gn, out=new)
        new += x[t, 2 * width :]
        np.tanh(new, out=new)
        out = hs[t + 1]
        np.subtract(before, new, out=out)
        out *= gates[:width]
        out += new
    return hs, kept


def _shares(rows, weights, at, bound, scale=None):
    """Log of the share that each row gives to its entry at `at`; with scale, gradients of their sum times -scale, by rows and by weights.

    The last column of rows is 1, the last row of weights their bias. bound is at least every logit; rows need no maximum
    of their own unless that lies far below. The exponentials are the only pass over the logits: rows are scaled instead.
    """
    logits = rows @ weights
    if bound > SAFE:
        logits -= logits.max(axis=1, keepdims=True)
    flat, place = logits.reshape(-1), np.arange(len(at)) * logits.shape[1] + at
    picked = flat[place]
    np.exp(logits, out=logits)
    total = logits @ np.ones(logits.shape[1], dtype=F32)
    out = picked - np.log(total)
    if scale is None:
        return out, None, None
    flat[place] -= total
    by = (scale / total)[:, None]
    return out, (logits @ weights[:-1].T) * by, (rows * by).T @ logits


def _span(weights: np.ndarray) -> float:
    """A bound of the size of logits, states lying between -1 and 1."""
    return float(np.abs(weights).sum(axis=0).max())


def _outputs(a, starts, of, h, wanted, grads=None, scale=1.0):
    """Log probabilities of wanted after states h (row by row); with grads, gradients of their sum times -scale, and that by h."""
    width = h.shape[1]
    order = np.argsort(of[wanted], kind="stable")
    wanted = wanted[order]
    c = of[wanted]
    rows = np.ones((len(h), width + 1), dtype=F32)
    rows[:, :width] = h[order]
    scale = None if grads is None else F32(scale)
    out, back = np.empty(len(h), dtype=F32), None if grads is None else np.empty((len(h), width), dtype=F32)

    weights = np.vstack([a["classes"], a["class_bias"]])
    span = _span(weights)
    for i in range(0, len(h), ROWS):
        some = slice(i, i + ROWS)
        out[some], by_rows, by_weights = _shares(rows[some], weights, c[some], span, scale)
        if grads is not None:
            back[some] = by_rows
            grads["classes"] += by_weights[:-1]
            grads["class_bias"] += by_weights[-1]

    weights = np.vstack([a["words"].T, a["word_bias"]])
    span = _span(weights)
    cut = np.searchsorted(c, np.arange(len(starts)))
    for k in np.flatnonzero((np.diff(cut) > 0) & (np.diff(starts) > 1)).tolist():
        some, i, j = slice(cut[k], cut[k + 1]), starts[k], starts[k + 1]
        share, by_rows, by_weights = _shares(rows[some], weights[:, i:j], wanted[some] - i, span, scale)
        out[some] += share
        if grads is not None:
            back[some] += by_rows
            grads["words"][i:j] += by_weights[:-1].T
            grads["word_bias"][i:j] += by_weights[-1]

    # Back to the order that was given.
    placed = np.empty_like(out)
    placed[order] = out
    if grads is not None:
        back_placed = np.empty_like(back)
        back_placed[order] = back
        back = back_placed
    return placed, back


def scores(model: Model, texts: list[np.ndarray]) -> np.ndarray:
    """The natural log probability of each text, over its whole length."""
    if not texts:
        return np.empty(0)
    a, begin = model.arrays, len(model.arrays["inputs"]) - 1
    lanes, of = lanes_of(texts, begin), model.class_of()
    steps, n = lanes.given.shape
    got = np.zeros((steps, n), dtype=F32)
    h = np.zeros((a["state"].shape[0], n), dtype=F32)
    t = 0
    while t < steps:
        n = int((lanes.lengths > t).sum())
        # Where few lanes are left, a window is longer: its outputs are as many.
        to = t + WINDOW * max(1, LANES // n)
        given, wanted = lanes.given[t:to, :n], lanes.wanted[t:to, :n]
        hs, _ = _forward(a, given, h[:, :n], begin, False)
        on = wanted >= 0
        part = got[t:to, :n]
        part[on] = _outputs(a, model.starts, of, hs[1:].transpose(0, 2, 1)[on], wanted[on])[0]
        h, t = hs[-1], to
    # From lane to lane, so each text is one stretch.
    flat = got.T.reshape(-1).astype(np.float64)
    sums = np.r_[0.0, np.cumsum(flat)]
    at = lanes.lane * steps + lanes.start
    return sums[at + [len(t) for t in texts]] - sums[at]


def learn(model: Model, texts: list[np.ndarray], rate: float = RATE) -> int:
    """One pass of updates over texts, in place; the number of tokens. Long texts are learnt in stretches, each from no state."""
    texts = [t[k : k + STRETCH] for t in texts for k in range(0, len(t), STRETCH)]
    if not texts:
        return 0
    a, begin = model.arrays, len(model.arrays["inputs"]) - 1
    width = a["state"].shape[0]
    lanes, of = lanes_of(texts, begin), model.class_of()
    h = np.zeros((width, lanes.given.shape[1]), dtype=F32)
    # Means are of full windows: where few lanes are left, they count for little.
    scale = F32(1 / (h.shape[1] * WINDOW))
    grads = {k: np.zeros_like(v) for k, v in a.items() if k != "inputs"}
    for t in range(0, len(lanes.given), WINDOW):
        n = int((lanes.lengths > t).sum())
        given, wanted = lanes.given[t : t + WINDOW, :n], lanes.wanted[t : t + WINDOW, :n]
        hs, kept = _forward(a, given, h[:, :n], begin, True)
        on = wanted >= 0
        for g in grads.values():
            g[...] = 0
        _, back = _outputs(a, model.starts, of, hs[1:].transpose(0, 2, 1)[on], wanted[on], grads, scale)
        dh = np.zeros((*wanted.shape, width), dtype=F32)
        dh[on] = back
        by_input = _backward(a, given, hs, kept, np.ascontiguousarray(dh.transpose(0, 2, 1)), begin, grads)
        _update(model, grads, rate)
        _update_rows(model, given.reshape(-1), by_input.reshape(3 * width, -1).T, rate)
        h = hs[-1]
    return int(lanes.lengths.sum())


def _backward(a, given, hs, kept, dh, begin, grads):
    """Gradients through a window's steps, that by the state's matrix added to grads; those by the inputs, as (input, step, lane)."""
    steps, width, n = dh.shape
    # What goes to the new state by way of the old one, to both gates, and to the new state; the state's matrix in that order.
    out = np.empty((4 * width, steps, n), dtype=F32)
    to_old, to_gates, to_new = out[:width], out[width : 3 * width], out[3 * width :]
    state = np.roll(a["state"], width, axis=1)
    goes_on = given != begin
    before = hs[:-1] * goes_on[:, None]
    carried = np.zeros((width, n), dtype=F32)
    for t in range(steps - 1, -1, -1):
        d = dh[t]
        d += carried
        gates, gn, new = kept[t, : 2 * width], kept[t, 2 * width : 3 * width], kept[t, 3 * width :]
        slope = 1 - gates
        by_new = d * slope[:width]
        by_new *= 1 - new * new
        to_new[:, t] = by_new
        slope *= gates
        np.subtract(before[t], new, out=new)
        new *= d
        np.multiply(new, slope[:width], out=to_gates[:width, t])
        gn *= by_new
        np.multiply(gn, slope[width:], out=to_gates[width:, t])
        np.multiply(by_new, gates[width:], out=to_old[:, t])
        carried = state @ out[: 3 * width, t]
        d *= gates[:width]
        carried += d
        carried *= goes_on[t]
    by_state = out[: 3 * width].reshape(3 * width, -1) @ before.transpose(0, 2, 1).reshape(-1, width)
    grads["state"] += np.roll(by_state.T, -width, axis=1)
    return out[width:]


def _update(model: Model, grads: dict[str, np.ndarray], rate: float) -> None:
    for k, g in grads.items():
        np.clip(g, -CLIP, CLIP, out=g)
        model.squares[k] += g * g
        model.arrays[k] -= rate * g / np.sqrt(model.squares[k])


def _update_rows(model: Model, rows: np.ndarray, grads: np.ndarray, rate: float) -> None:
    """Updates of those inputs that a window had."""
    at = np.flatnonzero(np.bincount(rows))
    g = np.stack([np.bincount(rows, weights=column)[at] for column in grads.T], axis=1)
    g = np.clip(g, -CLIP, CLIP).astype(F32)
    model.squares["inputs"][at] += g * g
    model.arrays["inputs"][at] -= rate * g / np.sqrt(model.squares["inputs"][at])

"""A small gated recurrent language model in numpy with a class-factored output softmax.

Tokens are numbered: 0 ends a text, 1 to K-1 are the known words by falling frequency, K is
any other word. The probability of a known token is that of its class of ``CLASS_SIZE``
neighbours in that order times its own within the class; K is a class by itself. A text
starts from a zero state with the end token as input. Texts of a group are run side by side
in windows; the state goes on from one window to the next, gradients do not.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np

CLASS_SIZE = 64
WINDOW = 32


@dataclass
class Model:
    """table: input to the three gates (update, reset, candidate); state: state to gates;
    class_*: state to classes; word_*: state to the words of each class."""

    table: np.ndarray
    state: np.ndarray
    class_w: np.ndarray
    class_b: np.ndarray
    word_w: np.ndarray
    word_b: np.ndarray

    def arrays(self) -> list[np.ndarray]:
        return [self.table, self.state, self.class_w, self.class_b, self.word_w, self.word_b]

    def flat(self) -> np.ndarray:
        return np.concatenate([a.ravel() for a in self.arrays()])

    @classmethod
    def of_flat(cls, flat: np.ndarray, hidden: int, known: int) -> Model:
        classes = known // CLASS_SIZE
        shapes = [
            (known + 1, 3 * hidden),
            (hidden, 3 * hidden),
            (hidden, classes + 1),
            (classes + 1,),
            (classes, hidden, CLASS_SIZE),
            (classes, CLASS_SIZE),
        ]
        parts, at = [], 0
        for shape in shapes:
            size = int(np.prod(shape))
            parts.append(flat[at : at + size].reshape(shape).astype(np.float32))
            at += size
        return cls(*parts)


def fresh(counts: np.ndarray, hidden: int, seed: int = 7) -> Model:
    """A model whose output is the unigram distribution; ``counts`` of tokens 0 to K."""
    known = len(counts) - 1
    classes = known // CLASS_SIZE
    draw = np.random.default_rng(seed)
    smooth = counts.astype(np.float64) + 0.5
    grouped = smooth[:known].reshape(classes, CLASS_SIZE)
    totals = np.append(grouped.sum(1), smooth[known])
    return Model(
        (draw.standard_normal((known + 1, 3 * hidden)) * 0.1).astype(np.float32),
        (draw.standard_normal((hidden, 3 * hidden)) / np.sqrt(hidden)).astype(np.float32),
        np.zeros((hidden, classes + 1), np.float32),
        np.log(totals / totals.sum()).astype(np.float32),
        np.zeros((classes, hidden, CLASS_SIZE), np.float32),
        np.log(grouped / grouped.sum(1, keepdims=True)).astype(np.float32),
    )


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return np.float32(0.5) * np.tanh(np.float32(0.5) * x) + np.float32(0.5)


@dataclass
class Pass:
    """What a window leaves for its gradient: rows are (step, text), step by step."""

    inputs: np.ndarray
    targets: np.ndarray
    active: list[int]
    before: list[np.ndarray] = field(default_factory=list)
    gates: list[tuple] = field(default_factory=list)
    states: list[np.ndarray] = field(default_factory=list)


def windows(tokens: np.ndarray, first: np.ndarray, size: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, list[int]]]:
    """(inputs, targets, texts active in each step) per window. ``size`` falls; a text's
    ``size`` targets are tokens[first:first+size], the last of them the end."""
    longest = int(size[0]) if len(size) else 0
    for start in range(0, longest, WINDOW):
        stop = min(start + WINDOW, longest)
        active = [int(np.searchsorted(-size, -t, side="left")) for t in range(start, stop)]
        at = np.concatenate([first[:a] + t for t, a in zip(range(start, stop), active)])
        if start:
            inputs = tokens[at - 1]
        else:
            inputs = tokens[np.maximum(at - 1, 0)]
            inputs[: active[0]] = 0
        yield inputs, tokens[at], active


def forward(model: Model, state: np.ndarray, inputs, targets, active: list[int], keep: bool) -> tuple[np.ndarray, Pass]:
    """Run one window; returns the state of the texts that were active in its last step first."""
    hidden = len(model.state)
    run = Pass(inputs, targets, active)
    drive = model.table[inputs]
    row = 0
    for a in active:
        g, h = drive[row : row + a], state[:a]
        row += a
        u = h @ model.state
        zr = _sigmoid(g[:, : 2 * hidden] + u[:, : 2 * hidden])
        z, r = zr[:, :hidden], zr[:, hidden:]
        back = u[:, 2 * hidden :]
        c = np.tanh(g[:, 2 * hidden :] + r * back)
        state = h + z * (c - h)
        run.states.append(state)
        if keep:
            run.before.append(h)
            run.gates.append((z, r, c, back))
    return state, run


def _log_softmax(x: np.ndarray) -> np.ndarray:
    x = x - x.max(1, keepdims=True)
    return x - np.log(np.exp(x).sum(1, keepdims=True))


def outputs(model: Model, run: Pass, grads: Model | None = None) -> tuple[np.ndarray, np.ndarray | None]:
    """Natural log probability of each target and, with ``grads``, the gradient of their
    negative sum by the states; output gradients are added to ``grads``."""
    h = np.concatenate(run.states)
    known = len(model.table) - 1
    group = np.where(run.targets == known, known // CLASS_SIZE, run.targets // CLASS_SIZE)
    rows = np.arange(len(h))
    by_class = _log_softmax(h @ model.class_w + model.class_b)
    log_p = by_class[rows, group].astype(np.float64)
    dh = None
    if grads is not None:
        d = np.exp(by_class)
        d[rows, group] -= 1.0
        grads.class_w += h.T @ d
        grads.class_b += d.sum(0)
        dh = d @ model.class_w.T
    order = np.argsort(group, kind="stable")
    edges = np.searchsorted(group[order], np.arange(known // CLASS_SIZE + 1))
    for k in range(known // CLASS_SIZE):
        pick = order[edges[k] : edges[k + 1]]
        if not len(pick):
            continue
        own = h[pick]
        by_word = _log_softmax(own @ model.word_w[k] + model.word_b[k])
        word = run.targets[pick] - k * CLASS_SIZE
        i = np.arange(len(pick))
        log_p[pick] += by_word[i, word]
        if grads is not None:
            d = np.exp(by_word)
            d[i, word] -= 1.0
            grads.word_w[k] += own.T @ d
            grads.word_b[k] += d.sum(0)
            dh[pick] += d @ model.word_w[k].T
    return log_p, dh


def backward(model: Model, run: Pass, dh_rows: np.ndarray, grads: Model) -> None:
    """Gradient through the steps of one window."""
    hidden = len(model.state)
    carry = np.zeros((0, hidden), np.float32)
    row = len(dh_rows)
    drive = np.empty((row, 3 * hidden), np.float32)
    for a, h, (z, r, c, back) in zip(reversed(run.active), reversed(run.before), reversed(run.gates)):
        dh = dh_rows[row - a : row].copy()
        dh[: len(carry)] += carry
        dc = dh * z * (1.0 - c * c)
        dz = dh * (c - h) * z * (1.0 - z)
        dr = dc * back * r * (1.0 - r)
        du = np.concatenate([dz, dr, dc * r], axis=1)
        drive[row - a : row] = np.concatenate([dz, dr, dc], axis=1)
        grads.state += h.T @ du
        carry = dh * (1.0 - z) + du @ model.state.T
        row -= a
    order = np.argsort(run.inputs, kind="stable")
    seen, starts = np.unique(run.inputs[order], return_index=True)
    grads.table[seen] += np.add.reduceat(drive[order], starts, axis=0)


def by_length(first: np.ndarray, size: np.ndarray, group: int) -> Iterator[np.ndarray]:
    """Row numbers in groups of texts of about the same length, the longest first."""
    order = np.argsort(-size, kind="stable")
    for at in range(0, len(order), group):
        yield order[at : at + group]


class Trainer:
    """Truncated back-propagation with per-coordinate rates (Adagrad)."""

    def __init__(self, model: Model, rate: float, group: int):
        self.model, self.rate, self.group = model, np.float32(rate), group
        self.squares = [np.full(a.shape, 1e-4, np.float32) for a in model.arrays()]
        self.tokens = 0

    def learn(self, tokens: np.ndarray, first: np.ndarray, size: np.ndarray) -> None:
        model = self.model
        for rows in by_length(first, size, self.group):
            state = np.zeros((len(rows), len(model.state)), np.float32)
            for inputs, targets, active in windows(tokens, first[rows], size[rows]):
                state, run = forward(model, state[: active[0]], inputs, targets, active, True)
                grads = Model(*(np.zeros_like(a) for a in model.arrays()))
                _, dh = outputs(model, run, grads)
                backward(model, run, dh, grads)
                scale = np.float32(1.0 / len(targets))
                for value, square, grad in zip(model.arrays(), self.squares, grads.arrays()):
                    grad *= scale
                    square += grad * grad
                    value -= self.rate * grad / np.sqrt(square)
                self.tokens += len(targets)


class Scorer:
    """Log probabilities only, without what gradients need: biases are rows of the weights,
    the halves of the logistic gates are in the weights, and sums are products with ones."""

    def __init__(self, model: Model):
        self.hidden = len(model.state)
        self.known = len(model.table) - 1
        half = np.repeat(np.array([0.5, 0.5, 1.0], np.float32), self.hidden)
        self.table, self.state = model.table * half, model.state * half
        self.class_w = np.vstack([model.class_w, model.class_b])
        self.word_w = np.concatenate([model.word_w, model.word_b[:, None, :]], axis=1)
        self.ones = np.ones(max(self.class_w.shape[1], CLASS_SIZE), np.float32)
        # states are within -1 and 1: how far can an output get from 0?
        reach = max(np.abs(self.class_w).sum(0).max(), np.abs(self.word_w).sum(1).max(initial=0.0))
        self.centre = bool(reach > 60.0)

    def _picked(self, h: np.ndarray, weights: np.ndarray, target: np.ndarray) -> np.ndarray:
        x = h @ weights
        if self.centre:
            x -= x.max(1, keepdims=True)
        own = x[np.arange(len(x)), target]
        np.exp(x, out=x)
        return own - np.log(x @ self.ones[: x.shape[1]])

    def window(self, state, inputs, targets, active: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """State after the window and the log probability of each target."""
        n, rows = self.hidden, len(inputs)
        drive = self.table[inputs]
        h1 = np.empty((rows, n + 1), np.float32)
        h1[:, n] = 1.0
        row = 0
        for a in active:
            g, h = drive[row : row + a], state[:a]
            u = h @ self.state
            gates = g[:, : 2 * n] + u[:, : 2 * n]
            np.tanh(gates, out=gates)
            gates += np.float32(1.0)
            gates *= np.float32(0.5)
            c = gates[:, n:] * u[:, 2 * n :]
            c += g[:, 2 * n :]
            np.tanh(c, out=c)
            c -= h
            c *= gates[:, :n]
            state = h1[row : row + a, :n]
            np.add(h, c, out=state)
            row += a
        group = targets // CLASS_SIZE  # the other words' class comes last, at known / CLASS_SIZE
        log_p = self._picked(h1, self.class_w, group)
        order = np.argsort(group.astype(np.int16), kind="stable")
        edges = np.searchsorted(group[order], np.arange(len(self.word_w) + 1))
        for k in range(len(self.word_w)):
            pick = order[edges[k] : edges[k + 1]]
            if len(pick):
                log_p[pick] += self._picked(h1[pick], self.word_w[k], targets[pick] - k * CLASS_SIZE)
        return state, log_p


def log_likelihood(model: Model, tokens: np.ndarray, first: np.ndarray, size: np.ndarray, group: int = 4096) -> np.ndarray:
    """Natural log probability of each whole text."""
    total = np.zeros(len(first))
    scorer = Scorer(model)
    for rows in by_length(first, size, group):
        state = np.zeros((len(rows), scorer.hidden), np.float32)
        for inputs, targets, active in windows(tokens, first[rows], size[rows]):
            state, log_p = scorer.window(state, inputs, targets, active)
            many = active[0]
            total[rows[:many]] += np.bincount(np.concatenate([np.arange(a) for a in active]), log_p, many)
    return total

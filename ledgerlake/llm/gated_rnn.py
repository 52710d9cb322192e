"""A gated recurrent language model in numpy with a class-factored output softmax.

Word ids below ``classes * size`` are modelled one by one: the probability of a word is
that of its class times that of the word in its class.  ``groups`` further ids stand for
groups of rarer words and are classes of one; what a word has within its group is the
caller's matter.  Training is truncated backpropagation through windows of steps; the
state is carried from window to window of a whole text, both in training and in scoring.

Arrays of a window are laid out (step, feature, text), so that a step's gates are a block of
memory; those of the output have a row for each token.  All work on a window goes into
buffers that are kept.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import prod

import numpy as np

WINDOW = 32
ROWS = 128
#: Windows' gradients are summed until they hold so many tokens, so that the rest of a long
#: text, with few others beside it, takes no steps of a few words each.
STEP_TOKENS = 2048
#: Numbers that a step of Adam moves together.
MOVED = 1 << 14
#: The bias of an id that no word has: no probability.
NEVER = -1e4


@dataclass(frozen=True)
class Shape:
    classes: int
    size: int
    groups: int
    hidden: int

    @property
    def words(self) -> int:
        return self.classes * self.size

    @property
    def ids(self) -> int:
        return self.words + self.groups

    def parts(self) -> dict[str, tuple[int, ...]]:
        h = self.hidden
        return {
            "x": (self.ids + 1, 3 * h),  # a row for each id, then one for the start of a text
            "u": (3 * h, h),
            "c": (h, self.classes + self.groups),
            "w": (self.classes, h, self.size),
            "cb": (self.classes + self.groups,),
            "wb": (self.classes, self.size),
        }

    @property
    def floats(self) -> int:
        return sum(int(np.prod(s)) for s in self.parts().values())

    @property
    def trained(self) -> int:
        """The leading numbers, which training changes: all but the biases, which hold frequencies."""
        return self.floats - self.classes - self.groups - self.words

    def views(self, flat: np.ndarray) -> dict[str, np.ndarray]:
        out, at = {}, 0
        for name, s in self.parts().items():
            n = int(np.prod(s))
            if at + n <= len(flat):
                out[name] = flat[at : at + n].reshape(s)
            at += n
        return out


def _log(x: np.ndarray) -> np.ndarray:
    return np.where(x > 0, np.log(np.where(x > 0, x, 1.0)), NEVER)


def start(shape: Shape, counts: np.ndarray, seed: int = 7) -> np.ndarray:
    """Weights whose output is about the frequency of each id (nothing where it is 0), whatever the state."""
    rng = np.random.default_rng(seed)
    flat = (rng.standard_normal(shape.floats) * 0.08).astype(np.float32)
    p = shape.views(flat)
    counts = np.asarray(counts, dtype=np.float64)
    by_class = counts[: shape.words].reshape(shape.classes, shape.size)
    sums = by_class.sum(axis=1)
    p["c"] *= 0.1
    p["w"] *= 0.1
    p["wb"][:] = _log(by_class / np.where(sums > 0, sums, 1.0)[:, None])
    total = np.concatenate([sums, counts[shape.words :]])
    p["cb"][:] = _log(total / max(total.sum(), 1.0))
    return flat


class Buffers:
    """Arrays by name, kept from window to window and cut to the size asked for."""

    def __init__(self, dtype=np.float32):
        self.dtype = dtype
        self.held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, *shape: int) -> np.ndarray:
        n = prod(shape)
        if name not in self.held or len(self.held[name]) < n:
            self.held[name] = np.empty(n, self.dtype)
        return self.held[name][:n].reshape(shape)


def run_window(shape: Shape, p: dict, inputs: np.ndarray, h: np.ndarray, buf: Buffers, carried: np.ndarray | None = None):
    """States after each step (steps, hidden, rows), those before, the gates z, r, n, and U h (z's and r's negated).

    Where ``carried`` (steps, rows) is 0 a text begins, with a state of zeros; without it none
    does, and only the states after are kept: the others are a step's, in memory near at hand.
    """
    k, (steps, rows) = shape.hidden, inputs.shape
    kept = 1 if carried is None else steps
    gates, inner, before = buf("gates", kept, 3 * k, rows), buf("inner", kept, 3 * k, rows), buf("before", kept, k, rows)
    states, some, read = buf("states", steps, k, rows), buf("some", k, rows), buf("read", rows, 3 * k)
    u = p["u"].copy()
    np.negative(u[: 2 * k], out=u[: 2 * k])
    for t in range(steps):
        at = t % kept
        if carried is not None:
            h = np.multiply(h, carried[t], out=before[at])
        np.take(p["x"], inputs[t], axis=0, out=read, mode="clip")
        g = np.matmul(u, h, out=inner[at])
        zr, n, new = gates[at, : 2 * k], gates[at, 2 * k :], states[t]
        np.copyto(n, read[:, 2 * k :].T)
        np.subtract(g[: 2 * k], read[:, : 2 * k].T, out=zr)
        np.exp(zr, out=zr)
        zr += 1.0
        np.reciprocal(zr, out=zr)
        np.multiply(zr[k:], g[2 * k :], out=some)
        n += some
        np.tanh(n, out=n)
        np.subtract(h, n, out=new)
        new *= zr[:k]
        new += n
        h = new
    return states, before, gates, inner


def _exp_sum(logits: np.ndarray, spots: np.ndarray, buf: Buffers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Exponentials (in place) of each row, their sums, and the log of the share at each row's spot (in the flat array).

    Rows are shifted before where they are large.
    """
    if logits.max(initial=0.0) > 60.0:
        logits -= logits.max(axis=1, keepdims=True)
    picked = logits.reshape(-1).take(spots)
    np.exp(logits, out=logits)
    ones = buf("ones", logits.shape[1])
    ones[:] = 1.0
    total = np.maximum(logits @ ones, 1e-37)
    return logits, total, picked - np.log(total)


def token_scores(shape: Shape, p: dict, states: np.ndarray, targets: np.ndarray, buf: Buffers, grads: dict | None = None):
    """Natural log probability of each target given the state (a row) before it.

    With ``grads`` the output weights' gradients of the summed log loss are added there,
    and the gradient of the states is returned too.
    """
    n, wide = len(targets), shape.classes + shape.groups
    cls = np.where(targets < shape.words, targets // shape.size, targets - shape.words + shape.classes)
    logits = np.matmul(states, p["c"], out=buf("class", n, wide))
    logits += p["cb"]
    spots = np.arange(0, n * wide, wide) + cls
    e, total, out = _exp_sum(logits, spots, buf)
    back = None
    if grads is not None:
        e *= (1.0 / total)[:, None]
        e.reshape(-1)[spots] -= 1.0
        grads["c"] += states.T @ e
        back = np.matmul(e, p["c"].T, out=buf("back", n, shape.hidden))
    # words sorted by class: each class is one product of matrices, the rest is done for all at once
    words = np.flatnonzero(targets < shape.words)
    words = words[np.argsort(cls[words].astype(np.int16), kind="stable")]
    m, own = len(words), cls[words]
    ends = np.searchsorted(own, np.arange(shape.classes + 1)).tolist()
    present = [(c, slice(ends[c], ends[c + 1])) for c in range(shape.classes) if ends[c] < ends[c + 1]]
    some = np.take(states, words, axis=0, out=buf("some_states", m, shape.hidden), mode="clip")
    logits = buf("word", m, shape.size)
    for c, part in present:
        np.matmul(some[part], p["w"][c], out=logits[part])
    logits += np.take(p["wb"], own, axis=0, out=buf("bias", m, shape.size), mode="clip")
    spots = np.arange(0, m * shape.size, shape.size) + targets[words] % shape.size
    e, total, within = _exp_sum(logits, spots, buf)
    out[words] += within
    if grads is not None:
        e *= (1.0 / total)[:, None]
        e.reshape(-1)[spots] -= 1.0
        below, made = buf("below", m + 1, shape.hidden), buf("made", shape.classes, shape.hidden, shape.size)
        if len(present) < shape.classes:
            made[:] = 0.0
        for c, part in present:
            np.matmul(some[part].T, e[part], out=made[c])
            np.matmul(e[part], p["w"][c].T, out=below[part])
        grads["w"] += made
        # the last row is for the targets that are no words
        below[m] = 0.0
        place = np.full(n, m)
        place[words] = np.arange(m)
        back += np.take(below, place, axis=0, out=buf("spread", n, shape.hidden), mode="clip")
    return out, back


def _layout(texts: list[np.ndarray], window: int) -> Iterator[np.ndarray]:
    """The ids (rows still running, steps) of each window, for texts sorted from long to short.

    Past the end of a text the ids are -1.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    every = np.concatenate([*texts, np.empty(0, np.int64)])
    ends = np.cumsum(sizes)[:, None]
    for at in range(0, int(sizes[0]) if len(sizes) else 0, window):
        rows = int(np.searchsorted(-sizes, -at, side="left"))
        place = (ends - sizes[:, None])[:rows] + np.arange(at, min(at + window, int(sizes[0])))
        yield np.where(place < ends[:rows], np.take(every, place, mode="clip"), -1)


def _inputs(shape: Shape, last: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each step reads, (steps, rows), and the last id of each row for the next window."""
    shown = np.where(ids < 0, shape.ids, ids)
    return np.ascontiguousarray(np.concatenate([last[:, None], shown[:, :-1]], axis=1).T), shown[:, -1]


def _live(states: np.ndarray, ids: np.ndarray, buf: Buffers) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The states of steps that have a target as rows, their places, and the targets."""
    steps, k, rows = states.shape
    flat, targets = buf("rows", steps, rows, k), ids.T.reshape(-1)
    np.copyto(flat, states.transpose(0, 2, 1))
    flat = flat.reshape(-1, k)
    live = np.flatnonzero(targets >= 0)
    if len(live) == len(targets):
        return flat, live, targets
    return np.take(flat, live, axis=0, out=buf("live", len(live), k), mode="clip"), live, targets[live]


def score_texts(shape: Shape, flat: np.ndarray, texts: list[np.ndarray], window: int = WINDOW) -> np.ndarray:
    """Log10 probability of each whole text (its ids, the end among them)."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    sorted_texts = [texts[k] for k in order]
    p, buf = shape.views(flat), Buffers(flat.dtype)
    total = np.zeros(len(texts))
    h = np.zeros((shape.hidden, len(texts)), flat.dtype)
    last = np.full(len(texts), shape.ids, np.int64)  # the start of a text
    with np.errstate(over="ignore"):
        for ids in _layout(sorted_texts, window):
            rows = len(ids)
            inputs, shown = _inputs(shape, last[:rows], ids)
            # a state is scored against the id that follows it
            states, _, _, _ = run_window(shape, p, inputs, h[:, :rows], buf)
            h, last = states[-1].copy(), shown
            columns, live, targets = _live(states, ids, buf)
            got, _ = token_scores(shape, p, columns, targets, buf)
            total[:rows] += np.bincount(live % rows, weights=got, minlength=rows)
    out = np.empty(len(texts))
    out[order] = total / np.log(10.0)
    return out


class Trainer:
    """Adam over truncated windows of parallel texts.

    A row of the input weights and its moments move when the row has been read.
    """

    def __init__(self, shape: Shape, flat: np.ndarray, rate: float):
        self.shape, self.rate, self.flat = shape, rate, flat.copy()
        self.p, self.buf = shape.views(self.flat), Buffers(flat.dtype)
        self.first, self.second, self.grad = (np.zeros(shape.trained, flat.dtype) for _ in range(3))
        self.g = shape.views(self.grad)
        self.read = np.zeros(shape.ids + 1, bool)
        self.steps = self.tokens = self.pending = 0

    def fit(self, texts: Iterable[np.ndarray], rows: int = ROWS, window: int = WINDOW) -> None:
        """One pass: ``rows`` texts run side by side, the next one beginning where one ends."""
        shape, k = self.shape, self.shape.hidden
        source = iter(texts)
        slots: list[np.ndarray] = [np.empty(0, np.int64)] * rows
        at = [0] * rows
        h = np.zeros((k, rows), self.flat.dtype)
        last = np.full(rows, shape.ids, np.int64)
        with np.errstate(over="ignore"):
            while True:
                shown, starts = [], []
                for s in range(len(slots)):
                    some = slots[s][at[s] : at[s] + window]
                    at[s] += window
                    if len(some) < window:  # the text ends: others follow within the window
                        parts, t = [some], len(some)
                        while t < window:
                            slots[s], at[s] = next(source, slots[s][:0]), window - t
                            if not len(slots[s]):
                                parts.append(np.full(window - t, -1, np.int64))
                                break
                            starts.append(s * window + t)
                            parts.append(slots[s][: window - t])
                            t += len(parts[-1])
                        some = np.concatenate(parts)
                    shown.append(some)
                ids = np.concatenate(shown).reshape(-1, window)
                inputs = np.concatenate([last[:, None], ids[:, :-1]], axis=1)
                inputs[ids < 0] = shape.ids
                last = ids[:, -1]
                carried = np.ones(ids.shape, self.flat.dtype)
                inputs.reshape(-1)[starts], carried.reshape(-1)[starts] = shape.ids, 0.0
                busy = np.flatnonzero(ids[:, 0] >= 0)
                if not len(busy):
                    break
                if len(busy) < len(slots):  # no text is left for the others
                    slots, at, h, last = [slots[s] for s in busy], [at[s] for s in busy], h[:, busy], last[busy]
                    ids, inputs, carried = ids[busy], inputs[busy], carried[busy]
                h = self._step(*(np.ascontiguousarray(x.T) for x in (inputs, ids, carried)), h)
            self._update()

    def _step(self, inputs: np.ndarray, ids: np.ndarray, carried: np.ndarray, h0: np.ndarray) -> np.ndarray:
        """Add one window's gradients, all (steps, rows); returns the states after it."""
        shape, p, g, buf, k = self.shape, self.p, self.g, self.buf, self.shape.hidden
        states, before, gates, inner = run_window(shape, p, inputs, h0, buf, carried)
        steps, rows = inputs.shape
        columns, live, targets = _live(states, ids.T, buf)
        _, back = token_scores(shape, p, columns, targets, buf, g)
        if len(live) < steps * rows:
            down = buf("down", steps * rows, k)
            down[:] = 0.0
            down[live] = back
        else:
            down = back
        down_t = buf("down_t", steps, k, rows)
        np.copyto(down_t, down.reshape(steps, rows, k).transpose(0, 2, 1))
        z, r, n = gates[:, :k], gates[:, k : 2 * k], gates[:, 2 * k :]
        # what the gradient of a state is multiplied by, for all steps at once
        keep = np.subtract(1.0, z, out=buf("keep", steps, k, rows))
        to_z = np.subtract(before, n, out=buf("to_z", steps, k, rows))
        to_z *= z
        to_z *= keep
        to_n = np.multiply(n, n, out=buf("to_n", steps, k, rows))
        np.subtract(1.0, to_n, out=to_n)
        to_n *= keep
        to_r = np.subtract(1.0, r, out=keep)
        to_r *= r
        to_r *= inner[:, 2 * k :]
        d, dn = buf("d", steps, 3 * k, rows), buf("dn", steps, k, rows)
        cut = (carried == 0.0).any(axis=1)
        dh, some, ut = np.zeros((k, rows), h0.dtype), buf("some", k, rows), np.ascontiguousarray(p["u"].T)
        for t in range(steps - 1, -1, -1):
            dh += down_t[t]
            np.multiply(dh, to_z[t], out=d[t, :k])
            m = np.multiply(dh, to_n[t], out=dn[t])
            np.multiply(m, to_r[t], out=d[t, k : 2 * k])
            np.multiply(m, r[t], out=d[t, 2 * k :])
            dh *= z[t]
            np.matmul(ut, d[t], out=some)
            dh += some
            if cut[t]:
                dh *= carried[t]
        # one row for each feature over the whole window
        flat = buf("flat", 3 * k, steps, rows)
        np.copyto(flat, d.transpose(1, 0, 2))
        held = buf("held", k, steps, rows)
        np.copyto(held, before.transpose(1, 0, 2))
        flat = flat.reshape(3 * k, -1)
        g["u"] += flat @ held.reshape(k, -1).T
        np.copyto(flat[2 * k :].reshape(k, steps, rows), dn.transpose(1, 0, 2))
        read = inputs.reshape(-1)
        now = np.zeros(len(self.read), bool)
        now[read] = True
        found = np.flatnonzero(now)
        place = (np.cumsum(now) - 1)[read]
        sums = buf("sums", len(found), 3 * k)
        for f, row in enumerate(flat):
            sums[:, f] = np.bincount(place, weights=row)
        g["x"][found] += sums
        self.read |= now
        self.pending += len(live)
        self.tokens += len(live)
        h = states[-1].copy()
        if self.pending >= STEP_TOKENS:
            self._update()
        return h

    def _update(self) -> None:
        """One step of Adam by the mean gradient of the tokens since the last."""
        if not self.pending:
            return
        self.steps += 1
        pace = self.rate * (1.0 - 0.999**self.steps) ** 0.5 / (1.0 - 0.9**self.steps)
        # the input weights lie first: of these only the rows read; all in parts that stay near at hand
        wide, buf = self.p["x"].size, self.buf
        every = (self.flat[: self.shape.trained], self.first, self.second, self.grad)
        tables = [a[:wide].reshape(self.p["x"].shape) for a in every]
        rows, many = np.flatnonzero(self.read), max(MOVED // tables[0].shape[1], 1)
        for k in range(0, len(rows), many):
            some = rows[k : k + many]
            parts = [
                np.take(a, some, axis=0, out=buf(f"moved_{j}", len(some), a.shape[1]), mode="clip")
                for j, a in enumerate(tables)
            ]
            self._move(*parts, pace)
            for a, moved in zip(tables[:3], parts):
                a[some] = moved
            tables[3][some] = 0.0
        for k in range(wide, len(self.grad), MOVED):
            self._move(*(a[k : k + MOVED] for a in every), pace)
        self.grad[wide:] = 0.0
        self.read[:] = False
        self.pending = 0

    def _move(self, flat: np.ndarray, first: np.ndarray, second: np.ndarray, grad: np.ndarray, pace: float) -> None:
        some = self.buf("move", *grad.shape)
        grad *= 1.0 / self.pending
        first *= 0.9
        first += np.multiply(grad, 0.1, out=some)
        second *= 0.999
        grad *= grad
        grad *= 0.001
        second += grad
        np.sqrt(second, out=grad)
        grad += 1e-7
        np.divide(first, grad, out=grad)
        grad *= pace
        flat -= grad

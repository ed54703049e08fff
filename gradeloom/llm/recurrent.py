"""A gated recurrent language model over word ids, in numpy.

The output is factored: P(id) = P(class | state) * P(id | class, state). Ids are numbered by
falling frequency and classes are runs of ids. Id 0 ends a document and stands before its
first word; the state is zero there.

Documents are strung on lanes that advance side by side, a window of steps at a time; the
state of a lane goes from window to window, the gradient stops at a window's begin. Arrays
are laid out as features x lanes, so that numpy's loops run over lanes.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np

END = 0
HIDDEN = 8
LANES = 512
#: Ids of a window; with few lanes it has more steps.
WINDOW = 8192
RATE = 0.1
#: Start of the sums of squared gradients; keeps the first steps small.
SQUARES = 1e-3
#: Factor on mean gradients; beyond 1 they are cut.
GAIN = 30
HALF = np.float32(0.5)

Parameters = dict[str, np.ndarray]


@dataclass(frozen=True)
class Shape:
    """Number of ids, and where each class begins (ascending, with the number of ids at the end)."""

    edges: tuple[int, ...]
    hidden: int = HIDDEN

    @property
    def n_ids(self) -> int:
        return self.edges[-1]

    def sizes(self) -> dict[str, tuple[int, ...]]:
        h, n, c = self.hidden, self.n_ids, len(self.edges) - 1
        return {"inputs": (3 * h, n), "state": (3 * h, h), "class_w": (c, h), "class_b": (c, 1), "id_w": (n, h), "id_b": (n, 1)}


def class_edges(counts: np.ndarray) -> tuple[int, ...]:
    """Runs of ids with about equal sums of square roots of counts, as many as the root of the number of ids."""
    n = len(counts)
    sums = np.cumsum(np.sqrt(counts))
    wanted = int(np.ceil(np.sqrt(n)))
    cuts = np.searchsorted(sums, sums[-1] * np.arange(1, wanted) / wanted, "right")
    return tuple(int(e) for e in np.unique([0, *cuts, n]))


def start(shape: Shape, counts: np.ndarray, seed: int = 7) -> Parameters:
    """Small random weights; the biases make the untrained model the unigram model of ``counts``."""
    rng = np.random.default_rng(seed)
    made = {name: rng.normal(0, 0.1, size).astype(np.float32) for name, size in shape.sizes().items()}
    made["state"] = rng.normal(0, 0.3, shape.sizes()["state"]).astype(np.float32)
    made["class_w"][:] = 0
    made["id_w"][:] = 0
    mass = np.add.reduceat(counts, shape.edges[:-1])
    made["class_b"][:, 0] = np.log(mass / mass.sum())
    of = np.repeat(mass, np.diff(shape.edges))
    made["id_b"][:, 0] = np.log(counts / of)
    return made


def flat(parameters: Parameters) -> np.ndarray:
    return np.concatenate([parameters[k].ravel() for k in sorted(parameters)])


def unflat(values: np.ndarray, shape: Shape) -> Parameters:
    out, at = {}, 0
    for name, size in sorted(shape.sizes().items()):
        n = int(np.prod(size))
        out[name] = values[at : at + n].reshape(size).astype(np.float32)
        at += n
    return out


@dataclass
class Window:
    """``x`` before, ``y`` now: ids of shape (steps, lanes); ``valid`` where a lane still runs; ``doc`` of each."""

    x: np.ndarray
    y: np.ndarray
    doc: np.ndarray
    valid: np.ndarray


def windows(docs: list[np.ndarray], lanes: int = LANES, size: int = WINDOW) -> Iterator[Window]:
    """All ids of all documents, each with its end, once; lanes that are done leave from the right."""
    lengths = np.array([len(d) + 1 for d in docs], np.int64)
    heap = [(0, lane, []) for lane in range(min(lanes, len(docs)))]
    for k in np.argsort(-lengths, kind="stable").tolist():
        load, lane, own = heap[0]
        own.append(k)
        heapq.heapreplace(heap, (load + int(lengths[k]), lane, own))
    heap.sort(key=lambda lane: -lane[0])
    order = [k for _, _, own in heap for k in own]
    if not order:
        return
    end = np.array([END], np.int16)
    y = np.concatenate([v for k in order for v in (docs[k], end)]).astype(np.int64)
    doc = np.repeat(np.array(order), lengths[order])
    loads = np.array([load for load, _, _ in heap])
    begins = np.cumsum(loads) - loads
    x = np.concatenate([[END], y[:-1]])  # an end stands before every document
    t = 0
    while t < loads[0]:
        active = int(np.searchsorted(-loads, -t, "left"))
        steps = min(max(1, size // active), int(loads[0]) - t)
        at = t + np.arange(steps)[:, None]
        valid = at < loads[:active]
        where = np.minimum(begins[:active] + at, len(y) - 1)
        yield Window(x[where], y[where], doc[where], valid)
        t += steps


def _forward(p: Parameters, w: Window, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """States after each step (steps, hidden, lanes), and what a gradient needs.

    Of a long document few lanes are left, and what a step takes is calls, not numbers: the loop holds
    only what needs the state before.
    """
    steps, lanes = w.x.shape
    size = len(h)
    # the logistic function as a hyperbolic tangent of halves
    half = np.repeat(np.float32([0.5, 1]), [2 * size, size])[:, None]
    gates = np.take(p["inputs"] * half, w.x, axis=1).swapaxes(0, 1)  # steps, 3 * hidden, lanes
    state = p["state"] * half
    keep = (w.x != END).astype(np.float32)
    whole = keep.all(axis=1).tolist()
    states, sums = np.empty((steps, size, lanes), np.float32), np.empty((steps, 3 * size, lanes), np.float32)
    views = (gates[:, : 2 * size], gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :])
    each = zip(whole, keep, *views, sums, sums[:, : 2 * size], sums[:, 2 * size :], states)
    for unbroken, kept, rz, r, z, new, a, a_rz, a_new, after in each:
        if not unbroken:
            h = h * kept
        np.matmul(state, h, out=a)
        rz += a_rz
        np.tanh(rz, out=rz)
        rz *= HALF
        rz += HALF
        new += r * a_new
        np.tanh(new, out=new)
        np.subtract(h, new, out=after)
        after *= z
        after += new
        h = after
    return states, sums[:, 2 * size :], gates  # gates hold r, z and the new state now


def _columns(values: np.ndarray) -> np.ndarray:
    """(steps, features, lanes) as (features, steps * lanes)."""
    return values.swapaxes(0, 1).reshape(values.shape[1], -1)


class Scorer:
    """Log probabilities of ids under states (columns), class by class."""

    def __init__(self, p: Parameters, shape: Shape):
        self.p, self.edges = p, np.array(shape.edges)
        self.class_of = np.repeat(np.arange(len(shape.edges) - 1, dtype=np.int16), np.diff(self.edges))

    def __call__(self, states: np.ndarray, ids: np.ndarray, gradient: bool = False):
        """Natural logarithms; with ``gradient`` also the gradients of minus their sum."""
        p = self.p
        order = np.argsort(self.class_of[ids], kind="stable")
        states, ids = np.take(states, order, axis=1), ids[order]
        classes = self.class_of[ids]
        columns = np.arange(len(ids))
        bounds = np.searchsorted(classes, np.arange(len(self.edges)))
        grads = {}

        def layer(own: np.ndarray, weights: np.ndarray, bias: np.ndarray, target: np.ndarray):
            logits = weights @ own
            logits += bias
            logits -= logits.max(axis=0)
            at = columns[: len(target)]
            chosen = logits[target, at]
            np.exp(logits, out=logits)
            total = logits.sum(axis=0)
            chosen -= np.log(total)
            if gradient:
                logits /= total
                logits[target, at] -= 1
                return chosen, weights.T @ logits, logits @ own.T, logits.sum(axis=1, keepdims=True)
            return chosen, None, None, None

        found, d_states, grads["class_w"], grads["class_b"] = layer(states, p["class_w"], p["class_b"], classes)
        if gradient:
            grads["id_w"], grads["id_b"] = np.zeros_like(p["id_w"]), np.zeros_like(p["id_b"])
        for c in np.flatnonzero((np.diff(bounds) > 0) & (np.diff(self.edges) > 1)).tolist():
            mine, own = slice(bounds[c], bounds[c + 1]), slice(self.edges[c], self.edges[c + 1])
            more, d_own, d_w, d_b = layer(states[:, mine], p["id_w"][own], p["id_b"][own], ids[mine] - self.edges[c])
            found[mine] += more
            if gradient:
                d_states[:, mine] += d_own
                grads["id_w"][own], grads["id_b"][own] = d_w, d_b
        back = np.empty_like(order)
        back[order] = columns
        return (found[back], np.take(d_states, back, axis=1), grads) if gradient else found[back]


def document_scores(docs: list[np.ndarray], p: Parameters, shape: Shape, lanes: int = LANES, size: int = WINDOW) -> np.ndarray:
    """The natural logarithm of every whole document's probability, its end included."""
    out = np.zeros(len(docs))
    scorer = Scorer(p, shape)
    h = np.zeros((shape.hidden, min(lanes, len(docs))), np.float32)
    for w in windows(docs, lanes, size):
        states, *_ = _forward(p, w, h[:, : w.x.shape[1]])
        h = states[-1]
        valid = np.flatnonzero(w.valid)
        own = _columns(states)
        own = own if len(valid) == own.shape[1] else np.take(own, valid, axis=1)
        out += np.bincount(w.doc.ravel()[valid], scorer(own, w.y.ravel()[valid]), len(docs))
    return out


def gradients(p: Parameters, shape: Shape, w: Window, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, Parameters, np.ndarray]:
    """Log probabilities, the last state, gradients of minus their sum, and the ids whose inputs have one."""
    size = shape.hidden
    steps, lanes = w.x.shape
    states, inner, gates = _forward(p, w, h)
    valid = np.flatnonzero(w.valid)
    own = _columns(states)
    found, d_valid, grads = Scorer(p, shape)(np.take(own, valid, axis=1), w.y.ravel()[valid], gradient=True)
    d_own = np.zeros_like(own)
    d_own[:, valid] = d_valid
    keep = (w.x != END).astype(np.float32)
    whole = keep.all(axis=1).tolist()
    befores = np.concatenate([h[None], states[:-1]])
    befores *= keep[:, None]
    r, z, new = gates[:, :size], gates[:, size : 2 * size], gates[:, 2 * size :]
    d_news, d_sums = np.empty((steps, size, lanes), np.float32), np.empty((steps, 3 * size, lanes), np.float32)
    d_states = d_own.reshape(size, steps, lanes).swapaxes(0, 1)
    parts = (d_sums, d_sums[:, :size], d_sums[:, size : 2 * size], d_sums[:, 2 * size :])
    each = (keep, d_states, 1 - z, 1 - new * new, inner, r, 1 - r, z, befores - new, d_news, *parts)
    backwards = zip(reversed(whole), *(v[::-1] for v in each))
    carried = np.zeros((size, lanes), np.float32)
    back = np.ascontiguousarray(p["state"].T)
    for unbroken, kept, d_state, not_z, slope, inside, r_t, not_r, z_t, moved, d_new, d_all, d_r, d_z, d_inner in backwards:
        dh = d_state + carried
        np.multiply(dh, not_z, out=d_new)
        d_new *= slope
        np.multiply(d_new, inside, out=d_r)
        d_r *= r_t
        d_r *= not_r
        dh *= z_t
        np.multiply(dh, moved, out=d_z)
        d_z *= not_z
        np.multiply(d_new, r_t, out=d_inner)
        dh += back @ d_all
        if not unbroken:
            dh *= kept
        carried = dh
    grads["state"] = _columns(d_sums) @ _columns(befores).T
    d_gates = np.concatenate([_columns(d_sums[:, : 2 * size]), _columns(d_news)])
    x = w.x.ravel()
    order = np.argsort(x.astype(np.int16), kind="stable")
    sorted_x = x[order]
    begins = np.flatnonzero(np.diff(sorted_x, prepend=-1))
    grads["inputs"] = np.add.reduceat(np.take(d_gates, order, axis=1), begins, axis=1)
    return found, states[-1], grads, sorted_x[begins]


class Learner:
    """Gradient steps with rates by the sums of squared gradients, on copies of the parameters."""

    def __init__(self, p: Parameters, shape: Shape, rate: float = RATE, lanes: int = LANES, size: int = WINDOW):
        self.p = {k: v.copy() for k, v in p.items()}
        self.squares = {k: np.full_like(v, SQUARES) for k, v in p.items()}
        self.shape, self.rate, self.lanes, self.size = shape, rate, lanes, size
        self.n_tokens, self.log_sum = 0, 0.0

    def learn(self, docs: list[np.ndarray]) -> None:
        h = np.zeros((self.shape.hidden, min(self.lanes, len(docs))), np.float32)
        for w in windows(docs, self.lanes, self.size):
            found, h, grads, seen = gradients(self.p, self.shape, w, h[:, : w.x.shape[1]])
            self.n_tokens += len(found)
            self.log_sum += float(found.sum())
            for name, g in grads.items():
                own = (slice(None), seen) if name == "inputs" else slice(None)
                g *= np.float32(GAIN / len(found))
                np.clip(g, -1, 1, out=g)
                squares = self.squares[name][own] + g * g
                self.squares[name][own] = squares
                g *= self.rate
                g /= np.sqrt(squares)
                self.p[name][own] -= g

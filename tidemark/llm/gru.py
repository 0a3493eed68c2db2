"""A gated recurrent network with a class-factored softmax, in numpy: forward, truncated backpropagation, Adam.

Inputs are symbols; outputs are a class and, for classes with words of their own, a word in it. ``class_of`` and
``slot_of`` give both for each symbol (slot -1: the class has no words of its own).
"""

from __future__ import annotations

import numpy as np

HIDDEN, SLOTS = 16, 32


def initial(n_symbols: int, n_classes: int, n_full: int, seed: int = 7) -> dict[str, np.ndarray]:
    """Parameters; the first ``n_full`` classes have words."""
    draw = np.random.RandomState(seed)
    shapes = {
        "x": (n_symbols, 3 * HIDDEN),
        "u": (HIDDEN, 3 * HIDDEN),
        "c": (HIDDEN, n_classes),
        "cb": (n_classes,),
        "w": (n_full, HIDDEN, SLOTS),
        "wb": (n_full, SLOTS),
    }
    scale = {"x": 0.3, "u": 0.25, "c": 0.05, "w": 0.05}
    return {k: (draw.standard_normal(s) * scale.get(k, 0)).astype(np.float32) for k, s in shapes.items()}


def _sigmoid(x: np.ndarray) -> np.ndarray:
    np.negative(x, out=x)
    np.exp(x, out=x)
    x += 1
    return np.reciprocal(x, out=x)


def step(p: dict, symbols: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, ...]:
    """One step of all streams: the new state and what backpropagation needs."""
    x = p["x"][symbols]
    u = h @ p["u"]
    gates = _sigmoid(x[:, : 2 * HIDDEN] + u[:, : 2 * HIDDEN])
    r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
    un = u[:, 2 * HIDDEN :]
    n = np.tanh(x[:, 2 * HIDDEN :] + r * un)
    return n + z * (h - n), gates, n, un


def _weights(logits: np.ndarray) -> np.ndarray:
    """Softmax without its divisor."""
    np.clip(logits, -60, 60, out=logits)
    return np.exp(logits, out=logits)


def _runs(classes: np.ndarray, slots: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Targets in classes with words, by class, and where each class begins."""
    full = np.flatnonzero(slots >= 0)
    order = full[np.argsort(classes[full], kind="stable")]
    return order, np.searchsorted(classes[order], np.arange(n + 1))


def log_likelihood(p: dict, h: np.ndarray, classes: np.ndarray, slots: np.ndarray) -> np.ndarray:
    """Natural logarithm of the probability of each target, given the state before it."""
    e = _weights(h @ p["c"] + p["cb"])
    chance = e[np.arange(len(h)), classes] / e.sum(1)
    order, ends = _runs(classes, slots, len(p["w"]))
    states, place = h[order], slots[order]
    inside = np.empty(len(order), np.float32)
    for k in range(len(p["w"])):
        a, b = ends[k], ends[k + 1]
        if b > a:
            e = _weights(states[a:b] @ p["w"][k] + p["wb"][k])
            inside[a:b] = e[np.arange(b - a), place[a:b]] / e.sum(1)
    out = np.log(chance.astype(np.float64))
    out[order] += np.log(inside.astype(np.float64))
    return out


def gradient(p: dict, symbols: np.ndarray, classes: np.ndarray, slots: np.ndarray, live: np.ndarray, h: np.ndarray) -> tuple[dict, np.ndarray, float]:
    """Of a window (steps, streams): gradients of the mean loss, the state after it, and the sum of log-likelihoods.

    The state before a step predicts its targets; then the step reads its symbol. Streams that are not ``live`` count
    for nothing.
    """
    steps, streams = symbols.shape
    g = {k: np.zeros_like(v) for k, v in p.items()}
    states, kept = np.empty((steps, streams, HIDDEN), np.float32), []
    for t in range(steps):
        states[t] = h
        new, gates, n, un = step(p, symbols[t], h)
        kept.append((gates, n, un))
        h = new
    at = np.flatnonzero(live.ravel())
    if not len(at):
        return g, h, 0.0
    s, c, w = states.reshape(-1, HIDDEN)[at], classes.ravel()[at], slots.ravel()[at]
    scale = np.float32(1 / len(at))
    rows = np.arange(len(at))
    d = _weights(s @ p["c"] + p["cb"])
    d /= d.sum(1, keepdims=True)
    total = float(np.log(d[rows, c]).sum())
    d[rows, c] -= 1
    d *= scale
    g["c"], g["cb"] = s.T @ d, d.sum(0)
    ds = d @ p["c"].T
    order, ends = _runs(c, w, len(p["w"]))
    states_in, place, ds_in = s[order], w[order], np.empty((len(order), HIDDEN), np.float32)
    for k in range(len(p["w"])):
        a, b = ends[k], ends[k + 1]
        if b > a:
            d = _weights(states_in[a:b] @ p["w"][k] + p["wb"][k])
            d /= d.sum(1, keepdims=True)
            mine = np.arange(b - a)
            total += float(np.log(d[mine, place[a:b]]).sum())
            d[mine, place[a:b]] -= 1
            d *= scale
            g["w"][k], g["wb"][k] = states_in[a:b].T @ d, d.sum(0)
            ds_in[a:b] = d @ p["w"][k].T
    ds[order] += ds_in
    dstates = np.zeros((steps * streams, HIDDEN), np.float32)
    dstates[at] = ds
    dstates = dstates.reshape(steps, streams, HIDDEN)
    dx = np.empty((steps, streams, 3 * HIDDEN), np.float32)
    du = np.empty((streams, 3 * HIDDEN), np.float32)
    dh = np.zeros((streams, HIDDEN), np.float32)
    for t in range(steps - 1, -1, -1):
        gates, n, un = kept[t]
        r, z = gates[:, :HIDDEN], gates[:, HIDDEN:]
        dn = dh * (1 - z) * (1 - n * n)
        dgates = np.concatenate([dn * un, dh * (states[t] - n)], axis=1) * gates * (1 - gates)
        dx[t, :, : 2 * HIDDEN], dx[t, :, 2 * HIDDEN :] = dgates, dn
        du[:, : 2 * HIDDEN], du[:, 2 * HIDDEN :] = dgates, dn * r
        g["u"] += states[t].T @ du
        dh = dh * z + du @ p["u"].T + dstates[t]
    g["x"] = _by_symbol(symbols.ravel(), dx.reshape(-1, 3 * HIDDEN), len(p["x"]))
    return g, h, total


def _by_symbol(symbols: np.ndarray, rows: np.ndarray, n: int) -> np.ndarray:
    order = np.argsort(symbols, kind="stable")
    first = np.flatnonzero(np.append(True, np.diff(symbols[order]) != 0))
    out = np.zeros((n, rows.shape[1]), np.float32)
    out[symbols[order[first]]] = np.add.reduceat(rows[order], first, axis=0)
    return out


class Adam:
    """Adam (Kingma and Ba, 2015) with a norm limit for the gradient."""

    def __init__(self, p: dict, rate: float):
        self.rate, self.t = rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.v = {k: np.zeros_like(v) for k, v in p.items()}

    def update(self, p: dict, g: dict) -> None:
        self.t += 1
        norm = float(np.sqrt(sum(float((x * x).sum()) for x in g.values())))
        shrink = min(1.0, 1.0 / max(norm, 1e-12))
        rate = self.rate * np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k in p:
            x = g[k] * np.float32(shrink)
            self.m[k] += np.float32(0.1) * (x - self.m[k])
            self.v[k] += np.float32(0.001) * (x * x - self.v[k])
            p[k] -= np.float32(rate) * self.m[k] / (np.sqrt(self.v[k]) + np.float32(1e-6))

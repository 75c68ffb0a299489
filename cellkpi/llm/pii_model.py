"""Character tagger: a bidirectional LSTM under a CRF, in numpy.

Characters come as classes. Gates are piecewise linear (clipped), so a step is
a few passes over an array. Tags are O and one per kind; the CRF allows O to O,
O to a kind, a kind to itself and back to O.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np

HIDDEN = 8
FORBIDDEN = -1e4
PAD = 0


class Tagger(NamedTuple):
    wx: np.ndarray           # [2, classes, 4 * HIDDEN], one direction each
    u: np.ndarray            # [2, HIDDEN, 4 * HIDDEN]
    wo: np.ndarray           # [2 * HIDDEN, tags]
    bo: np.ndarray           # [tags]
    moves: np.ndarray        # [tags, tags]


def allowed(tags: int) -> np.ndarray:
    ok = np.eye(tags, dtype=bool)
    ok[0] = ok[:, 0] = True
    return ok


def new_tagger(classes: int, tags: int, seed: int) -> Tagger:
    rng = np.random.default_rng(seed)
    draw = lambda *shape: rng.normal(0, 0.3, shape)
    wx = draw(2, classes, 4 * HIDDEN)
    wx[:, :, HIDDEN:2 * HIDDEN] += 0.4                  # remember at first
    return Tagger(wx, draw(2, HIDDEN, 4 * HIDDEN), draw(2 * HIDDEN, tags), np.zeros(tags),
                  np.where(allowed(tags), 0.0, FORBIDDEN))


def _forward(x: np.ndarray, wx: np.ndarray, u: np.ndarray):
    """Hidden states [T, N, HIDDEN] and what the way back needs."""
    steps, n = x.shape
    h = c = np.zeros((n, HIDDEN))
    out, kept = np.zeros((steps, n, HIDDEN)), []
    for t in range(steps):
        z = wx[x[t]] + h @ u
        gate = np.clip(z[:, :3 * HIDDEN] + 0.5, 0, 1)
        i, f, o = gate[:, :HIDDEN], gate[:, HIDDEN:2 * HIDDEN], gate[:, 2 * HIDDEN:]
        g = np.clip(z[:, 3 * HIDDEN:], -1, 1)
        c2 = f * c + i * g
        m = np.clip(c2, -1, 1)
        kept.append((h, c, z, i, f, o, g, c2, m))
        h, c = o * m, c2
        out[t] = h
    return out, kept


def _backward(x: np.ndarray, wx: np.ndarray, u: np.ndarray, kept: list, dout: np.ndarray):
    dwx, du = np.zeros_like(wx), np.zeros_like(u)
    dh = dc = np.zeros(dout.shape[1:])
    eye = np.eye(len(wx))
    for t in range(len(x) - 1, -1, -1):
        h, c, z, i, f, o, g, c2, m = kept[t]
        dh = dh + dout[t]
        dc = dc + dh * o * (np.abs(c2) < 1)
        linear = np.abs(z[:, :3 * HIDDEN]) < 0.5
        dz = np.concatenate([np.concatenate([dc * g, dc * c, dh * m], 1) * linear,
                             dc * i * (np.abs(z[:, 3 * HIDDEN:]) < 1)], 1)
        dwx += eye[x[t]].T @ dz
        du += h.T @ dz
        dh, dc = dz @ u.T, dc * f
    return dwx, du


def _sum_exp(a: np.ndarray, axis: int) -> np.ndarray:
    top = a.max(axis=axis, keepdims=True)
    return np.squeeze(top, axis) + np.log(np.exp(a - top).sum(axis=axis))


def _crf(e: np.ndarray, moves: np.ndarray, y: np.ndarray):
    """Mean loss, gradient of the emissions and of the moves."""
    steps, n, tags = e.shape
    a, b = np.zeros_like(e), np.zeros_like(e)
    a[0] = e[0]
    for t in range(1, steps):
        a[t] = _sum_exp(a[t - 1][:, :, None] + moves, 1) + e[t]
    for t in range(steps - 2, -1, -1):
        b[t] = _sum_exp(moves + (e[t + 1] + b[t + 1])[:, None, :], 2)
    total = _sum_exp(a[-1], 1)
    de = np.exp(a + b - total[:, None])
    pairs = np.exp(a[:-1, :, :, None] + moves + (e[1:] + b[1:])[:, :, None, :] - total[:, None, None]).sum((0, 1))
    rows = np.arange(n)
    gold = sum(e[t, rows, y[t]] for t in range(steps)) + sum(moves[y[t - 1], y[t]] for t in range(1, steps))
    for t in range(steps):
        de[t, rows, y[t]] -= 1
    seen = np.zeros_like(moves)
    np.add.at(seen, (y[:-1].ravel(), y[1:].ravel()), 1)
    return float((total - gold).mean()), de / n, (pairs - seen) / n


def _slopes(m: Tagger, x: np.ndarray, y: np.ndarray):
    there, kept_there = _forward(x, m.wx[0], m.u[0])
    back, kept_back = _forward(x[::-1], m.wx[1], m.u[1])
    h = np.concatenate([there, back[::-1]], 2)
    loss, de, dmoves = _crf(h @ m.wo + m.bo, m.moves, y)
    dh = de @ m.wo.T
    ways = [_backward(x, m.wx[0], m.u[0], kept_there, dh[:, :, :HIDDEN]),
            _backward(x[::-1], m.wx[1], m.u[1], kept_back, dh[::-1, :, HIDDEN:])]
    grad = Tagger(np.stack([w[0] for w in ways]), np.stack([w[1] for w in ways]),
                  np.einsum("tnh,tnk->hk", h, de), de.sum((0, 1)), np.where(allowed(len(m.bo)), dmoves, 0.0))
    return loss, grad


def fit(x: np.ndarray, y: np.ndarray, classes: int, tags: int, rounds: int, batch: int, rate: float, seed: int) -> Tagger:
    """Adam on windows ``x`` (classes) with tags ``y``, both [windows, T]."""
    model, rng = new_tagger(classes, tags, seed), np.random.default_rng(seed)
    first, second = ([np.zeros_like(p) for p in model] for _ in range(2))
    for step in range(1, rounds + 1):
        pick = rng.integers(0, len(x), min(batch, len(x)))
        _, grad = _slopes(model, x[pick].T, y[pick].T)
        size = np.sqrt(sum((g ** 2).sum() for g in grad))
        now = rate * min(1.0, 2 - 2 * step / rounds)
        new = []
        for p, g, a, b in zip(model, grad, first, second, strict=True):
            g = g * min(1.0, 5 / max(size, 1e-9))
            a += 0.1 * (g - a)
            b += 0.01 * (g ** 2 - b)
            new.append(p - now * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.99 ** step)) + 1e-8))
        model = Tagger(*new)
    return model


class Decoder:
    """Best tags of many windows in step, single precision, classes first."""

    def __init__(self, m: Tagger):
        self.wx = [np.ascontiguousarray(w.T, np.float32) for w in m.wx]
        for w in self.wx:
            w[:3 * HIDDEN] += 0.5
        self.u = [np.ascontiguousarray(w.T, np.float32) for w in m.u]
        self.wo = [np.ascontiguousarray(w.T, np.float32) for w in (m.wo[:HIDDEN], m.wo[HIDDEN:])]
        self.bo, self.moves = m.bo.astype(np.float32)[:, None], m.moves.astype(np.float32)

    def _run(self, x: np.ndarray, way: int, out: np.ndarray) -> None:
        n = x.shape[1]
        h, c = np.zeros((HIDDEN, n), np.float32), np.zeros((HIDDEN, n), np.float32)
        z, seen, ig = np.empty((4 * HIDDEN, n), np.float32), np.empty((4 * HIDDEN, n), np.float32), np.empty_like(c)
        gates, g = z[:3 * HIDDEN], z[3 * HIDDEN:]
        i, f, o = z[:HIDDEN], z[HIDDEN:2 * HIDDEN], z[2 * HIDDEN:3 * HIDDEN]
        for t in range(len(x)) if way == 0 else range(len(x) - 1, -1, -1):
            np.take(self.wx[way], x[t], axis=1, out=seen, mode="clip")
            np.matmul(self.u[way], h, out=z)
            z += seen
            np.clip(gates, 0, 1, out=gates)
            np.clip(g, -1, 1, out=g)
            np.multiply(i, g, out=ig)
            c *= f
            c += ig
            np.clip(c, -1, 1, out=h)
            h *= o
            out[t] = self.wo[way] @ h if way == 0 else out[t] + self.wo[way] @ h

    def tags(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(columns of ``x`` [T, N] with a tag other than O, their tags [T, columns])."""
        steps, n = x.shape
        kinds = len(self.bo)
        e = np.empty((steps, kinds, n), np.float32)
        self._run(x, 0, e)
        self._run(x, 1, e)
        e += self.bo
        e[:, 1:] += np.float32(FORBIDDEN) * (x == PAD)[:, None]
        stay, leave = np.diag(self.moves)[1:, None], self.moves[1:, :1]
        enter, idle = self.moves[:1, 1:].T, self.moves[0, 0]
        from_o, to_o = np.zeros((steps, kinds - 1, n), bool), np.zeros((steps, n), np.int8)
        o, k, plain = e[0, 0].copy(), e[0, 1:].copy(), e[0, 0].copy()
        for t in range(1, steps):
            out = k + leave
            best = out.max(axis=0)
            o_next = o + idle
            plain = plain + idle + e[t, 0]
            came, went = o + enter, k + stay
            if (left := best > o_next).any():
                at = np.flatnonzero(left)
                to_o[t, at] = out[:, at].argmax(axis=0) + 1
                o_next[at] = best[at]
            np.greater(came, went, out=from_o[t])
            k = np.maximum(came, went) + e[t, 1:]
            o = o_next + e[t, 0]
        columns = np.flatnonzero(np.maximum(o, k.max(axis=0)) > plain)
        out = np.zeros((steps, len(columns)), np.int8)
        last = np.concatenate([o[None], k])[:, columns].argmax(axis=0)
        for t in range(steps - 1, -1, -1):
            out[t] = last
            if t:
                inside = last > 0
                enters = from_o[t][np.maximum(last - 1, 0), columns] & inside
                last = np.where(inside, np.where(enters, 0, last), to_o[t, columns])
        return columns, out

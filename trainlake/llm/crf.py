"""Binary linear-chain conditional random field on concatenated sequences.

A node's score for label 1 is given (label 0 scores 0); edges have a 2x2 table, starts a pair. Many sequences lie one
after the other in one array. Forward and backward passes are exact and run over blocks: the array is cut into columns,
the products of each column's 2x2 steps are built for all columns at once, chained, and the columns are run again from
their right entry. A sequence's first step forgets what came before it.
"""

from __future__ import annotations

import numpy as np

#: Nodes that are swept at once; bounds the memory of a long sequence.
BLOCK = 1 << 17


class Chain:
    def __init__(self, edges: np.ndarray | None = None, start: np.ndarray | None = None):
        self.edges = np.zeros((2, 2)) if edges is None else edges
        self.start = np.zeros(2) if start is None else start

    def _steps(self, scores: np.ndarray, first: np.ndarray) -> np.ndarray:
        """step[t, i, j]: potential of label j at t after label i at t-1, scaled."""
        s = np.clip(scores, -30, 30)
        top = np.maximum(s, 0)
        node = np.stack([np.exp(-top), np.exp(s - top)], 1)
        step = np.exp(self.edges)[None] * node[:, None, :]
        step[first] = (np.exp(self.start) * node[first])[:, None, :]
        return step

    @staticmethod
    def _sweep(step: np.ndarray, entry: tuple[float, float] = (0.5, 0.5)) -> np.ndarray:
        """Normalised v[t] = v[t-1] @ step[t] for all t, from v[-1] = entry."""
        n = len(step)
        rows = max(1, int(np.sqrt(n)))
        cols = -(-n // rows)
        full = np.zeros((cols * rows, 2, 2))
        full[:n] = step
        full[n:] = np.eye(2)
        m = np.ascontiguousarray(full.reshape(cols, rows, 2, 2).transpose(1, 2, 3, 0))
        a, b, c, d = np.ones(cols), np.zeros(cols), np.zeros(cols), np.ones(cols)
        for r in range(rows):
            p, q, s, t = m[r, 0, 0], m[r, 0, 1], m[r, 1, 0], m[r, 1, 1]
            a, b, c, d = a * p + b * s, a * q + b * t, c * p + d * s, c * q + d * t
            z = a + b + c + d
            a, b, c, d = a / z, b / z, c / z, d / z
        into = np.zeros((cols, 2))
        x, y = entry
        for k, (p, q, s, t) in enumerate(zip(a.tolist(), b.tolist(), c.tolist(), d.tolist())):
            into[k] = x, y
            x, y = x * p + y * s, x * q + y * t
            z = x + y
            x, y = x / z, y / z
        out = np.zeros((rows, 2, cols))
        x, y = into[:, 0], into[:, 1]
        for r in range(rows):
            x, y = x * m[r, 0, 0] + y * m[r, 1, 0], x * m[r, 0, 1] + y * m[r, 1, 1]
            z = x + y
            x, y = x / z, y / z
            out[r, 0], out[r, 1] = x, y
        return out.transpose(2, 0, 1).reshape(-1, 2)[:n]

    @classmethod
    def _backward(cls, step: np.ndarray, after: np.ndarray, entry: tuple[float, float]) -> np.ndarray:
        """Normalised beta[t] = step[t+1] @ beta[t+1]; step `after` follows the last one and has beta `entry`."""
        back = np.empty_like(step)
        back[0] = after.T
        back[1:] = step[:0:-1].transpose(0, 2, 1)
        return cls._sweep(back, entry)[::-1]

    def marginals(self, scores: np.ndarray, first: np.ndarray, pairs: bool = False):
        """P(label 1) of each node; with pairs also the expected label pairs of each step (none at starts).

        Without pairs, long arrays are swept block by block: backward first, keeping what enters each block, then forward."""
        n = len(scores)
        if not n:
            return (np.zeros(0), np.zeros((0, 2, 2))) if pairs else np.zeros(0)
        even, flat = (0.5, 0.5), np.ones((2, 2))
        if not pairs:
            edges = [*range(0, n, BLOCK), n]
            blocks = list(zip(edges, edges[1:]))
            enter, after = [(even, flat)], None
            for a, b in blocks[:0:-1]:
                step = self._steps(scores[a:b], first[a:b])
                beta, after = enter[-1]
                enter.append((tuple(self._backward(step, after, beta)[0].tolist()), step[0].copy()))
            p, alpha = np.zeros(n), even
            for (a, b), (beta, after) in zip(blocks, enter[::-1]):
                step = self._steps(scores[a:b], first[a:b])
                ahead = self._sweep(step, alpha)
                alpha = tuple(ahead[-1].tolist())
                both = ahead * self._backward(step, after, beta)
                p[a:b] = both[:, 1] / both.sum(1)
            return p
        step = self._steps(scores, first)
        alpha, beta = self._sweep(step), self._backward(step, flat, even)
        both = alpha * beta
        p = both[:, 1] / both.sum(1)
        joint = np.zeros((n, 2, 2))
        joint[1:] = alpha[:-1, :, None] * step[1:] * beta[1:, None, :]
        joint[first] = 0
        z = joint.sum((1, 2), keepdims=True)
        return p, np.divide(joint, z, out=joint, where=z > 0)


class Adagrad:
    def __init__(self, rate: float):
        self.rate, self.sums = rate, {}

    def step(self, name: str, value: np.ndarray, gradient: np.ndarray) -> None:
        s = self.sums.setdefault(name, np.full(value.shape, 1e-6))
        s += gradient**2
        value += self.rate * gradient / np.sqrt(s)


def fit(score, update, labels: np.ndarray, first: np.ndarray, batches: list[np.ndarray], epochs: int, rate: float = 0.3) -> Chain:
    """Maximum likelihood by Adagrad. score(rows) gives node scores; update(rows, residual, optimiser) moves the feature weights; batches hold whole sequences."""
    chain, ada = Chain(), Adagrad(rate)
    for _ in range(epochs):
        for rows in batches:
            y, f = labels[rows], first[rows]
            p, joint = chain.marginals(score(rows), f, pairs=True)
            n = len(rows)
            update(rows, (y - p) / n, ada)
            seen = np.zeros((2, 2))
            inner = np.flatnonzero(~f)
            np.add.at(seen, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
            ada.step("edges", chain.edges, (seen - joint.sum(0)) / n)
            starts = np.flatnonzero(f)
            one = np.array([(1 - y[starts]).sum() - (1 - p[starts]).sum(), y[starts].sum() - p[starts].sum()])
            ada.step("start", chain.start, one / n)
    return chain


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, weight: np.ndarray | None = None) -> np.ndarray:
    """Coefficients (intercept last) by Newton's method."""
    x = np.column_stack([x, np.ones(len(x))])
    w, r = np.zeros(x.shape[1]), np.ones(len(x)) if weight is None else weight
    for _ in range(25):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        g = x.T @ (r * (y - p)) - ridge * w
        h = (x * (r * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w))
        d = np.linalg.solve(h, g)
        w += d
        if np.abs(d).max() < 1e-6:
            break
    return w


def predict(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(np.column_stack([x, np.ones(len(x))]) @ w, -30, 30)))

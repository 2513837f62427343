"""Logistic regression on bounded samples, in numpy: rows of feature numbers."""

from __future__ import annotations

from itertools import pairwise

import numpy as np

#: Feature numbers that a product takes at once: its temporary arrays stay small beside the rows.
BLOCK = 1 << 17


class Rows:
    """A 0/1 matrix by rows: the feature numbers of row i are
    ``index[start[i]:start[i + 1]]``."""

    def __init__(self, rows: list[np.ndarray], width: int):
        self.width, self.n = width, len(rows)
        self.lengths = np.array([len(r) for r in rows], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.lengths)])
        self.index = np.concatenate(rows, dtype=np.int32, casting="unsafe") if rows else np.zeros(0, np.int32)
        cuts = np.searchsorted(self.start, np.arange(0, len(self.index), BLOCK))
        self.blocks = list(pairwise(np.unique(np.concatenate([[0], cuts, [self.n]])).tolist()))

    def dot(self, weights: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        for a, b in self.blocks:
            row = np.repeat(np.arange(b - a), self.lengths[a:b])
            out[a:b] = np.bincount(row, weights[self.index[self.start[a]:self.start[b]]], b - a)
        return out

    def back(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        for a, b in self.blocks:
            np.add.at(out, self.index[self.start[a]:self.start[b]].astype(np.int64), np.repeat(values[a:b], self.lengths[a:b]))
        return out


def sigmoid(z):
    return 1.0 / (1.0 + np.exp(-np.clip(z, -35.0, 35.0)))


def fit(rows: Rows, labels: np.ndarray, weights: np.ndarray | None = None, l2: float = 1.0,
        swaps: tuple[Rows, Rows, np.ndarray] | None = None, swap_penalty: float = 0.0, steps: int = 300,
        start: tuple[np.ndarray, float] | None = None) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise the mean log loss, ``l2`` / 2n times the squared
    weights and ``swap_penalty`` / n times the squared change of the score (log-odds)
    between the two rows of each pair of ``swaps`` (rows, rows, how often each pair stands):
    a pair weighs as much as a labelled row.  Full-batch Adam from ``start`` (zeros):
    deterministic."""
    (w, bias), n = (np.zeros(rows.width), 0.0) if start is None else start, max(1, rows.n)
    share = np.ones(rows.n) if weights is None else weights
    share = share / max(share.sum(), 1e-12)
    m, v = np.zeros(rows.width + 1), np.zeros(rows.width + 1)
    for step in range(1, steps + 1):
        error = (sigmoid(rows.dot(w) + bias) - labels) * share
        grad = rows.back(error) + l2 / n * w
        if swaps is not None and swaps[0].n:
            change = (swaps[1].dot(w) - swaps[0].dot(w)) * swaps[2]
            grad += 2 * swap_penalty / n * (swaps[1].back(change) - swaps[0].back(change))
        g = np.append(grad, error.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        delta = 0.1 * (m / (1 - 0.9 ** step)) / (np.sqrt(v / (1 - 0.999 ** step)) + 1e-10)
        if step > steps * 0.7:
            delta *= (steps - step + 1) / (steps * 0.3)
        w, bias = w - delta[:-1], bias - delta[-1]
    return w, float(bias)


def fit_scale(scores: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Coefficients (one per column of ``scores``, then the bias) of a logistic
    regression on few dense columns, by Newton's method with a weak prior at
    (1, .., 0)."""
    x = np.column_stack([scores, np.ones(len(scores))])
    prior = np.append(np.ones(x.shape[1] - 1), 0.0)

    def loss(c):
        z = x @ c
        return float((np.logaddexp(0.0, z) - labels * z).sum() + 0.5 * ((c - prior) ** 2).sum())
    c = prior.copy()
    for _ in range(50):
        p = sigmoid(x @ c)
        grad = x.T @ (p - labels) + (c - prior)
        hess = (x * (p * (1 - p))[:, None]).T @ x + np.eye(x.shape[1])
        step, now, size = np.linalg.solve(hess, grad), loss(c), 1.0
        while loss(c - size * step) > now and size > 1e-6:  # never uphill
            size /= 2
        c -= size * step
        if np.abs(step).max() < 1e-9:
            break
    return c

"""Multinomial logistic regression on sparse rows by follow-the-regularised-leader, with calibration."""

from __future__ import annotations

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # feature numbers, values


def softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


class Leader:
    """Per-coordinate step sizes; the L1 penalty keeps weights at zero until they earn it, the L2 shrinks them."""

    def __init__(self, features: int, classes: int, *, alpha: float = 1.0, beta: float = 1.0,
                 l1: float = 1e-3, l2: float = 1e-3):
        self.sums = np.zeros((features, classes))
        self.squares = np.zeros((features, classes))
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2

    def weights(self, at=slice(None)) -> np.ndarray:
        z = self.sums[at]
        shrunk = np.sign(z) * self.l1 - z
        return np.where(np.abs(z) <= self.l1, 0.0,
                        shrunk / ((self.beta + np.sqrt(self.squares[at])) / self.alpha + self.l2))

    def learn(self, row: Row, label: int) -> None:
        at, values = row
        w = self.weights(at)
        error = softmax(values @ w)
        error[label] -= 1
        slope = values[:, None] * error[None, :]
        n = self.squares[at]
        self.sums[at] += slope - (np.sqrt(n + slope ** 2) - np.sqrt(n)) / self.alpha * w
        self.squares[at] = n + slope ** 2


def fit(rows: list[Row], labels: list[int], features: int, classes: int, *, epochs: int = 3,
        held: float = 0.2, seed: int = 1, **penalties) -> tuple[np.ndarray, float]:
    """Weights and the temperature that calibrates them, found on ``held`` of the rows kept out of training."""
    order = np.random.default_rng(seed).permutation(len(rows))
    n_held = int(len(rows) * held)
    kept_out, training = order[:n_held], order[n_held:]
    leader = Leader(features, classes, **penalties)
    for _ in range(epochs):
        for k in training:
            leader.learn(rows[k], labels[k])
    weights = leader.weights()
    if not len(kept_out):
        return weights, 1.0
    raw = np.array([rows[k][1] @ weights[rows[k][0]] for k in kept_out])
    wanted = np.array([labels[k] for k in kept_out])
    # wanted probabilities a little below 1, or rows without an error would call for certainty
    goal = np.full(raw.shape, 1 / (len(wanted) + 2) / max(1, classes - 1))
    goal[np.arange(len(wanted)), wanted] = 1 - 1 / (len(wanted) + 2)
    grid = np.geomspace(0.02, 5.0, 60)
    loss = [-(goal * np.log(softmax(raw / t) + 1e-300)).sum(axis=1).mean() for t in grid]
    return weights, float(grid[int(np.argmin(loss))])

"""Follow-the-regularised-leader (proximal) with elastic-net penalties for
multinomial logistic regression over sparse rows, and temperature calibration.

The learner sees only a bounded sample; its memory is classes x features."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

Row = tuple[np.ndarray, np.ndarray]  # feature numbers and values


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


@dataclass
class Ftrl:
    """``l1`` keeps weights at exactly zero, ``l2`` shrinks the rest."""

    features: int
    classes: int
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 0.1
    l2: float = 0.1

    def __post_init__(self) -> None:
        self.z = np.zeros((self.features + 1, self.classes))
        self.n = np.zeros((self.features + 1, self.classes))

    def weights(self, at: np.ndarray) -> np.ndarray:
        z, n = self.z[at], self.n[at]
        l1 = np.where(at == self.features, 0.0, self.l1)[:, None]  # the bias is not penalised
        return np.where(np.abs(z) <= l1, 0.0, (np.sign(z) * l1 - z) / ((self.beta + np.sqrt(n)) / self.alpha + self.l2))

    def fit(self, rows: list[Row], labels: np.ndarray, epochs: int, seed: int = 1, weight: np.ndarray | None = None) -> Ftrl:
        order = np.random.default_rng(seed)
        bias = np.array([self.features])
        for _ in range(epochs):
            for i in order.permutation(len(rows)):
                at, x = np.append(rows[i][0], bias), np.append(rows[i][1], 1.0)
                w = self.weights(at)
                p = softmax(x @ w)
                p[labels[i]] -= 1.0
                g = x[:, None] * p * (1.0 if weight is None else weight[i])
                n = self.n[at]
                sigma = (np.sqrt(n + g * g) - np.sqrt(n)) / self.alpha
                self.z[at] += g - sigma * w
                self.n[at] = n + g * g
        return self

    def table(self) -> tuple[np.ndarray, np.ndarray]:
        """All weights (features x classes) and the bias."""
        w = self.weights(np.arange(self.features + 1))
        return w[:-1], w[-1]


def scores(rows: list[Row], weights: np.ndarray, bias: np.ndarray) -> np.ndarray:
    return np.array([x @ weights[at] + bias for at, x in rows]).reshape(len(rows), len(bias))


def temperature(logits: np.ndarray, labels: np.ndarray) -> float:
    """The divisor of the logits with the least held-out cross-entropy, from a
    fixed grid of 0.05 to 20."""
    if not len(labels):
        return 1.0
    grid = np.geomspace(0.05, 20, 61)
    loss = [-np.log(np.maximum(softmax(logits / t)[np.arange(len(labels)), labels], 1e-12)).mean() for t in grid]
    return float(grid[int(np.argmin(loss))])

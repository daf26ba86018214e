"""A small linear support vector machine, for training on bounded samples."""

from __future__ import annotations

import numpy as np


def train_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, passes: int = 12) -> np.ndarray:
    """Weights (with a bias last) of a linear L1-loss support vector machine: dual coordinate
    descent in a fixed shuffled order. y is +1 / -1; the two classes weigh the same in total."""
    n = len(x)
    x = np.hstack([x, np.ones((n, 1), x.dtype)]).astype(np.float64)
    bound = np.where(y > 0, cost * n / (2 * max((y > 0).sum(), 1)), cost * n / (2 * max((y < 0).sum(), 1)))
    diagonal = (x * x).sum(axis=1)
    weights, alpha = np.zeros(x.shape[1]), np.zeros(n)
    shuffle = np.random.Generator(np.random.PCG64(7))
    for _ in range(passes):
        for i in shuffle.permutation(n):
            step = y[i] * x[i].dot(weights) - 1
            new = min(max(alpha[i] - step / diagonal[i], 0.0), bound[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return weights

"""Small linear models fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np


def accelerated(gradient, step: float, start: np.ndarray, rounds: int, shrink=None, tolerance: float = 1e-7) -> np.ndarray:
    """Accelerated (proximal) gradient descent; ``shrink(w, step)`` is the proximal map of a penalty, if any."""
    w, ahead, t = start.copy(), start.copy(), 1.0
    for _ in range(rounds):
        new = ahead - step * gradient(ahead)
        if shrink is not None:
            new = shrink(new, step)
        t_new = (1 + np.sqrt(1 + 4 * t * t)) / 2
        ahead = new + (t - 1) / t_new * (new - w)
        moved = np.abs(new - w).max(initial=0.0)
        w, t = new, t_new
        if moved < tolerance:
            break
    return w


def largest_eigenvalue(x: np.ndarray, rounds: int = 30) -> float:
    """Of ``x.T @ x``, by power iteration."""
    v = np.ones(x.shape[1], x.dtype)
    value = 0.0
    for _ in range(rounds):
        v = x.T @ (x @ v)
        value = float(np.linalg.norm(v))
        if not value:
            return 0.0
        v /= value
    return value


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def linear_svm(x: np.ndarray, y: np.ndarray, penalty: float = 1e-4, rounds: int = 80) -> tuple[np.ndarray, float]:
    """Weights and intercept of an L2 support vector machine with squared hinge loss; ``y`` is -1 or 1.

    Both classes carry the same total weight."""
    n = len(y)
    weight = np.where(y > 0, 0.5 / max((y > 0).sum(), 1), 0.5 / max((y < 0).sum(), 1)).astype(x.dtype)
    xb = np.concatenate((x, np.ones((n, 1), x.dtype)), axis=1)

    def gradient(w):
        slack = np.maximum(0, 1 - y * (xb @ w))
        g = -2 * xb.T @ (weight * y * slack)
        g[:-1] += 2 * penalty * w[:-1]
        return g

    bound = 2 * largest_eigenvalue(np.sqrt(weight)[:, None] * xb) * 1.05 + 2 * penalty
    w = accelerated(gradient, 1.0 / bound, np.zeros(xb.shape[1], x.dtype), rounds)
    return w[:-1], float(w[-1])


def lasso_logistic(x: np.ndarray, y: np.ndarray, penalty: float, start: np.ndarray | None = None, rounds: int = 200,
                   weight: np.ndarray | None = None) -> np.ndarray:
    """Weights (the last one is the intercept, not penalised) of an L1-penalised logistic regression; ``y`` may be soft."""
    weight = np.full(len(y), 1.0 / max(len(y), 1)) if weight is None else weight / weight.sum()
    xb = np.concatenate((x, np.ones((len(y), 1), x.dtype)), axis=1)
    bound = 0.25 * largest_eigenvalue(np.sqrt(weight)[:, None] * xb) * 1.05 + 1e-12

    def shrink(w, step):
        out = np.sign(w) * np.maximum(np.abs(w) - step * penalty, 0)
        out[-1] = w[-1]
        return out

    return accelerated(lambda w: xb.T @ (weight * (sigmoid(xb @ w) - y)), 1.0 / bound,
                       np.zeros(xb.shape[1]) if start is None else start, rounds, shrink)

"""Logistic regression on bounded samples that have come to the driver."""

from __future__ import annotations

import numpy as np


def fit_logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1e-3, steps: int = 50) -> np.ndarray:
    """Weighted coefficients by damped Newton steps; columns are scaled for the ridge."""
    scale = np.maximum(np.abs(x).max(axis=0), 1e-9)
    x, w = x / scale, np.zeros(x.shape[1])

    def loss(w: np.ndarray) -> float:
        return weight @ np.logaddexp(0, np.where(y > 0, -1, 1) * (x @ w)) + ridge * w @ w / 2

    for _ in range(steps):
        p = probability(x @ w)
        gradient = x.T @ (weight * (p - y)) + ridge * w
        step = np.linalg.solve((x * (weight * p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(w)), gradient)
        size, now = 1.0, loss(w)
        while size > 1e-4 and loss(w - size * step) > now:
            size /= 2
        w = w - size * step
        if np.abs(size * step).max() < 1e-8:
            break
    return w / scale


def probability(logit: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(logit, -35, 35)))

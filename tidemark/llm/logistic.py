"""Logistic regression over sparse hashed features, with probability calibration."""

from __future__ import annotations

import numpy as np


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(x, -35, 35)))


def fit_sparse(
    doc: np.ndarray, feature: np.ndarray, value: np.ndarray, label: np.ndarray, size: int,
    steps: int = 80, rate: float = 0.5, decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and bias by Adam on the class-balanced log loss. Rows are (doc, feature, value)."""
    weights, bias = np.zeros(size), 0.0
    n = len(label)
    positives = label.sum()
    if not n or positives in (0, n):
        return weights, bias
    share = np.where(label == 1, 0.5 / positives, 0.5 / (n - positives))
    m, v = np.zeros(size + 1), np.zeros(size + 1)
    for step in range(1, steps + 1):
        score = np.bincount(doc, value * weights[feature], minlength=n) + bias
        error = (sigmoid(score) - label) * share
        grad = np.append(np.bincount(feature, value * error[doc], minlength=size) + decay * weights, error.sum())
        m = 0.9 * m + 0.1 * grad
        v = 0.99 * v + 0.01 * grad * grad
        move = rate * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        move *= 1.0 - step / (steps + 1)
        weights -= move[:-1]
        bias -= move[-1]
    return weights, float(bias)


def calibrate(score: np.ndarray, label: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and offset that turn scores into probabilities (Platt's method with its smoothed
    targets, by damped Newton steps). Without both labels: slope 1, offset 0."""
    positives, n = int(label.sum()), len(label)
    if positives in (0, n):
        return 1.0, 0.0
    target = np.where(label == 1, (positives + 1) / (positives + 2), 1 / (n - positives + 2))
    scale = max(float(score.std()), 1e-9)
    x = np.stack([score / scale, np.ones(n)])
    w = np.array([1.0, 0.0])
    for _ in range(steps):
        p = sigmoid(w @ x)
        grad = x @ (p - target) + 1e-4 * w
        hessian = (x * (p * (1 - p))) @ x.T + 1e-3 * np.eye(2)
        w = w - np.clip(np.linalg.solve(hessian, grad), -2, 2)
    return float(max(w[0], 1e-6) / scale), float(w[1])


def fit_dense(
    x: np.ndarray, label: np.ndarray, ridge: float = 1e-2, steps: int = 60, toward: float = 0.0, rising: bool = False
) -> np.ndarray:
    """Weights (the last is the bias) by damped Newton steps on few dense features, drawn to
    ``toward`` by the penalty. With ``rising`` no weight but the bias is below 0: features whose
    weight would be are left out, and the others fitted again."""
    x = np.column_stack((x, np.ones(len(x))))
    kept = np.ones(x.shape[1], bool)
    while True:
        part = x[:, kept]
        w = np.zeros(part.shape[1])
        penalty = np.append(np.full(part.shape[1] - 1, ridge), 1e-6)
        for _ in range(steps):
            p = sigmoid(part @ w)
            grad = part.T @ (p - label) + penalty * (w - np.append(np.full(len(w) - 1, toward), 0.0))
            hessian = (part.T * (p * (1 - p))) @ part + np.diag(penalty + 1e-6)
            w = w - np.clip(np.linalg.solve(hessian, grad), -2, 2)
        below = np.append(w[:-1] < 0, False)
        if not rising or not below.any():
            break
        kept[np.flatnonzero(kept)[below]] = False
    whole = np.zeros(x.shape[1])
    whole[kept] = w
    return whole

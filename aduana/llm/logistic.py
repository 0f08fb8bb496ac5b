"""Logistic regression on sparse hashed features, with Platt calibration. Plain numpy on a bounded sample."""

from __future__ import annotations

import numpy as np


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def fit(
    rows: np.ndarray, columns: np.ndarray, values: np.ndarray, labels: np.ndarray, width: int,
    steps: int = 150, rate: float = 0.5, decay: float = 1e-5,
) -> tuple[np.ndarray, float]:
    """Weights and bias by full-batch adaptive gradient steps; both classes weigh the same in total."""
    n = len(labels)
    weights, bias = np.zeros(width), 0.0
    squares, bias_squares = np.full(width, 1e-8), 1e-8
    share = np.where(labels == 1, 0.5 / max(1, int(labels.sum())), 0.5 / max(1, int(n - labels.sum())))
    for _ in range(steps):
        z = np.bincount(rows, values * weights[columns], n) + bias
        error = (_sigmoid(z) - labels) * share
        gradient = np.bincount(columns, values * error[rows], width) + decay * weights
        squares += gradient**2
        weights -= rate * gradient / np.sqrt(squares)
        slope = float(error.sum())
        bias_squares += slope**2
        bias -= rate * slope / bias_squares**0.5
    return weights, bias


def calibrate(scores: np.ndarray, labels: np.ndarray, steps: int = 200) -> tuple[float, float]:
    """(a, b) so that sigmoid(a * score + b) is the probability of label 1, by Newton steps. Targets are drawn
    in a little, as Platt does, so that separable scores give finite values."""
    positive = int(labels.sum())
    target = np.where(labels == 1, (positive + 1) / (positive + 2), 1 / (len(labels) - positive + 2))
    a, b = 1.0, 0.0
    for _ in range(steps):
        p = _sigmoid(a * scores + b)
        error, w = p - target, p * (1 - p) + 1e-9
        gradient = np.array([(error * scores).sum() + 1e-3 * a, error.sum()])
        hessian = np.array([[(w * scores**2).sum() + 1e-3, (w * scores).sum()], [(w * scores).sum(), w.sum()]])
        step = np.linalg.solve(hessian + 1e-9 * np.eye(2), gradient)
        a, b = a - step[0], b - step[1]
        if abs(step).max() < 1e-9:
            break
    return float(a), float(b)

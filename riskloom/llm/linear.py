"""Logistic regression on sparse rows; the rows come from a sample of stated size and fit the driver."""

from __future__ import annotations

import numpy as np


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1.0 + np.tanh(0.5 * z))


def fit(row: np.ndarray, column: np.ndarray, value: np.ndarray, target: np.ndarray, width: int, l2: float, rounds: int = 100) -> tuple[np.ndarray, float]:
    """Weights and bias for entries (row, column, value) and targets between 0 and 1, by limited-memory BFGS."""
    n = len(target)

    def loss(theta: np.ndarray) -> tuple[float, np.ndarray]:
        w, b = theta[:-1], theta[-1]
        z = np.bincount(row, value * w[column], minlength=n) + b
        gap = sigmoid(z) - target
        cost = np.logaddexp(0.0, z).sum() - (target * z).sum() + 0.5 * l2 * (w @ w)
        return cost / n, np.append(np.bincount(column, value * gap[row], minlength=width) + l2 * w, gap.sum()) / n

    share = (target.sum() + 1) / (n + 2)
    theta = np.append(np.zeros(width), np.log(share / (1 - share)))
    cost, slope = loss(theta)
    past: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(rounds):
        step = slope.copy()
        scales = []
        for s, y in reversed(past):
            a = (s @ step) / (s @ y)
            scales.append(a)
            step -= a * y
        if past:
            step *= (past[-1][0] @ past[-1][1]) / (past[-1][1] @ past[-1][1])
        for (s, y), a in zip(past, reversed(scales)):
            step += (a - (y @ step) / (s @ y)) * s
        size, gain = 1.0, slope @ step
        if gain <= 1e-14:
            break
        while size > 1e-8:
            next_cost, next_slope = loss(theta - size * step)
            if next_cost <= cost - 1e-4 * size * gain:
                break
            size /= 2
        else:
            break
        s, y = -size * step, next_slope - slope
        if s @ y > 1e-16:
            past = [*past[-7:], (s, y)]
        done = cost - next_cost < 1e-9
        theta, cost, slope = theta + s, next_cost, next_slope
        if done:
            break
    return theta[:-1], float(theta[-1])

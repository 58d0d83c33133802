"""Minimising a smooth function on the driver, for models of bounded size."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np


def minimum(
    loss: Callable[[np.ndarray], tuple[float, np.ndarray]], start: np.ndarray,
    rounds: int = 60, memory: int = 8,
) -> np.ndarray:
    """Limited-memory quasi-Newton descent with halved steps; the same on every run."""
    x = start
    value, slope = loss(x)
    steps: list[np.ndarray] = []
    changes: list[np.ndarray] = []
    for _ in range(rounds):
        way = slope.copy()
        used = []
        for s, y in zip(reversed(steps), reversed(changes)):
            a = s @ way / (s @ y)
            used.append(a)
            way -= a * y
        if steps:
            way *= steps[-1] @ changes[-1] / (changes[-1] @ changes[-1])
        else:
            way /= max(1e-12, np.linalg.norm(slope))
        for s, y, a in zip(steps, changes, reversed(used)):
            way += s * (a - y @ way / (s @ y))
        step = 1.0
        while step > 1e-8:
            there, gradient = loss(x - step * way)
            if there <= value - 1e-4 * step * (way @ slope):
                break
            step /= 2
        else:
            break
        s, y = -step * way, gradient - slope
        if s @ y > 1e-12:
            steps, changes = [*steps, s][-memory:], [*changes, y][-memory:]
        done = value - there < 1e-7 * max(1.0, abs(value))
        x, value, slope = x + s, there, gradient
        if done:
            break
    return x

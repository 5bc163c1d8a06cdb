"""Monotone calibration of raw scores."""

from __future__ import annotations

import numpy as np


def isotonic(x: np.ndarray, positive: np.ndarray, total: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the nondecreasing step function of least squares, by pooling adjacent violators.

    ``x`` ascends; each has ``total`` weight, ``positive`` of it with label 1. Each pool is drawn
    half an observation towards the overall share, so that no pool claims certainty. Returns the mean
    place and the value of each pool, to be interpolated. No observation: 0.5 everywhere.
    """
    if not len(x) or not total.sum():
        return np.zeros(1), np.full(1, 0.5)
    base = positive.sum() / total.sum()
    pools: list[list[float]] = []
    for at, p, n in zip(x.tolist(), positive.tolist(), total.tolist()):
        pools.append([at * n, p, n])
        while len(pools) > 1 and pools[-2][1] * pools[-1][2] >= pools[-1][1] * pools[-2][2]:
            last = pools.pop()
            pools[-1] = [a + b for a, b in zip(pools[-1], last)]
    sums = np.array(pools)
    knots = sums[:, 0] / sums[:, 2]
    values = (sums[:, 1] + 0.5 * base) / (sums[:, 2] + 0.5)
    return knots, np.maximum.accumulate(values)

"""Search of parameters by a Gaussian process; the model of the search is small and lives on the driver, what it asks is a Spark job."""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np


def _kernel(a: np.ndarray, b: np.ndarray, width: float) -> np.ndarray:
    return np.exp(-((a[:, None, :] - b[None, :, :]) ** 2).sum(-1) / (2 * width * width))


def expected_improvement(x: np.ndarray, y: np.ndarray, at: np.ndarray, width: float = 0.25, noise: float = 1e-6) -> np.ndarray:
    """How much better than the best of ``y`` each point of ``at`` is expected to be, by a Gaussian process on the unit cube."""
    mean, spread = y.mean(), max(y.std(), 1e-9)
    k = np.linalg.inv(_kernel(x, x, width) + noise * np.eye(len(x)))
    cross = _kernel(at, x, width)
    mu = cross @ k @ ((y - mean) / spread)
    sigma = np.sqrt(np.maximum(1e-12, 1 - np.einsum("ij,jk,ik->i", cross, k, cross)))
    z = (mu - ((y - mean) / spread).max()) / sigma
    cdf = np.array([0.5 * (1 + math.erf(v / math.sqrt(2))) for v in z])
    return sigma * (z * cdf + np.exp(-z * z / 2) / math.sqrt(2 * math.pi))


def gaussian_search(score: Callable[[list[dict[str, float]]], list[float]], space: dict[str, tuple[float, float]], calls: int = 24, at_once: int = 4, seed: int = 0) -> tuple[dict[str, float], float, list[tuple[dict[str, float], float]]]:
    """(best parameters, their score, all tried) of ``calls`` evaluations in batches of ``at_once``; a higher score is better.

    ``score`` judges a batch of parameters at once, so that one pass over the data can serve all of them.
    The first batch is drawn evenly; later ones take the points of largest expected improvement, each point
    of a batch after the ones before it are taken to score as expected.
    """
    rng = np.random.default_rng(seed)
    names = list(space)
    low, high = (np.array([space[n][i] for n in names], float) for i in (0, 1))
    as_dict = lambda row: dict(zip(names, (low + row * (high - low)).tolist(), strict=True))
    first = min(calls, max(at_once, 2 * len(names)))
    x = (rng.permuted(np.tile((np.arange(first) + 0.5) / first, (len(names), 1)), axis=1)).T
    y = np.array(score([as_dict(r) for r in x]), float)
    while len(x) < calls:
        fx, fy, batch = x, y, []
        for _ in range(min(at_once, calls - len(x))):
            at = np.vstack([rng.random((512, len(names))), np.clip(x[y.argmax()] + rng.normal(0, 0.05, (128, len(names))), 0, 1)])
            best = at[int(expected_improvement(fx, fy, at).argmax())]
            batch.append(best)
            fx, fy = np.vstack([fx, best]), np.append(fy, fy.mean())
        x, y = np.vstack([x, batch]), np.append(y, score([as_dict(r) for r in batch]))
    tried = [(as_dict(r), float(v)) for r, v in zip(x, y, strict=True)]
    best, value = max(tried, key=lambda t: t[1])
    return best, value, tried

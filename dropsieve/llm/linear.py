"""Small dense models fitted on a bounded sample of rows, and the sample itself."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_ids(ids: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of ``ids``, those of the lowest hash of doc_id."""
    return ids.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)


def only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` with the columns of ``ids``, whose row count is bounded by its limit."""
    return docs.join(F.broadcast(ids), "doc_id")


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class Steps:
    """Columns cut at quantiles, most of them in the tails: each becomes as many indicators, so that
    a linear model on them is a step function of every column. The columns themselves, in
    deviations and held within eight of them, come after."""

    TAIL = (0.002, 0.005, 0.01, 0.02, 0.04, 0.07, 0.12, 0.2, 0.35)

    def __init__(self, x: np.ndarray):
        q = np.array([*self.TAIL, 0.5, *(1 - t for t in reversed(self.TAIL))])
        self.at = np.quantile(x, q, axis=0) if len(x) else np.zeros((len(q), x.shape[1]))
        self.mid = x.mean(axis=0) if len(x) else np.zeros(x.shape[1])
        self.scale = np.maximum(x.std(axis=0), 1e-9) if len(x) else np.ones(x.shape[1])

    def __call__(self, x: np.ndarray) -> np.ndarray:
        above = (x[:, None, :] > self.at[None]).reshape(len(x), -1)
        return np.hstack([above, np.clip((x - self.mid) / self.scale, -8, 8)]).astype(np.float32)


def adam(grad, size: int, steps: int, rate: float) -> np.ndarray:
    """Weights after ``steps`` of Adam on ``grad(w)``, averaged over the last half."""
    w, m, v, mean = (np.zeros(size) for _ in range(4))
    for t in range(1, steps + 1):
        g = grad(w)
        m = 0.9 * m + 0.1 * g
        v = 0.999 * v + 0.001 * g * g
        w = w - rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.999**t)) + 1e-8)
        if t > steps // 2:
            mean += w
    return mean / max(1, steps - steps // 2)


def fit_soft(x: np.ndarray, y: np.ndarray, ridge: float = 1e-4, steps: int = 400) -> np.ndarray:
    """Logistic weights, the last one the constant, for labels ``y`` between 0 and 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    n = max(1, len(x))
    return adam(lambda w: x.T @ (sigmoid(x @ w) - y) / n + ridge * w, x.shape[1], steps, 0.05)


def score(x: np.ndarray, w: np.ndarray) -> np.ndarray:
    return sigmoid(x @ w[:-1] + w[-1])

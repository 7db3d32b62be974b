"""Sums of per-row terms over a distributed table, for Newton steps on the driver.

Every task reduces its rows to one vector of fixed length; vectors are summed
in groups of ``FAN_IN`` until few are left, so the driver gets a bounded amount
whatever the number of tasks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import arrow_map

FAN_IN = 64


def distributed_sum(df: DataFrame, term: Callable[[pa.RecordBatch], np.ndarray], length: int) -> np.ndarray:
    """Sum over all rows of ``term(batch)``, a float64 vector of this length."""
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            if b.num_rows:
                total += term(b)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(length)
        for b in batches:
            for v in b.column("v").to_pylist():
                total += np.frombuffer(v)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["v"])

    out = arrow_map(df, partial, "v binary")
    n = df.rdd.getNumPartitions()
    while n > FAN_IN:
        n = -(-n // FAN_IN)
        out = arrow_map(out.repartition(n), add, "v binary")
    total = np.zeros(length)
    for row in out.collect():
        total += np.frombuffer(bytes(row["v"]))
    return total


def solve(gradient: np.ndarray, hessian: np.ndarray, w: np.ndarray, ridge: np.ndarray) -> np.ndarray:
    """One Newton step on a penalised loss; ``ridge`` is the penalty of each weight."""
    return w - np.linalg.solve(hessian + np.diag(ridge + 1e-9), gradient + ridge * w)


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column of one length."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, width).astype(np.float64)


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


def logistic_term(x: np.ndarray, y: np.ndarray, w: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Gradient, Hessian and weight sum of the logistic loss, as one vector."""
    p = sigmoid(x @ w)
    g = x.T @ (weight * (p - y))
    h = (x * (weight * p * (1 - p))[:, None]).T @ x
    return np.r_[g, h.ravel(), weight.sum()]


def split_term(v: np.ndarray, d: int) -> tuple[np.ndarray, np.ndarray, float]:
    return v[:d], v[d:d + d * d].reshape(d, d), float(v[-1])

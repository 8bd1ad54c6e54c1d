"""Whole-number vectors: what the clustering and the code compression work on."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Largest magnitude of a whole-number component: 64 squared differences still fit a long.
LARGEST = 1 << 27

#: Bound of the rounding in a square root, a sum or a difference of two of them.
ROUNDING = 2.0 ** -50


def whole_vectors(df: DataFrame, dims: int, id_col: str, vec_col: str, keep: tuple[str, ...] = ()) -> DataFrame:
    """``vec_id``, ``q`` (array of int: floor(1024 * x) per component) and the ``keep`` columns.

    Rows whose vector is null, has another length than ``dims`` or holds a
    null or non-finite component are dropped.  A component beyond
    +-131,072 stops the job: squared distances would not fit a long.
    """
    vec = F.col(f"`{vec_col}`").cast("array<double>")
    finite = F.forall("_v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    unfit = F.raise_error(F.lit("a vector component is beyond +-131072")).cast("int")
    whole = F.transform("_v", lambda x: F.when(F.abs(x) <= LARGEST // 1024, F.floor(x * 1024.0).cast("int")).otherwise(unfit))
    return (df.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), vec.alias("_v"),
                      *[F.col(f"`{c}`").alias(f"keep_{i}") for i, c in enumerate(keep)])
            .where(F.col("_v").isNotNull() & (F.size("_v") == dims) & finite)
            .select("vec_id", whole.alias("q"), *[f"keep_{i}" for i in range(len(keep))]))


def matrix(column, width: int) -> np.ndarray:
    """An Arrow list column of rows of ``width`` numbers as a matrix of longs."""
    return np.asarray(column.flatten().to_numpy(zero_copy_only=False), dtype=np.int64).reshape(len(column), width)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of ``a`` (n x d) and ``b`` (m x d): n x m."""
    if max(np.abs(a).max(initial=0), np.abs(b).max(initial=0)) <= 1 << 20 and a.shape[1] <= 256:
        x, y = a.astype(np.float64), b.astype(np.float64)  # whole numbers below 2**53 throughout: no rounding
        return ((x * x).sum(1)[:, None] + (y * y).sum(1) - 2 * (x @ y.T)).astype(np.int64)
    out = np.empty((len(a), len(b)), np.int64)
    for j, row in enumerate(b):
        diff = a - row
        out[:, j] = (diff * diff).sum(1)
    return out


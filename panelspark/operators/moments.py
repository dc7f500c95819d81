"""Additive sufficient statistics: count, means and centred cross-products, overall or per group.

Every model here needs the data only through these, so the one large job is a ``groupBy`` of built-in aggregates
that combine map-side; a hot group costs no more than any other.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.schema import quoted


def pairs(q: int) -> list[tuple[int, int]]:
    return [(i, j) for i in range(q) for j in range(i, q)]


def complete_rows(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows where every column is a number (neither null nor NaN)."""
    kept = df
    for c in columns:
        kept = kept.filter(F.col(quoted(c)).isNotNull() & ~F.isnan(F.col(quoted(c)).cast("double")))
    return kept


def moment_columns(columns: Sequence[str]) -> list[Column]:
    """Aggregates ``n``, ``m`` (means) and ``c`` (upper triangle of centred cross-products).

    The centred built-ins are stable in one pass, whatever the level of a column. The columns must be null in the same
    rows, or in none.
    """
    xs = [f"double({quoted(c)})" for c in columns]
    n = f"double(count({xs[0]}))"
    means = [f"avg({x})" for x in xs]
    cross = [
        f"{f'var_pop({xs[i]})' if i == j else f'covar_pop({xs[i]}, {xs[j]})'} * {n}" for i, j in pairs(len(xs))
    ]
    return [F.expr(n).alias("n"), F.expr(f"array({', '.join(means)})").alias("m"), F.expr(f"array({', '.join(cross)})").alias("c")]


def moments(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per group (or one row in all) of :func:`moment_columns` over complete rows."""
    kept = complete_rows(df, columns)
    stats = moment_columns(columns)
    return kept.groupBy(*by).agg(*stats) if by else kept.agg(*stats).filter("n > 0")


def unpack(triangle: np.ndarray, q: int) -> np.ndarray:
    """Upper triangles ``(..., q(q+1)/2)`` -> symmetric matrices ``(..., q, q)``."""
    triangle = np.asarray(triangle, dtype=float)
    full = np.zeros((*triangle.shape[:-1], q, q))
    rows, cols = np.triu_indices(q)
    full[..., rows, cols] = triangle
    full[..., cols, rows] = triangle
    return full


#: Least eigenvalue of a correlation matrix that counts as regular.
SINGULAR = 1e-11


def is_singular(a: np.ndarray, tolerance: float = SINGULAR) -> bool:
    """Whether a moment matrix is rank-deficient, judged on its correlation form."""
    d = np.sqrt(np.clip(np.diag(a), 0.0, None))
    if a.size == 0:
        return False
    if not np.all(np.isfinite(a)) or np.any(d == 0):
        return True
    return bool(np.linalg.eigvalsh(a / np.outer(d, d))[0] < tolerance)


#: Share of its own size that a column must add to those before it.
LEAST_SHARE = 1e-10


def independent(a: np.ndarray, sizes: np.ndarray | None = None) -> np.ndarray:
    """Which columns of a moment matrix add to those before them, by elimination in their order.

    ``sizes`` are the squared sizes that what is left is compared with; the diagonal unless given.
    """
    left, kept = np.array(a, float), np.zeros(len(a), bool)
    sizes = np.diag(a).copy() if sizes is None else sizes
    for j in range(len(a)):
        kept[j] = np.isfinite(left[j, j]) and left[j, j] > LEAST_SHARE * sizes[j]
        if kept[j]:
            left -= np.outer(left[:, j], left[j]) / left[j, j]
    return kept

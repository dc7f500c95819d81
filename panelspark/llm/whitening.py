"""Whitening of embeddings on whole numbers, with eigenvectors refined from single precision.

An entry c counts as x = floor(64 c) + 1,000,000. The distinct x vectors are written once (equal vectors meet in a
grouping with partial aggregation, so a vector that a third of all rows share costs no task more than another). Sums and
the centred covariance are then sums over tasks; d numbers and d x d numbers reach the driver, whatever the rows.

There the covariance is decomposed in float32 and the vectors are corrected by Ogita and Aishima's iterations, which are
matrix products, in extended precision: R = I - X'X says how far X is from orthogonal, S = X'VX how far from diagonal,
and X (I + E) removes both to second order. Where eigenvalues lie closer together than the current error, E could not
tell their vectors apart: such a cluster's basis is first made orthonormal, and then rotated by a solve of the small
matrix X'(V - m I)X of its own, in which the shift m leaves the differences with full precision.

Defined results: a row whose vector is null, or holds an entry that is null, not finite or 2^31 or more in size, gives no
rows; nor does one whose vector is not as long as most distinct ones are (of ties, the longest count). Repeated rows and
ids, and null ids, are rows of their own; other columns are not read; without rows left the result is empty. A component
without variance (its eigenvalue is rounding error against the largest) has a null for ``whitened``. A ``deviation`` of
2^62 or more is null: with entries that differ by ten it fits up to some 10^7 distinct vectors of 64 entries.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelspark.session import materialise, release

SCALE, SHIFT = 64, 1_000_000
#: Entries of this size or more are left out: their whole numbers would not be exact.
LARGEST = 2.0 ** 31
COMPONENTS = 16
#: Iterations of the refinement: from single precision, errors square at each.
ROUNDS = 12


def whole_numbers(vectors: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Numbers of the rows that count, their lengths, and the whole numbers of their entries, one row after another."""
    lengths = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1))
    flat = vectors.flatten()
    if not len(flat):
        entries = np.zeros(0)
    else:
        entries = flat.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    with np.errstate(invalid="ignore"):
        bad = ~(np.abs(entries) < LARGEST)
    sizes = np.maximum(lengths, 0)
    owner = np.repeat(np.arange(len(lengths)), sizes)
    counts = lengths >= 0
    counts[owner[bad]] = False
    rows = np.flatnonzero(counts)
    return rows, sizes[rows], np.floor(SCALE * entries[counts[owner]]).astype(np.int64) + SHIFT


def _matrix(rows: pa.Array) -> np.ndarray:
    """Rows of whole numbers of one length, from a column of their bytes."""
    return np.frombuffer(b"".join(rows.to_pylist()), "<i8").reshape(len(rows), -1)


def _by_entry(fit: DataFrame, make: Callable[[np.ndarray], np.ndarray], size: int, kind: str) -> list:
    """Sums over all rows of the ``size`` numbers that ``make`` gives for a matrix of rows."""
    schema = StructType.fromDDL(f"i int, part {kind}")
    out = to_arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for b in batches:
            if b.num_rows:
                part = make(_matrix(b.column(0)))
                total = part if total is None else total + part
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(total)], schema=out)

    summed = fit.mapInArrow(run, schema).groupBy("i").agg(F.sum("part").alias("part")).collect()
    return [r["part"] for r in sorted(summed)]


def covariance(n: int, sums: list[int], products: list[int]) -> np.ndarray:
    """Covariance, divisor n, in extended precision, from sums and sums of products (row by row) of whole numbers."""
    d = len(sums)
    return np.array([
        [np.longdouble(n * products[i * d + j] - sums[i] * sums[j]) / np.longdouble(n * n) for j in range(d)]
        for i in range(d)
    ])


def refine(a: np.ndarray, x: np.ndarray, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues and unit eigenvectors (columns) of the symmetric ``a``, in its precision, from approximations ``x``."""
    a_norm, eye = np.linalg.norm(a.astype(np.float64)), np.eye(len(a), dtype=a.dtype)
    least = len(a) * np.finfo(a.dtype).eps
    x = x.astype(a.dtype)
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ (a @ x)
        s = (s + s.T) / 2  # then E + E' = R, and a small gap cannot cost orthogonality
        values = np.diag(s) / (1 - np.diag(r))
        off = s - np.diag(values)
        near = 2 * (np.sqrt((off * off).sum()) + a_norm * np.sqrt((r * r).sum()))
        gap = values[None, :] - values[:, None]
        close = np.abs(gap) <= near
        e = np.where(close, r / 2, (s + values[None, :] * r) / np.where(close, 1, gap))
        x = x + x @ e
        clustered = False
        for members in _clusters(values, near):
            clustered = True
            x[:, members] = _solve_within(a, x[:, members], values[members].mean())
        if np.abs(e).max() <= least and not clustered:
            break
    x = _orthonormal(x)
    values = ((a @ x) * x).sum(0)
    order = np.argsort(-values, kind="stable")
    return values[order], x[:, order]


def _clusters(values: np.ndarray, near: float) -> list[np.ndarray]:
    """Groups of two or more eigenvalues, each within ``near`` of the next."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > near) + 1
    return [members for members in np.split(order, cuts) if len(members) > 1]


def _solve_within(a: np.ndarray, basis: np.ndarray, middle: float) -> np.ndarray:
    """The basis rotated so that its vectors are eigenvectors, by the small matrix of ``a`` shifted by ``middle``."""
    basis = _orthonormal(basis)
    small = basis.T @ (a @ basis - middle * basis)
    size = np.abs(small).max()
    if size == 0:
        return basis
    _, turn = np.linalg.eigh(((small + small.T) / (2 * size)).astype(np.float64))
    return basis @ _orthonormal(turn.astype(a.dtype))


def _orthonormal(x: np.ndarray) -> np.ndarray:
    """Nearly orthonormal columns, with their error squared."""
    return x @ (3 * np.eye(x.shape[1], dtype=x.dtype) - x.T @ x) / 2


@dataclass(frozen=True)
class Whitening:
    """What was fitted on ``n`` distinct vectors: sums, eigenvalues and unit eigenvectors (columns) by falling
    eigenvalue, the trace, and the largest difference of the whitened covariance from the identity."""

    n: int
    sums: np.ndarray
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float = float("nan")

    @property
    def varying(self) -> int:
        """How many of the components have variance."""
        return int((self.values > len(self.sums) * np.finfo(np.float64).eps * max(self.values[0], 0.0)).sum())

    def whiten(self, x: np.ndarray) -> np.ndarray:
        """x - S/n on the components with variance; the whole part of the mean is taken off exactly."""
        whole = self.sums // self.n
        centred = (x - whole) - (self.sums - whole * self.n) / self.n
        return centred @ (self.vectors[:, :self.varying] / np.sqrt(self.values[:self.varying]))

    def deviation(self, x: np.ndarray) -> pa.Array:
        """Sums of (n x - S)^2, exact; null where 64 bits are too few."""
        rough = ((x.astype(np.float64) - self.sums / self.n) ** 2).sum(1) * float(self.n) ** 2
        far = (rough >= 2.0 ** 62) | (self.n * np.abs(x).max(1, initial=0).astype(np.float64) >= 2.0 ** 62)
        apart = self.n * x - self.sums
        return pa.array((apart * apart).sum(1), mask=far)


def fit(df: DataFrame, vector: str = "embedding", components: int = COMPONENTS) -> Whitening | None:
    """Fits on the distinct x vectors of ``df``; None if no row counts."""

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, lengths, x = whole_numbers(b.column(0))
            x, ends = x.astype("<i8").tobytes(), [0, *(8 * np.cumsum(lengths)).tolist()]
            yield pa.RecordBatch.from_arrays([pa.array([x[i:j] for i, j in zip(ends, ends[1:])], pa.binary())], ["x"])

    rows = materialise(df.select(vector).mapInArrow(distinct, "x binary").distinct())
    sizes = rows.groupBy((F.octet_length("x") / 8).cast("int").alias("d")).count().where("d > 0")
    size = sizes.orderBy(F.desc("count"), F.desc("d")).first()
    if size is None:
        release(rows)
        return None
    d, n = size["d"], size["count"]
    listed = rows.where(F.octet_length("x") == 8 * d)
    sums = _by_entry(listed, lambda x: x.sum(0), d, "bigint")
    whole = np.array([s // n for s in sums])

    def products(x: np.ndarray) -> np.ndarray:
        near = (x - whole).astype(np.float64)  # whole numbers: exact below 2^53, in any order of tasks
        return (near.T @ near).ravel()

    v = covariance(n, [s - n * int(w) for s, w in zip(sums, whole)],
                   [int(p) for p in _by_entry(listed, products, d * d, "double")])
    values, vectors = refine(v, np.linalg.eigh(v.astype(np.float32))[1])
    k = min(components, d)
    vectors = vectors[:, :k] * np.where(vectors[np.abs(vectors).argmax(0), np.arange(d)][:k] < 0, -1, 1)
    found = Whitening(n, np.array(sums), values[:k].astype(float), vectors.astype(float), float(np.trace(v)))
    m = found.varying
    if m:
        def moments(x: np.ndarray) -> np.ndarray:
            w = found.whiten(x)
            return np.concatenate([w.sum(0), (w.T @ w).ravel()])

        total = np.array(_by_entry(listed, moments, m + m * m, "double")) / n
        error = np.abs(total[m:].reshape(m, m) - np.outer(total[:m], total[:m]) - np.eye(m)).max()
        found = replace(found, identity_error=float(error))
    release(rows)
    return found


def transform(df: DataFrame, model: Whitening | None, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(key, deviation, whitened): one row for each row that counts, ``whitened`` by component."""
    fields = StructType.fromDDL("deviation bigint, whitened array<double>")
    out = StructType([df.select(key).schema[0], *fields])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        d, k = model.vectors.shape
        for b in batches:
            rows, lengths, x = whole_numbers(b.column(1))
            x = x[np.repeat(lengths == d, lengths)].reshape(-1, d)
            rows = rows[lengths == d]
            whitened = np.full((len(rows), k), np.nan)
            whitened[:, :model.varying] = model.whiten(x)
            flat = pa.array(whitened.ravel(), from_pandas=True)  # not a number becomes null
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1) * k, pa.int32()), flat)
            columns = [b.column(0).take(pa.array(rows)), model.deviation(x), lists.cast(schema[2].type)]
            yield pa.RecordBatch.from_arrays(columns, schema=schema)

    rows = df.select(key, vector)
    return rows.mapInArrow(run, out) if model else rows.sparkSession.createDataFrame([], out)

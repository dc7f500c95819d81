import math
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from panelspark.llm import whitening
from panelspark.llm.queries import QUERIES
from tests.llm.conftest import SF

DDL = "vec_id long, embedding array<double>, n long, component string, x int"


def frame(spark, rows):
    return spark.createDataFrame([(k, v, 1, "c", None) for k, v in rows], DDL)


def exact(vectors):
    """n, sums and covariance (as fractions) of the distinct x vectors of clean rows."""
    listed = sorted({tuple(math.floor(64 * c) + 1_000_000 for c in v) for v in vectors})
    n, d = len(listed), len(listed[0])
    sums = [sum(x[i] for x in listed) for i in range(d)]
    v = [[Fraction(sum((n * x[i] - sums[i]) * (n * x[j] - sums[j]) for x in listed), n ** 3) for j in range(d)] for i in range(d)]
    return listed, n, sums, v


def test_query_on_the_whole_table(spark):
    rows = duckdb.connect().sql(f"SELECT vec_id, embedding FROM '{SF}/embeddings.parquet'").fetchall()
    clean = [(k, v) for k, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
    listed, n, sums, _ = exact([v for _, v in clean])
    centred = np.array(listed, float) - np.array(sums) / n
    cov = centred.T @ centred / n
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1][:16], vectors[:, ::-1][:, :16]
    got = QUERIES["op11_whitening"](spark, SF).toPandas().sort_values(["vec_id", "component"])
    assert len(got) == 16 * len(clean) and (got["n"] == n).all() and got["identity_error"].max() < 1e-9
    x = np.array([[math.floor(64 * c) + 1_000_000 for c in v] for _, v in sorted(clean)])
    want = (x - np.array(sums) / n) @ vectors / np.sqrt(values)
    found = got["whitened"].to_numpy().reshape(-1, 16)
    signs = np.sign((want * found).sum(0))
    assert np.abs(found - want * signs).max() < 1e-8
    assert np.allclose(got["explained"].to_numpy().reshape(-1, 16)[0], values / np.trace(cov), rtol=1e-9)
    assert got["deviation"].tolist() == [
        sum((n * int(a) - s) ** 2 for a, s in zip(r, sums)) for r in x for _ in range(16)
    ]


@pytest.mark.parametrize("values", [
    [9.0, 4.0, 1.0, 0.25, 1e-3, 1e-7],
    [5.0, 5.0, 5.0, 2.0, 2.0, 1.0],
    [3.0 + 1e-9, 3.0 + 1e-11, 3.0, 1.0, 1.0 - 1e-10, 1e-12],
    [1.0] * 6,
    [0.0] * 6,
])
def test_refinement(values):
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.normal(size=(6, 6)))[0].astype(np.longdouble)
    for _ in range(4):
        q = q @ (3 * np.eye(6) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    a = (a + a.T) / 2
    start = np.linalg.eigh(a.astype(np.float32))[1]
    found, x = whitening.refine(a, start)
    assert np.abs(found - np.sort(np.array(values, np.longdouble))[::-1]).max() < 1e-16 * max(1, max(values))
    assert np.abs(x.T @ x - np.eye(6)).max() < 1e-16  # double precision
    assert np.abs(a @ x - x * found).max() < 1e-16 * max(1, max(values))
    if len(set(values)) > 1:  # single precision was not enough
        assert np.abs(a @ start - start * found).max() > 1e-9


def test_near_equal_eigenvalues_give_the_true_vectors():
    """Eigenvalues that float32 cannot tell apart: the vectors still come out to double precision."""
    angle = np.longdouble(0.3)
    turn = np.array([[np.cos(angle), -np.sin(angle)], [np.sin(angle), np.cos(angle)]])
    a = (turn * np.array([1 + 1e-9, 1], np.longdouble)) @ turn.T
    _, x = whitening.refine((a + a.T) / 2, np.linalg.eigh(a.astype(np.float32))[1])
    assert np.abs(np.abs(x) - np.abs(turn)).max() < 1e-9


def test_covariance_is_exact():
    rows = [[0.5, -3.25], [7.0, 2.0], [0.5, 2.125]]
    listed, n, sums, v = exact(rows)
    products = [sum(x[i] * x[j] for x in listed) for i in range(2) for j in range(2)]
    assert whitening.covariance(n, sums, products).astype(float).tolist() == [[float(c) for c in r] for r in v]


def test_odd_rows(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=3).tolist()) for i in range(40)]
    odd = [
        (100, None), (101, [1.0, None, 2.0]), (102, [1.0, float("nan"), 2.0]), (103, [float("inf"), 1.0, 2.0]),
        (104, []), (105, [1.0, 2.0]), (106, [1e300, 0.0, 0.0]), (None, good[0][1]), (7, good[7][1]), (7, good[8][1]),
    ]
    df = frame(spark, odd[:5] + good + odd[5:]).repartition(4)
    model = whitening.fit(df)
    got = whitening.transform(df, model).collect()
    listed, n, sums, v = exact([v for _, v in good])
    assert model.n == n and model.sums.tolist() == sums
    assert sorted(r["vec_id"] for r in got if r["vec_id"] is not None) == sorted([*range(40), 7, 7])
    assert sum(r["vec_id"] is None for r in got) == 1
    assert all(len(r["whitened"]) == 3 for r in got)
    w = np.array([model.whiten(np.array([x]))[0] for x in listed])
    assert np.abs(w.T @ w / n - np.eye(3)).max() < 1e-12


def test_without_variance(spark):
    df = frame(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])
    model = whitening.fit(df)
    assert model.n == 1 and model.varying == 0 and math.isnan(model.identity_error)
    assert [tuple(r) for r in whitening.transform(df, model).collect()] == [(1, 0, [None, None]), (2, 0, [None, None])]
    flat = frame(spark, [(1, [0.5, 1.0]), (2, [1.5, 1.0]), (3, [2.5, 1.0])])
    model = whitening.fit(flat)
    rows = whitening.transform(flat, model).collect()
    assert model.varying == 1 and all(r["whitened"][1] is None for r in rows)
    assert sorted(abs(r["whitened"][0]) for r in rows) == pytest.approx([0, math.sqrt(1.5), math.sqrt(1.5)])


def test_deviation_beyond_64_bits_is_null(spark):
    df = frame(spark, [(1, [2.0 ** 30]), (2, [0.0]), (3, [-(2.0 ** 30)])])
    rows = whitening.transform(df, whitening.fit(df)).collect()
    assert {r["vec_id"]: r["deviation"] for r in rows} == {1: None, 2: 0, 3: None}


def test_no_rows(spark):
    for rows in ([], [(1, None)], [(1, [])]):
        df = frame(spark, rows)
        assert whitening.fit(df) is None and whitening.transform(df, None).collect() == []

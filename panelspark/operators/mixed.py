"""Linear mixed models with random intercepts (unit, or unit within stratum) by restricted likelihood.

With W = [1, X - c, y - c], a unit of n rows with mean vector d = (1, mean - c) and within-unit scatter C adds
C + n/(1 + n t) d d' to the weighted cross-product matrix at variance ratio t. Units of the same size share the factor,
so the data shrink to one row per (stratum, unit size): unit count, mean and scatter of the unit means, pooled
within-unit scatter. That table has at most about sqrt(2N) rows per stratum and is built by two grouped aggregations;
the search for the variance ratios then only touches it. A stratum of size classes adds its own rank-one term.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.tails import t_two_sided
from panelspark.operators.linear import COEFFICIENTS, INTERCEPT, dropped_row, dropping, prepare
from panelspark.operators.moments import independent, is_singular, moments, pairs, unpack
from panelspark.operators.schema import quoted
from panelspark.session import materialise, release

COARSE = tuple(float(k) for k in range(-12, 13))
#: Most rounds of Newton steps; five or so are usual.
ROUNDS = 40
#: A step in the log ratios that the second-order expansion takes without a look; and the longest step.
SHORT, LONGEST = 1e-6, 2.0
#: Slope of the criterion in a small ratio's log below which the ratio is zero.
FLAT = 1e-7
#: Largest log ratio that a search opens up to; a criterion that still falls there has no optimum.
LAST_LOG = 600.0
#: Values of ``by`` (copies, outcomes) that one call fits; each holds some numbers in the driver.
BY_LIMIT = 10_000
VARIANCES = (
    "n_obs long, n_units long, theta_unit double, theta_stratum double, sigma2 double, "
    "var_unit double, var_stratum double, criterion double, status string"
)


class MixedFit(NamedTuple):
    coefficients: DataFrame
    variances: DataFrame


class _Problem(NamedTuple):
    classes: DataFrame
    centre: dict[str, list[float]]
    n: dict[str, float]
    units: dict[str, float]
    q: int


def unit_moments(
    df: DataFrame, unit: str, outcome: str, regressors: Sequence[str], keys: Sequence[str] = (), log_outcome: bool = True
) -> DataFrame:
    """One row per unit (and key): rows, means and within-unit scatter of the regressors and the outcome."""
    work = prepare(df, outcome, regressors, [*keys, unit], log_outcome)
    work = work.dropna(subset=[*keys, unit])
    return moments(work, [*regressors, "_y"], [*keys, unit])


def size_classes(units: DataFrame, q: int, keys: Sequence[str]) -> DataFrame:
    """Units of equal size, per key: count ``g``, mean ``mm`` and scatter ``s`` of their means, pooled scatter ``w``."""
    scatter = [f"{f'var_pop(m[{i}])' if i == j else f'covar_pop(m[{i}], m[{j}])'} * count(1)" for i, j in pairs(q)]
    return units.groupBy(*keys, "n").agg(
        F.expr("double(count(1))").alias("g"),
        F.expr(f"array({', '.join(f'avg(m[{i}])' for i in range(q))})").alias("mm"),
        F.expr(f"array({', '.join(scatter)})").alias("s"),
        F.expr(f"array({', '.join(f'sum(c[{k}])' for k in range(len(pairs(q))))})").alias("w"),
    )


def _problem(
    df: DataFrame, unit: str, stratum: str | None, outcome: str, regressors: Sequence[str], by: str | None, log_outcome: bool
) -> _Problem:
    work = df.withColumns({
        "_by": F.lit("") if by is None else F.col(by).cast("string"),
        "_stratum": F.lit("") if stratum is None else F.col(stratum).cast("string"),
    })
    q = len(regressors) + 1
    units = unit_moments(work, unit, outcome, regressors, ["_by", "_stratum"], log_outcome)
    classes = materialise(size_classes(units, q, ["_by", "_stratum"]))
    rows = F.col("g") * F.col("n")
    totals = classes.groupBy("_by").agg(
        F.sum(rows).alias("n"),
        F.sum("g").alias("units"),
        F.array(*[F.sum(rows * F.col("mm")[i]) / F.sum(rows) for i in range(q)]).alias("centre"),
    ).limit(BY_LIMIT + 1).collect()
    if not totals:
        raise ValueError("no complete row to fit")
    if len(totals) > BY_LIMIT:
        raise ValueError(f"more than {BY_LIMIT} values of {by}: fit them in several calls")
    return _Problem(
        classes,
        {r["_by"]: list(r["centre"]) for r in totals},
        {r["_by"]: r["n"] for r in totals},
        {r["_by"]: r["units"] for r in totals},
        q,
    )


def _evaluate(problem: _Problem, grid: dict[str, tuple[list[float], list[float]]]) -> pd.DataFrame:
    """Weighted cross-product matrices and log-determinants at every point of each ``by``'s grid, as one job.

    The points that are broadcast are at most BY_LIMIT rows of some dozen numbers.
    """
    q = problem.q
    spark = problem.classes.sparkSession
    points = spark.createDataFrame(
        [(b, t1, t2, problem.centre[b]) for b, (t1, t2) in grid.items()],
        "_by string, t1s array<double>, t2s array<double>, centre array<double>",
    )
    work = problem.classes.join(F.broadcast(points), "_by").withColumn("t1", F.explode("t1s"))
    a = "(n / (1D + n * t1))"
    d = [f"(mm[{i}] - centre[{i}])" for i in range(q)]
    square = [f"sum(w[{k}] + {a} * (s[{k}] + g * {d[i]} * {d[j]}))" for k, (i, j) in enumerate(pairs(q))]
    strata = work.groupBy("_by", "_stratum", "t1").agg(
        F.first("t2s").alias("t2s"),
        F.expr(f"sum(g * {a})").alias("a"),
        F.expr(f"array({', '.join(f'sum(g * {a} * {x})' for x in d)})").alias("u"),
        F.expr(f"array({', '.join(square)})").alias("v"),
        F.expr("sum(g * log1p(n * t1))").alias("logdet"),
    )
    wide = strata.withColumn("t2", F.explode("t2s")).withColumn("k", F.expr("t2 / (1D + t2 * a)"))
    shrunk = [f"sum(v[{k}] - k * u[{i}] * u[{j}])" for k, (i, j) in enumerate(pairs(q))]
    total = wide.groupBy("_by", "t1", "t2").agg(
        F.expr("sum(a - k * a * a)").alias("m00"),
        F.expr(f"array({', '.join(f'sum(u[{i}] * (1D - k * a))' for i in range(q))})").alias("m0"),
        F.expr(f"array({', '.join(shrunk)})").alias("mm"),
        F.expr("sum(logdet + log1p(t2 * a))").alias("logdet"),
    )
    return total.toPandas()


def _matrix(frame: pd.DataFrame, q: int) -> np.ndarray:
    """Full matrices over (1, X, y)."""
    full = np.zeros((len(frame), q + 1, q + 1))
    full[:, 0, 0] = frame["m00"].to_numpy()
    full[:, 0, 1:] = full[:, 1:, 0] = np.stack(frame["m0"].to_numpy())
    full[:, 1:, 1:] = unpack(np.stack(frame["mm"].to_numpy()), q)
    return full


def criterion(matrix: np.ndarray, logdet: np.ndarray, n: np.ndarray | float) -> np.ndarray:
    """-2 restricted log-likelihood (without constants) with the coefficients and residual variance profiled out."""
    p = matrix.shape[-1] - 1
    mxx, mxy, myy = matrix[..., :p, :p], matrix[..., :p, p], matrix[..., p, p]
    scale = np.sqrt(np.einsum("...ii->...i", mxx))
    scale = np.where(scale > 0, scale, 1.0)
    standard = mxx / (scale[..., :, None] * scale[..., None, :])
    sign, logabs = np.linalg.slogdet(standard)
    regular = (sign > 0) & (logabs > -25.0 * p)
    standard = np.where(regular[..., None, None], standard, np.eye(p))
    slope = np.linalg.solve(standard, (mxy / scale)[..., None])[..., 0] / scale
    rss = myy - np.einsum("...i,...i->...", slope, mxy)
    with np.errstate(divide="ignore", invalid="ignore"):
        value = (n - p) * np.log(rss) + logdet + logabs + 2.0 * np.log(scale).sum(axis=-1)
    return np.where(regular & (rss > 0), value, np.inf)


class _Best(NamedTuple):
    t1: float
    t2: float
    matrix: np.ndarray
    value: float


class _Slopes(NamedTuple):
    """The criterion at a point with first and second derivatives in the log ratios (in a ratio itself where it is 0)."""

    t: np.ndarray
    matrix: np.ndarray
    logdet: float
    value: float
    first: np.ndarray  # matrices by ratio
    second: np.ndarray  # matrices by pair of ratios
    logdet_first: np.ndarray
    logdet_second: np.ndarray
    gradient: np.ndarray
    hessian: np.ndarray


def _look(
    problem: _Problem, grids: dict[str, tuple[list[float], list[float]]], best: dict[str, _Best]
) -> dict[str, tuple[float, float]]:
    """Evaluate the grids and keep each ``by``'s best point; the first of equal ones, zero before others. Returns where
    parabolas through its neighbours on the log scale are lowest."""
    starts = {}
    table = _evaluate(problem, grids)
    for b, part in table.groupby("_by"):
        part = part.sort_values(["t1", "t2"], ignore_index=True)
        values = criterion(_matrix(part, problem.q), part["logdet"].to_numpy(), problem.n[b])
        at = int(np.argmin(values))
        if b not in best or values[at] < best[b].value:
            best[b] = _Best(float(part["t1"][at]), float(part["t2"][at]), _matrix(part.iloc[[at]], problem.q)[0], float(values[at]))
        grid = np.unique(part["t1"]), np.unique(part["t2"])
        plane = values.reshape(len(grid[0]), len(grid[1]))
        x, y = divmod(at, len(grid[1]))
        starts[b] = _lowest(grid[0], plane[:, y], x), _lowest(grid[1], plane[x], y)
    return starts


def _lowest(axis: np.ndarray, values: np.ndarray, at: int) -> float:
    """Lowest point of the parabola through a point of an even log axis and its neighbours; the point where they lack."""
    if at < 2 or at + 1 >= len(axis) or not np.all(np.isfinite(values[at - 1:at + 2])):
        return float(axis[at])
    before, here, after = values[at - 1:at + 2]
    bend = before - 2 * here + after
    shift = np.clip((before - after) / (2 * bend), -0.5, 0.5) if bend > 0 else 0.0
    return float(axis[at] * (axis[at + 1] / axis[at]) ** shift)


def _powers(low: float, high: float) -> list[float]:
    return [float(np.exp(k)) for k in np.arange(low, high + 0.5)]


def _open_bracket(problem: _Problem, nested: bool, best: dict[str, _Best]) -> None:
    """Move the coarse grid on while a best ratio lies at its upper end or below its lower one."""
    span = COARSE[-1] - COARSE[0]
    low = {(b, d): COARSE[0] for b in best for d in (0, 1)}
    high = {(b, d): COARSE[-1] for b in best for d in (0, 1)}
    while True:
        grids = {}
        for b, found in best.items():
            axes = []
            for d, t in ((0, found.t1), (1, found.t2)):
                axis = [t]
                if d and not nested or not np.isfinite(found.value):
                    pass
                elif t >= np.exp(high[b, d] - 0.5) and high[b, d] < LAST_LOG:
                    top = min(high[b, d] + span, LAST_LOG)
                    axis = [t, *_powers(high[b, d], top)]
                    high[b, d] = top
                elif 0 < t <= np.exp(low[b, d] + 0.5) and low[b, d] > COARSE[0] - 2 * span:
                    axis = [0.0, t, *_powers(low[b, d] - span, low[b, d])]
                    low[b, d] -= span
                axes.append(axis)
            if max(map(len, axes)) > 1:
                grids[b] = (axes[0], axes[1])
        if not grids:
            return
        _look(problem, grids, best)


def _derivatives(problem: _Problem, points: dict[str, tuple[float, float]]) -> dict[str, _Slopes]:
    """One job: the weighted matrices, log-determinants and their derivatives at a point for each ``by``.

    In the log of a ratio t, the weight a = n/(1 + nt) has the derivatives -ar and 2ar^2 - ar with r = ta. So sums with
    a, ar and ar^2 over the size classes give those of every stratum; the stratum's own term k u u', k = t2/(1 + t2 A),
    adds products of them.
    """
    q, spark = problem.q, problem.classes.sparkSession
    table = spark.createDataFrame(
        [(b, float(t1), float(t2), problem.centre[b]) for b, (t1, t2) in points.items()],
        "_by string, t1 double, t2 double, centre array<double>",
    )
    a = "(n / (1D + n * t1))"
    r = f"if(t1 > 0, t1 * {a}, {a})"
    full, inner = pairs(q + 1), {ij: k for k, ij in enumerate(pairs(q))}
    work = problem.classes.join(F.broadcast(table), "_by").withColumns({
        "x1": F.expr(a), "x2": F.expr(f"{a} * {r}"), "x3": F.expr(f"{a} * {r} * {r}"),
    })
    d = ["1D", *[f"(mm[{i}] - centre[{i}])" for i in range(q)]]

    def square(x: str, i: int, j: int) -> str:
        own = f"g * {x} * {d[i]} * {d[j]}"
        if i == 0:
            return f"sum({own})"
        k = inner[i - 1, j - 1]
        return f"sum({own} + {x} * s[{k}]{f' + w[{k}]' if x == 'x1' else ''})"

    strata = work.groupBy("_by", "_stratum", "t1", "t2").agg(
        *[F.expr(f"array({', '.join(f'sum(g * {x} * {c})' for c in d)})").alias(f"u{x[1]}") for x in ("x1", "x2", "x3")],
        *[F.expr(f"array({', '.join(square(x, i, j) for i, j in full)})").alias(f"v{x[1]}") for x in ("x1", "x2", "x3")],
        F.expr("sum(g * log1p(n * t1))").alias("logdet"),
    )
    stages = [
        {"a": "u1[0]", "a1": "-u2[0]", "a2": "2D * u3[0] - if(t1 > 0, u2[0], 0D)"},
        {"d": "1D + t2 * a", "e": "if(t2 > 0, 1D, 0D)"},
        {"k": "t2 / d", "c": "if(t2 > 0, t2 / d, 1D)"},
        {"k1": "-k * k * a1", "k11": "2D * k * k * k * a1 * a1 - k * k * a2", "k2": "c / d",
         "k22": "-2D * c * c * a / d + e * c / d", "k12": "-2D * c * k * a1 / d"},
    ]
    for stage in stages:
        strata = strata.withColumns({name: F.expr(e) for name, e in stage.items()})

    def cells(i: int, j: int, at: int) -> dict[str, str]:
        uu = f"u1[{i}] * u1[{j}]"
        turned = f"(u2[{i}] * u1[{j}] + u1[{i}] * u2[{j}])"  # -(uu')'
        bent = f"(2D * u3[{i}] - e1 * u2[{i}]) * u1[{j}] + u1[{i}] * (2D * u3[{j}] - e1 * u2[{j}]) + 2D * u2[{i}] * u2[{j}]"
        return {
            "m": f"v1[{at}] - k * {uu}",
            "m1": f"-v2[{at}] - k1 * {uu} + k * {turned}",
            "m11": f"2D * v3[{at}] - e1 * v2[{at}] - k11 * {uu} + 2D * k1 * {turned} - k * ({bent})",
            "m2": f"-k2 * {uu}",
            "m22": f"-k22 * {uu}",
            "m12": f"-k12 * {uu} + k2 * {turned}",
        }

    strata = strata.withColumn("e1", F.expr("if(t1 > 0, 1D, 0D)"))
    by_cell = [cells(i, j, at) for at, (i, j) in enumerate(full)]
    names = list(by_cell[0])
    logs = {  # that of the units has the derivative A in the ratio itself, so t1 A in its log
        "l": "logdet + log1p(t2 * a)", "l1": "if(t1 > 0, t1, 1D) * a + k * a1",
        "l11": "if(t1 > 0, t1 * (a + a1), a1) + k * a2 + k1 * a1", "l2": "c * a",
        "l22": "-c * c * a * a + e * c * a", "l12": "c * a1 / d",
    }
    rows = strata.groupBy("_by", "t1", "t2").agg(
        *[F.expr(f"array({', '.join(f'sum({c[name]})' for c in by_cell)})").alias(name) for name in names],
        *[F.expr(f"sum({e})").alias(name) for name, e in logs.items()],
    ).collect()
    return {r["_by"]: _slopes(r, q, problem.n[r["_by"]]) for r in rows}


def _slopes(row, q: int, n: float) -> _Slopes:
    matrix, m1, m11, m2, m22, m12 = (unpack(np.array(row[c]), q + 1) for c in ("m", "m1", "m11", "m2", "m22", "m12"))
    first, second = np.array([m1, m2]), np.array([[m11, m12], [m12, m22]])
    log1, log2 = np.array([row["l1"], row["l2"]]), np.array([[row["l11"], row["l12"]], [row["l12"], row["l22"]]])
    value = float(criterion(matrix, np.array(row["l"]), n))
    gradient, hessian = np.zeros(2), np.zeros((2, 2))
    if np.isfinite(value):
        inverse = np.linalg.inv(matrix[:q, :q])
        v = np.append(-inverse @ matrix[:q, q], 1.0)
        rss = float(v @ matrix @ v)
        sides = first @ v  # by ratio
        rss1 = sides @ v
        share = [inverse @ m[:q, :q] for m in first]
        for i in range(2):
            gradient[i] = (n - q) * rss1[i] / rss + log1[i] + np.trace(share[i])
            for j in range(2):
                rss2 = v @ second[i, j] @ v - 2.0 * sides[i][:q] @ inverse @ sides[j][:q]
                hessian[i, j] = (
                    (n - q) * (rss2 / rss - rss1[i] * rss1[j] / rss**2) + log2[i, j]
                    + np.trace(inverse @ second[i, j][:q, :q]) - np.trace(share[i] @ share[j])
                )
    return _Slopes(np.array([row["t1"], row["t2"]]), matrix, row["l"], value, first, second, log1, log2, gradient, hessian)


def _step(at: _Slopes, dims: int) -> np.ndarray | None:
    """Newton's step in the log ratios, no longer than LONGEST each way; None where no ratio may move. Each ratio counts
    in the scale of its own curvature, which in a small one is by far less than in the other."""
    free = [i for i in range(dims) if at.t[i] > 0]
    if not free:
        return None
    scale = np.sqrt(np.maximum(np.abs(np.diag(at.hessian)[free]), 1e-8))
    values, vectors = np.linalg.eigh(at.hessian[np.ix_(free, free)] / np.outer(scale, scale))
    size = np.maximum(np.abs(values), 1e-8)
    move = -vectors @ ((vectors.T @ (at.gradient[free] / scale)) / size) / scale
    step = np.zeros(2)
    step[free] = np.clip(move, -LONGEST, LONGEST)
    return step


def _moved(at: _Slopes, step: np.ndarray, n: float) -> _Best:
    """The point a short step on, by the second-order expansion of its matrix and log-determinant."""
    matrix = at.matrix + np.einsum("i,ijk->jk", step, at.first) + np.einsum("i,j,ijkl->kl", step, step, at.second) / 2
    logdet = at.logdet + step @ at.logdet_first + step @ at.logdet_second @ step / 2
    t = at.t * np.exp(step)
    return _Best(float(t[0]), float(t[1]), matrix, float(criterion(matrix, np.array(logdet), n)))


def _at_zero(at: _Slopes, dims: int, left: list[int]) -> np.ndarray:
    """The ratios, with a start above zero for those at zero where the criterion falls by more than its own rounding, and
    zero for those so small that it hardly falls any more on the way there.

    ``left`` counts how often each ratio left zero. The criterion fell there, so a ratio goes back only where the other
    one has moved and the slope at zero, told from both derivatives here, has turned; and once at most."""
    t = at.t.copy()
    for i in range(dims):
        fall, rise = -at.gradient[i], at.hessian[i, i]
        if t[i] == 0 and fall > 0:
            if rise <= 0 or fall**2 / (2.0 * rise) > np.spacing(abs(at.value)):
                t[i] = min(fall / rise, np.exp(COARSE[0])) if rise > 0 else np.exp(COARSE[0])
                left[i] += 1
        elif 0 < t[i] < np.exp(COARSE[0]) and fall < 0:
            if -fall < FLAT if left[i] == 0 else dims > 1 and left[i] == 1 and -2.0 * fall >= rise:
                t[i] = 0.0
    return t


def _descend(
    problem: _Problem, nested: bool, best: dict[str, _Best], starts: dict[str, tuple[float, float]], rounds: int
) -> dict[str, _Slopes]:
    """Newton steps from the best points, one job a round for all ``by`` that still move; a step that does not lower the
    criterion is halved. ``best`` is brought up to date; returns the derivatives where each search ended."""
    dims = 2 if nested else 1
    ended: dict[str, _Slopes] = {}
    last: dict[str, tuple[_Slopes, np.ndarray]] = {}
    left = {b: [0, 0] for b in best}
    usable = {
        b: f for b, f in best.items()
        if np.isfinite(f.value) and max(f.t1, f.t2) < np.exp(LAST_LOG - 1) and independent(f.matrix[:-1, :-1]).all()
    }
    points = {b: starts.get(b, (f.t1, f.t2)) for b, f in usable.items()}
    guessed = {b for b in points if points[b] != (best[b].t1, best[b].t2)}
    for _ in range(rounds):
        if not points:
            return ended
        following = {}
        for b, at in _derivatives(problem, points).items():
            least = last[b][0].value if b in last else best[b].value if b in guessed else np.inf
            if not at.value <= least + 1e-10 * abs(least):
                if b in last:
                    last[b] = last[b][0], last[b][1] / 2
                    following[b] = tuple(last[b][0].t * np.exp(last[b][1]))
                else:
                    following[b] = best[b].t1, best[b].t2
                guessed.discard(b)
                continue
            guessed.discard(b)
            t = _at_zero(at, dims, left[b])
            step = _step(at, dims)
            if not np.array_equal(t, at.t):
                last.pop(b, None)
                following[b] = tuple(t)
            elif step is None or np.abs(step).max() <= SHORT:
                ended[b] = at
                best[b] = _moved(at, step if step is not None else np.zeros(2), problem.n[b])
            else:
                last[b] = at, step
                following[b] = tuple(at.t * np.exp(step))
        points = following
    if points:
        raise RuntimeError(f"the variance ratios did not settle in {rounds} rounds: {sorted(points.items())[:3]}")
    return ended


def _search(
    problem: _Problem, nested: bool, grid: Sequence[float] | None, rounds: int
) -> tuple[dict[str, _Best], dict[str, _Slopes]]:
    """Best ratios per ``by``: a coarse log grid, opened until the criterion turns, then Newton steps."""
    first = list(grid) if grid is not None else [0.0, *[float(np.exp(k)) for k in COARSE]]
    best: dict[str, _Best] = {}
    starts = _look(problem, {b: (first, first if nested else [0.0]) for b in problem.n}, best)
    if grid is not None:
        return best, {}
    before = dict(best)
    _open_bracket(problem, nested, best)
    starts = {b: t for b, t in starts.items() if best[b] is before[b]}
    return best, _descend(problem, nested, best, starts, rounds)


def satterthwaite(at: _Slopes | None, contrasts: np.ndarray, n: float, dims: int) -> np.ndarray:
    """Degrees of freedom of the contrasts (rows): 2 C^2 / (g' A g), with C the variance of a contrast, g its gradient in
    the logs of the residual variance and of the ratios above zero, and A twice the inverse Hessian of the restricted
    deviance there. Ratios at zero, or given, count as known."""
    q = contrasts.shape[1]
    free = [i for i in range(dims) if at is not None and at.t[i] > 0]
    if not free:
        return np.full(len(contrasts), n - q)
    inverse = np.linalg.inv(at.matrix[:q, :q])
    v = np.append(-inverse @ at.matrix[:q, q], 1.0)
    rss = float(v @ at.matrix @ v)
    rss1 = np.array([v @ m @ v for m in at.first])
    hessian = np.zeros((1 + len(free), 1 + len(free)))
    hessian[0, 0] = n - q
    scale = (n - q) / rss  # of the residual sum of squares at the variance that is best for it
    for x, i in enumerate(free, 1):
        hessian[0, x] = hessian[x, 0] = -rss1[i] * scale
        for y, j in enumerate(free, 1):
            # the profiled Hessian plus what profiling the residual variance took away
            hessian[x, y] = at.hessian[i, j] + (n - q) * rss1[i] * rss1[j] / rss**2
    spread = np.einsum("ci,ij,cj->c", contrasts, inverse, contrasts)
    gradient = [spread]
    for i in free:
        gradient.append(-np.einsum("ci,ij,cj->c", contrasts, inverse @ at.first[i][:q, :q] @ inverse, contrasts))
    gradient = np.array(gradient)
    return spread**2 / np.einsum("xc,xy,yc->c", gradient, np.linalg.inv(hessian), gradient)


def mixed_model(
    df: DataFrame,
    outcome: str,
    regressors: Sequence[str],
    unit: str,
    stratum: str | None = None,
    by: str | None = None,
    log_outcome: bool = True,
    theta_grid: Sequence[float] | None = None,
    rounds: int = ROUNDS,
    degrees: str = "satterthwaite",
    collinear: str = "drop",
) -> MixedFit:
    """Random-intercept model by restricted likelihood: unit effects, or unit effects nested in stratum effects.

    ``by`` (an imputation number or an outcome name: few values) fits one model per value in the same jobs.
    ``theta_grid`` fixes the candidate variance ratios; otherwise any ratio is found, by Newton steps on its log.
    ``degrees`` of freedom are those of Satterthwaite, or ``residual`` (rows less coefficients).
    Every value of ``by`` has its rows; a fit without numbers says why in ``status``: ``not_identified``, or
    ``unbounded`` where the criterion falls without end (no variance is left within units). Regressors that those before
    them determine have no numbers and the status ``collinear``, and the fit goes on without them; with
    ``collinear='fail'``, or where no regressor is left, such a fit is not identified.
    """
    drop = dropping(collinear)
    if degrees not in ("satterthwaite", "residual"):
        raise ValueError("degrees is 'satterthwaite' or 'residual'")
    problem = _problem(df, unit, stratum, outcome, regressors, by, log_outcome)
    best, ended = _search(problem, stratum is not None, theta_grid, rounds)
    spark = df.sparkSession
    head = f"{by} string, " if by else ""
    coefficients, variances = [], []
    terms = [INTERCEPT, *regressors]
    again: dict[tuple[str, ...], list[str]] = {}
    for b, (_, _, matrix, _) in sorted(best.items()) if drop else ():
        kept = independent(matrix[:-1, :-1])[1:]
        if kept.any() and not kept.all():
            again.setdefault(tuple(x for x, stays in zip(regressors, kept) if stays), []).append(b)
            del best[b]
    for fewer, values in again.items():
        part = df if by is None else df.filter(F.col(quoted(by)).cast("string").isin(values))
        fit = mixed_model(part, outcome, fewer, unit, stratum, by, log_outcome, theta_grid, rounds, degrees, "fail")
        rows = fit.coefficients.collect()
        coefficients += map(tuple, rows)
        for b in values:
            n = problem.n[b]
            coefficients += [(*((b,) if by else ()), *dropped_row(x, n)) for x in regressors if x not in fewer]
        variances += map(tuple, fit.variances.collect())
    for b, (t1, t2, matrix, value) in sorted(best.items()):
        key = (b,) if by else ()
        n, p = problem.n[b], problem.q
        mxx, mxy, myy = matrix[:p, :p], matrix[:p, p], matrix[p, p]
        status = "ok"
        if not np.isfinite(value) or is_singular(mxx) or not independent(mxx).all():
            status = "not_identified"
        elif max(t1, t2) >= np.exp(LAST_LOG - 1):
            status = "unbounded"
        if status != "ok":
            coefficients += [(*key, term, None, None, None, None, None, int(n), status) for term in terms]
            variances.append((*key, int(n), int(problem.units[b]), *[None] * 6, status))
            continue
        inverse = np.linalg.inv(mxx)
        beta = inverse @ mxy
        sigma2 = float(myy - beta @ mxy) / (n - p)
        centre = np.array(problem.centre[b])
        shift = np.concatenate([[1.0], -centre[:-1]])
        estimates = np.concatenate([[beta @ shift + centre[-1]], beta[1:]])
        contrasts = np.vstack([shift, np.eye(p)[1:]])
        spread = np.einsum("ci,ij,cj->c", contrasts, inverse, contrasts) * sigma2
        free = satterthwaite(ended.get(b) if degrees == "satterthwaite" else None, contrasts, n, 1 + (stratum is not None))
        for term, est, var, rest in zip(terms, estimates, spread, free.tolist()):
            se = float(np.sqrt(var))
            t = float(est / se)
            coefficients.append((*key, term, float(est), se, t, rest, t_two_sided(t, rest), int(n), status))
        variances.append((
            *key, int(n), int(problem.units[b]), float(t1), float(t2), sigma2, float(t1 * sigma2), float(t2 * sigma2), value,
            status,
        ))
    release(problem.classes)
    return MixedFit(
        spark.createDataFrame(coefficients, head + COEFFICIENTS), spark.createDataFrame(variances, head + VARIANCES)
    )


def control_outcomes(
    df: DataFrame,
    outcomes: Sequence[str],
    regressors: Sequence[str],
    unit: str,
    stratum: str | None = None,
    log_outcome: bool = True,
    theta_grid: Sequence[float] | None = None,
    degrees: str = "satterthwaite",
) -> DataFrame | None:
    """The mixed model for every listed outcome that exists, all in the same jobs; None if none exists."""
    present = [o for o in outcomes if o in df.columns]
    if not present:
        return None
    keys = [unit] + ([stratum] if stratum else [])
    stacked = df.select(
        *keys,
        *regressors,
        F.explode(F.array(*[
            F.struct(F.lit(o).alias("outcome"), F.col(quoted(o)).cast("double").alias("_value")) for o in present
        ])).alias("_o"),
    ).select(*keys, *regressors, "_o.outcome", "_o._value")
    fit = mixed_model(stacked, "_value", regressors, unit, stratum, "outcome", log_outcome, theta_grid, degrees=degrees)
    return fit.coefficients


LEAVE_ONE_OUT = "estimate double, std_error double, theta double, n_obs long, status string"


def leave_one_out_mixed(
    df: DataFrame,
    unit: str,
    outcome: str,
    exposure: str,
    covariates: Sequence[str] = (),
    log_outcome: bool = True,
    theta_grid: Sequence[float] | None = None,
) -> DataFrame:
    """Exposure coefficient of the random-intercept model without each unit in turn.

    The totals at a grid of variance ratios, less the unit's own term, give every refit; nothing is scanned again.
    With a fixed ``theta_grid`` the best grid point is used. Otherwise the ratio is refined between the points of a
    fine log grid, on which every entry of the totals is a smooth function; the grid grows until no unit's best ratio
    lies at its end.
    """
    names = [exposure, *covariates]
    q = len(names) + 1
    work = df.filter(F.col(quoted(unit)).isNotNull()).withColumns({"_by": F.lit(""), "_stratum": F.lit("")})
    units = materialise(unit_moments(work, unit, outcome, names, ["_by", "_stratum"], log_outcome))
    classes = materialise(size_classes(units, q, ["_by", "_stratum"]))
    rows = F.col("g") * F.col("n")
    total = classes.agg(
        F.sum(rows).alias("n"), F.array(*[F.sum(rows * F.col("mm")[i]) / F.sum(rows) for i in range(q)]).alias("centre")
    ).first()
    if total["n"] is None:
        raise ValueError("no complete row to fit")
    refine = theta_grid is None
    problem = _Problem(classes, {"": list(total["centre"])}, {"": total["n"]}, {"": 0.0}, q)
    centre, n_all = np.array(total["centre"], dtype=float), float(total["n"])
    out = T.StructType([units.schema[unit]] + T.StructType.fromDDL(LEAVE_ONE_OUT).fields)
    last = COARSE[-1]
    while True:
        grid = [0.0, *np.exp(np.arange(4 * COARSE[0], 4 * last + 1) / 4)] if refine else sorted(map(float, theta_grid))
        thetas = np.array(grid, float)
        table = _evaluate(problem, {"": (thetas.tolist(), [0.0])}).sort_values("t1", ignore_index=True)
        totals, logdets = _matrix(table, q), table["logdet"].to_numpy()

        def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for frame in frames:
                for start in range(0, len(frame), 256):
                    part = frame.iloc[start:start + 256]
                    yield _refit(part, unit, thetas, totals, logdets, centre, n_all, refine, out.names)

        rest = materialise(units.select(unit, "n", "m", "c").mapInPandas(run, out))
        if not refine or last >= LAST_LOG or rest.filter(F.col("theta") >= float(np.exp(last - 1))).isEmpty():
            release(units, classes)
            return rest
        release(rest)
        last = min(2 * last, LAST_LOG)


def _own(n: np.ndarray, d: np.ndarray, c: np.ndarray, theta: np.ndarray) -> np.ndarray:
    """A unit's term of the weighted matrix at its ratio(s); shapes broadcast to (units, ratios)."""
    a = (n[:, None] / (1.0 + n[:, None] * theta))[..., None, None]
    return c[:, None] + a * (d[:, :, None] * d[:, None, :])[:, None]


def _refit(part, unit, thetas, totals, logdets, centre, n_all, refine, names) -> pd.DataFrame:
    q = len(centre)
    n = part["n"].to_numpy(dtype=float)
    d = np.concatenate([np.ones((len(part), 1)), np.stack(part["m"].to_numpy()).astype(float) - centre], axis=1)
    c = np.zeros((len(part), q + 1, q + 1))
    c[:, 1:, 1:] = unpack(np.stack(part["c"].to_numpy()), q)
    rest_n = n_all - n
    matrix = totals[None] - _own(n, d, c, thetas[None, :])
    logdet = logdets[None] - np.log1p(n[:, None] * thetas[None, :])
    values = criterion(matrix, logdet, rest_n[:, None])
    at = np.argmin(values, axis=1)
    index = np.arange(len(part))
    theta, chosen, best = thetas[at], matrix[index, at], values[index, at]
    if refine:
        theta, chosen, best = _refine(n, d, c, rest_n, at, theta, chosen, best, thetas, totals, logdets)
    p = q
    good = (rest_n > p) & np.isfinite(best)
    mxx = np.where(good[:, None, None], chosen[:, :p, :p], np.eye(p))
    inverse = np.linalg.inv(mxx)
    beta = np.einsum("gij,gj->gi", inverse, chosen[:, :p, p])
    sigma2 = (chosen[:, p, p] - np.einsum("gi,gi->g", beta, chosen[:, :p, p])) / np.maximum(rest_n - p, 1.0)
    return pd.DataFrame({
        names[0]: part[unit].to_numpy(),
        "estimate": np.where(good, beta[:, 1], np.nan),
        "std_error": np.where(good, np.sqrt(np.clip(sigma2 * inverse[:, 1, 1], 0.0, None)), np.nan),
        "theta": np.where(good, theta, np.nan),
        "n_obs": rest_n.astype("int64"),
        "status": np.where(good, "ok", np.where(rest_n > p, "not_identified", "too_few_rows")),
    })


def _lagrange(position: np.ndarray, grid: np.ndarray, values: np.ndarray) -> np.ndarray:
    """Cubic interpolation of ``values`` (first axis: an even grid) at fractional positions."""
    base = np.clip(np.floor(position).astype(int) - 1, 0, len(grid) - 4)
    t = position - base
    weights = np.stack([
        -(t - 1) * (t - 2) * (t - 3) / 6.0,
        t * (t - 2) * (t - 3) / 2.0,
        -t * (t - 1) * (t - 3) / 2.0,
        t * (t - 1) * (t - 2) / 6.0,
    ])
    return sum(
        w.reshape(w.shape + (1,) * (values.ndim - 1)) * values[base + k] for k, w in enumerate(weights)
    )


def _refine(n, d, c, rest_n, at, theta, chosen, best, thetas, totals, logdets):
    """Golden-section search on the log ratio around each unit's best grid point (a best of zero stays)."""
    log_grid = np.log(thetas[1:])
    step = log_grid[1] - log_grid[0]
    inner = at >= 1
    low = np.clip(at - 2, 0, len(log_grid) - 1).astype(float)
    high = np.clip(at, 0, len(log_grid) - 1).astype(float)

    def look(position: np.ndarray):
        ratio = np.exp(log_grid[0] + position * step)
        whole = _lagrange(position, log_grid, totals[1:])
        m = whole - _own(n, d, c, ratio[:, None])[:, 0]
        ld = _lagrange(position, log_grid, logdets[1:]) - np.log1p(n * ratio)
        return ratio, m, criterion(m, ld, rest_n)

    golden = (np.sqrt(5.0) - 1.0) / 2.0
    for _ in range(30):
        left, right = high - golden * (high - low), low + golden * (high - low)
        worse = look(left)[2] > look(right)[2]
        low, high = np.where(worse, left, low), np.where(worse, high, right)
    ratio, m, value = look((low + high) / 2.0)
    use = inner & (value < best)
    return (
        np.where(use, ratio, theta),
        np.where(use[:, None, None], m, chosen),
        np.where(use, value, best),
    )

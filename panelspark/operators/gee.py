"""Marginal linear model with first-order autoregressive working correlation and robust errors."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.tails import normal_two_sided
from panelspark.operators.linear import COEFFICIENTS, INTERCEPT, dropped_row, dropping, prepare
from panelspark.operators.moments import complete_rows, independent, is_singular, pairs, unpack
from panelspark.operators.quality import guard
from panelspark.operators.schema import quoted
from panelspark.session import materialise, release

#: Correlations at the mean gap where the search for alpha starts.
_GRID = sorted(sign * u for u in (
    *(i / 10 for i in range(1, 10)), 1e-6, 0.02, 0.05, 0.95, 0.98, 0.99, 0.999, 0.9999, 0.99999, 1 - 1e-7
) for sign in (-1, 1)) + [0.0]
_GRID.sort()


class GeeFit(NamedTuple):
    coefficients: DataFrame
    working: DataFrame


class _Trial(NamedTuple):
    """A fit at one alpha: the estimating function (positive below the root), the sum of squares less a constant."""

    alpha: float
    function: float
    squares: float
    matrix: np.ndarray
    beta: np.ndarray
    phi: float


def _root(judged: Callable[[Sequence[float]], list[_Trial]], grid: Sequence[float], rounds: int) -> float:
    """The alpha of least squares: the best crossing of the grid is narrowed until it is as short as rounding allows.

    A round tries the point where a line through the ends crosses and points at falling distances from it, so the
    interval shrinks by much more than half a round.
    """
    tried = judged(grid)
    crossings = [(a, b) for a, b in zip(tried, tried[1:]) if a.function > 0 >= b.function]
    best = min((min(a.squares, b.squares) for a, b in crossings), default=math.inf)
    if tried[-1].function > 0 and tried[-1].squares <= best:
        raise RuntimeError("the working correlation is not below one")
    if tried[0].function <= 0 and tried[0].squares <= best:
        if tried[0].alpha < 0:
            raise RuntimeError("the working correlation is not above minus one")
        return 0.0  # gaps of any length: correlations are not negative
    low, high = min(crossings, key=lambda ends: min(e.squares for e in ends))
    for _ in range(rounds - 1):
        width = high.alpha - low.alpha
        crossing = low.alpha + width * low.function / (low.function - high.function)
        if width <= 1e-13 * abs(crossing) + 1e-300 or high.function == 0:
            return high.alpha if high.function == 0 else crossing
        near = [crossing + sign * width * step for step in (0, 1e-1, 1e-2, 1e-4, 1e-7) for sign in (-1, 1)]
        inside = sorted({x for x in (*near, low.alpha + width / 2) if low.alpha < x < high.alpha})
        if not inside:
            return crossing
        ends = [low, *judged(inside), high]
        low, high = next((a, b) for a, b in zip(ends, ends[1:]) if a.function > 0 >= b.function)
    raise RuntimeError(f"the working correlation did not settle in {rounds} rounds; it lies in {low.alpha}..{high.alpha}")


def period_number(df: DataFrame, period: str) -> Column:
    """The period as a number: days for dates and timestamps, numbers as they are."""
    kind = df.schema[period].dataType
    c = F.col(quoted(period))
    if isinstance(kind, T.DateType):
        return F.unix_date(c).cast("double")
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.unix_micros(c.cast("timestamp")) / F.lit(86_400e6)
    if isinstance(kind, T.NumericType):
        return c.cast("double")
    raise TypeError(f"period {period} is neither a number nor a date: {kind.simpleString()}")


def previous_row(df: DataFrame, unit: str, period: str, columns: Sequence[str], out: str = "_prev") -> DataFrame:
    """Add the unit's preceding row in period order as a struct (null for its first row).

    Rows are dealt out by ranges of (unit, period), so a unit with most of the rows spreads over many tasks. Each range
    is linked up on its own; its first row of a unit takes the last row of that unit from the ranges before. Writing in
    between fixes the ranges. A repeated (unit, period), which has no order, fails the query.
    """
    ranged = df.repartitionByRange(unit, period).withColumn("_pid", F.spark_partition_id())
    fixed = materialise(ranged)
    row = F.struct(quoted(period), *[quoted(c) for c in columns if c != period])
    inside = fixed.withColumn(out, F.lag(row).over(Window.partitionBy(unit, "_pid").orderBy(period)))
    lasts = fixed.groupBy(unit, "_pid").agg(F.max_by(row, quoted(period)).alias("_last"))
    carried = lasts.select(
        unit, "_pid", F.lag("_last").over(Window.partitionBy(unit).orderBy("_pid")).alias("_carried")
    )
    joined = inside.join(carried, [unit, "_pid"], "left").withColumn(out, F.coalesce(out, "_carried"))
    where = F.concat_ws(", ", F.col(quoted(unit)).cast("string"), F.col(quoted(period)).cast("string"))
    twice = F.col(f"{out}.{quoted(period)}") == F.col(quoted(period))
    checked = guard(F.col(out), twice, F.concat(F.lit("repeated unit and period: "), where))
    return joined.withColumn(out, checked).drop("_pid", "_carried")


def gee_ar1(
    df: DataFrame,
    outcome: str,
    regressors: Sequence[str],
    unit: str,
    period: str,
    log_outcome: bool = True,
    alpha: float | None = None,
    rounds: int = 50,
    gap: str = "ignore",
    collinear: str = "drop",
) -> GeeFit:
    """Estimating equations with AR(1) working correlation; ``gap='power'`` uses alpha to the period distance.

    Periods are numbers, dates or timestamps (distances in days); (unit, period) must be unique. Whitening combines a
    row and its predecessor with weights that depend on alpha only, so the cross-products of rows, predecessors and
    row-predecessor pairs, summed per unit and gap once, serve every trial; the driver sees their p x p totals.

    Alpha, unless given, uses the pairs of all gaps g: it makes the sum of squares of (r s / phi - alpha**g) over them
    least, in a joint solution with the coefficients, where r and s are residuals of a row and its predecessor; products
    are worth (pairs - coefficients) / pairs each. With gaps of one only, that is the lag-one moment estimate. Negative
    values are searched if all gaps are whole numbers and the smallest is odd. Without more pairs than coefficients alpha
    is 0 and the status says so. The errors are the unit-clustered sandwich. A best value at one or beyond, and a search
    that does not settle in ``rounds`` jobs, are errors. Regressors that those before them determine have no numbers and
    the status ``collinear``; with ``collinear='fail'`` they are an error.
    """
    drop = dropping(collinear)
    if gap not in ("ignore", "power"):
        raise ValueError("gap is 'ignore' or 'power'")
    names = [*regressors, "_y"]
    work = complete_rows(prepare(df, outcome, regressors, [unit, period], log_outcome), names)
    work = work.dropna(subset=[unit, period]).withColumn("_t", period_number(df, period))
    means = work.agg(*[F.avg(quoted(c)) for c in names]).first()
    if means[0] is None:
        raise ValueError("no complete row to fit")
    centre = np.array(means, dtype=float)
    shifted = work.select(unit, "_t", *[(F.col(quoted(c)) - F.lit(float(s))).alias(c) for c, s in zip(names, centre)])
    paired = previous_row(shifted, unit, "_t", names)
    step = F.lit(1.0) if gap == "ignore" else F.col("_t") - F.col("_prev._t")
    k = len(names) + 1
    now = ["1D", *[quoted(c) for c in names]]
    before = ["1D", *[f"_prev.{quoted(c)}" for c in names]]
    pair_list = pairs(k)
    full = [(i, j) for i in range(k) for j in range(k)]
    lagged = paired.withColumn("gap", F.when(F.col("_prev").isNull(), F.lit(0.0)).otherwise(step))

    def sums(parts: list[str]) -> Column:
        return F.expr(f"array({', '.join(f'coalesce(sum({part}), 0D)' for part in parts)})")

    # A first row has no predecessor: its products are null and add nothing.
    per_unit = materialise(
        lagged.groupBy(unit, "gap").agg(
            F.expr("double(count(1))").alias("n"),
            sums([f"{now[i]} * {now[j]}" for i, j in pair_list]).alias("a"),
            sums([f"if(gap > 0, {now[i]} * {before[j]}, NULL)" for i, j in full]).alias("b"),
            sums([f"if(gap > 0, {before[i]} * {before[j]}, NULL)" for i, j in pair_list]).alias("c"),
        )
    )
    by_gap = materialise(
        per_unit.groupBy("gap").agg(
            F.sum("n").alias("n"),
            sums([f"a[{i}]" for i in range(len(pair_list))]).alias("a"),
            sums([f"b[{i}]" for i in range(len(full))]).alias("b"),
            sums([f"c[{i}]" for i in range(len(pair_list))]).alias("c"),
        )
    )
    total = by_gap.agg(F.sum("n").alias("n"), sums([f"a[{i}]" for i in range(len(pair_list))]).alias("a")).first()
    n, whole = total["n"], unpack(np.array(total["a"]), k)
    kept = independent(whole[:-1, :-1])[1:]
    if drop and not kept.all():
        release(per_unit, by_gap)
        fewer = [x for x, stays in zip(regressors, kept) if stays]
        fit = gee_ar1(df, outcome, fewer, unit, period, log_outcome, alpha, rounds, gap, "fail")
        found = {r["term"]: tuple(r) for r in fit.coefficients.collect()}
        rows = [found.get(term) or dropped_row(term, n) for term in (INTERCEPT, *regressors)]
        return GeeFit(df.sparkSession.createDataFrame(rows, COEFFICIENTS), fit.working)
    p = k - 1
    place = {ij: i for i, ij in enumerate(pair_list)}

    def at(i: int, j: int) -> int:
        return place[min(i, j), max(i, j)]

    gaps = by_gap.filter("gap > 0").agg(
        F.sum("n").alias("n"), F.min("gap").alias("least"), (F.sum(F.col("n") * F.col("gap")) / F.sum("n")).alias("mean"),
        F.bool_and(F.col("gap") == F.floor("gap")).alias("whole"),
    ).first()
    enough = gaps["n"] is not None and gaps["n"] > p

    def judged(alphas: Sequence[float]) -> list[_Trial]:
        """One job: the fit at each alpha, its estimating function and its sum of squares."""
        f, both = "pow(alpha, gap)", [f"(b[{i * k + j}] + b[{j * k + i}])" for i, j in pair_list]
        spread = f"greatest(1D - {f} * {f}, 2e-16D)"
        kept = [f"if(gap = 0, a[{at(i, j)}], (a[{at(i, j)}] - {f} * {s} + {f} * {f} * c[{at(i, j)}]) / {spread})"
                for (i, j), s in zip(pair_list, both)]
        slope = f"if(gap > 0, gap * pow(alpha, gap - {gaps['least'] or 0.0!r}D), 0D)"
        level = f"if(gap > 0, {f}, 0D)"
        grid = F.explode(F.array(*[F.lit(float(x)) for x in alphas])).alias("alpha")
        rows = by_gap.select("*", grid).groupBy("alpha").agg(
            sums(kept).alias("m"), sums([f"{slope} * {s} / 2" for s in both]).alias("s"),
            sums([f"{level} * {s} / 2" for s in both]).alias("f"),
            sums([f"{slope} * {f} * n", f"{level} * {level} * n"]).alias("n"),
        ).collect()
        return [trial(r) for r in sorted(rows, key=lambda r: r["alpha"])]

    def trial(r) -> _Trial:
        matrix = unpack(np.array(r["m"]), k)
        if is_singular(matrix[:p, :p]):
            raise ValueError("regressors are collinear")
        beta = np.linalg.solve(matrix[:p, :p], matrix[:p, p])
        v = np.append(-beta, 1.0)
        phi = float(v @ whole @ v) / (n - p)
        share = (gaps["n"] - p) / gaps["n"] if enough else 0.0
        steep, flat = (float(v @ unpack(np.array(r[c]), k) @ v) / phi if phi > 0 else 0.0 for c in "sf")
        return _Trial(r["alpha"], steep - share * r["n"][0], share * r["n"][1] - 2 * flat, matrix, beta, phi)

    if alpha is not None and abs(alpha) >= 1.0:
        raise ValueError("alpha lies between -1 and 1")
    if alpha is not None or not enough:
        rho = float(alpha or 0.0)
    else:
        signed = gaps["whole"] and gaps["least"] % 2 == 1
        rho = _root(judged, [math.copysign(abs(u) ** (1.0 / gaps["mean"]), u) for u in _GRID if signed or u >= 0], rounds)
    status = "ok" if enough or alpha is not None else "too_few_pairs"
    _, _, _, matrix, beta, phi = judged([rho])[0]
    bread = np.linalg.inv(matrix[:p, :p])
    v = [f"({float(x)!r}D)" for x in np.append(-beta, 1.0)]
    f = f"pow({rho!r}D, gap)"
    scores = []
    for i in range(p):
        own = " + ".join(f"a[{at(i, j)}] * {v[j]}" for j in range(k))
        mixed = " + ".join(f"(b[{i * k + j}] + b[{j * k + i}]) * {v[j]}" for j in range(k))
        past = " + ".join(f"c[{at(i, j)}] * {v[j]}" for j in range(k))
        weighted = f"(({own}) - {f} * ({mixed}) + {f} * {f} * ({past})) / (1D - {f} * {f})"
        scores.append(F.expr(f"sum(CASE WHEN gap = 0 THEN {own} ELSE {weighted} END)").alias(f"s{i}"))
    meat = per_unit.groupBy(unit).agg(*scores).agg(sums([f"s{i} * s{j}" for i, j in pairs(p)]).alias("meat")).first()
    release(per_unit, by_gap)
    covariance = bread @ unpack(np.array(meat["meat"]), p) @ bread
    shift = np.concatenate([[1.0], -centre[:-1]])
    estimates = np.concatenate([[beta @ shift + centre[-1]], beta[1:]])
    errors = np.sqrt(np.concatenate([[shift @ covariance @ shift], np.diag(covariance)[1:]]))
    rows = []
    for term, est, se in zip([INTERCEPT, *regressors], estimates, errors):
        z = float(est / se) if se > 0 else None
        rows.append((term, float(est), float(se), z, None, normal_two_sided(z), int(n), status))
    spark = df.sparkSession
    working = spark.createDataFrame([(float(rho), float(phi), int(n))], "alpha double, scale double, n_obs long")
    return GeeFit(spark.createDataFrame(rows, COEFFICIENTS), working)

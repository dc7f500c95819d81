"""Composite indices: standard scores, oriented first principal component, reliability, equal weights, quartiles."""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numeric import row_mean, z_score
from panelspark.operators.moments import complete_rows, moment_columns, unpack
from panelspark.operators.quality import QualityError
from panelspark.operators.quantiles import exact_quantiles
from panelspark.operators.schema import quoted
from panelspark.session import materialise

DIAGNOSTICS = (
    "component string, mean double, sd double, loading double, explained double, n_rows long, n_units long"
)


class IndexResult(NamedTuple):
    panel: DataFrame
    diagnostics: DataFrame


def standardise(df: DataFrame, columns: Sequence[str], sample: bool = False, suffix: str = "_z") -> DataFrame:
    """Add standard scores over each column's own non-null rows; a constant column is only centred.

    The statistics are a one-row scalar subquery of the same plan.
    """
    sd = F.stddev_samp if sample else F.stddev_pop
    parts = []
    for i, c in enumerate(columns):
        parts += [F.avg(quoted(c)).alias(f"m{i}"), sd(quoted(c)).alias(f"s{i}")]
    stats = df.agg(F.struct(*parts).alias("s")).scalar()
    scored = {
        c + suffix: z_score(F.col(quoted(c)), stats[f"m{i}"], stats[f"s{i}"]) for i, c in enumerate(columns)
    }
    return df.withColumns(scored)


def first_component(correlation: np.ndarray, orient: int = 0) -> tuple[np.ndarray, float]:
    """Unit loading vector of the first component, oriented so that ``orient`` loads >= 0, and its explained share."""
    values, vectors = np.linalg.eigh(correlation)
    loading = vectors[:, -1]
    total = float(np.trace(correlation))
    return loading * (1.0 if loading[orient] >= 0 else -1.0), float(values[-1] / total) if total > 0 else float("nan")


def pca_index(
    df: DataFrame,
    components: Sequence[str],
    unit: str,
    orient: str | None = None,
    out: str = "index",
    min_rows: int = 10,
    min_units: int = 5,
) -> IndexResult:
    """Score of the first principal component of the standardised components on complete rows, null elsewhere.

    One aggregation yields everything; only k x k numbers reach the driver. Components without any value are left out.
    """
    names = list(components)
    row = _component_stats(df, names, unit)
    filled = [c for i, c in enumerate(names) if row[f"f{i}"] > 0]
    if len(filled) < 2:
        raise QualityError(f"the index needs two components with data, found {filled}")
    if filled != names:
        names = filled
        row = _component_stats(df, names, unit)
    if row["n"] < min_rows or row["n_units"] < min_units:
        raise QualityError(f"too few complete rows for the index: {row['n']} rows of {row['n_units']} units")
    mean = np.array(row["m"])
    cross = unpack(np.array(row["c"]), len(names)) / row["n"]
    sd = np.sqrt(np.diag(cross))
    scale = np.where(sd > 0, sd, 1.0)
    anchor = names.index(orient) if orient in names else 0
    loading, explained = first_component(cross / np.outer(scale, scale), anchor)
    score: Column = F.lit(0.0)
    for c, centre, width, weight in zip(names, mean, scale, loading):
        score = score + (F.col(quoted(c)) - F.lit(float(centre))) * F.lit(float(weight / width))
    rows = [
        (c, float(m), float(s), float(w), explained, int(row["n"]), int(row["n_units"]))
        for c, m, s, w in zip(names, mean, scale, loading)
    ]
    return IndexResult(df.withColumn(out, score), df.sparkSession.createDataFrame(rows, DIAGNOSTICS))


def _component_stats(df: DataFrame, names: Sequence[str], unit: str):
    """Moments and units of the complete rows plus the non-null count of every component, in one pass."""
    complete = F.lit(True)
    for name in names:
        complete = complete & F.col(quoted(name)).isNotNull()
    kept = [F.when(complete, F.col(quoted(name)).cast("double")).alias(f"x{i}") for i, name in enumerate(names)]
    own = [F.col(quoted(name)).alias(f"p{i}") for i, name in enumerate(names)]
    work = df.select(*kept, *own, F.when(complete, F.col(unit)).alias("unit"))
    return work.agg(
        *moment_columns([f"x{i}" for i in range(len(names))]),
        F.countDistinct("unit").alias("n_units"),
        *[F.count(f"p{i}").alias(f"f{i}") for i in range(len(names))],
    ).first()


def cronbach_alpha(df: DataFrame, items: Sequence[str], count_constant: bool = True) -> DataFrame:
    """Standardised reliability over complete rows: ``(n_rows, n_items, alpha)``, alpha null where undefined.

    A constant item has no standard score and adds nothing to the sums; ``count_constant`` says whether it still
    counts as an item.
    """
    kept = complete_rows(df, items).agg(*moment_columns(items))
    k = len(items)
    position, index = {}, 0
    for i in range(k):
        for j in range(i, k):
            position[i, j] = index
            index += 1

    def cross(i: int, j: int) -> Column:
        return F.col("c")[position[min(i, j), max(i, j)]]

    def r(i: int, j: int) -> Column:
        return F.coalesce(F.try_divide(cross(i, j), F.sqrt(cross(i, i) * cross(j, j))), F.lit(0.0))

    varying: Column = F.lit(0.0)
    total: Column = F.lit(0.0)
    for i in range(k):
        varying = varying + (cross(i, i) > 0).cast("double")
        for j in range(k):
            total = total + r(i, j)
    used = F.lit(float(k)) if count_constant else varying
    alpha = F.try_divide(used, used - 1) * (F.lit(1.0) - F.try_divide(varying, total))
    defined = (F.col("n") >= 3) & (F.lit(k) >= 2) & (total > 1e-12) & (used >= 2)
    return kept.select(F.col("n").cast("long").alias("n_rows"), F.lit(k).alias("n_items"), F.when(defined, alpha).alias("alpha"))


def equal_weight_index(df: DataFrame, components: Sequence[str], out: str = "index_equal") -> DataFrame:
    """Mean of the components' sample standard scores over the non-null ones; a constant component drops out."""
    if len(components) < 2:
        raise QualityError("the equal-weight index needs two components")
    parts = []
    for i, c in enumerate(components):
        parts += [F.avg(quoted(c)).alias(f"m{i}"), F.stddev_samp(quoted(c)).alias(f"s{i}")]
    stats = df.agg(F.struct(*parts).alias("s")).scalar()
    scores = [
        F.try_divide(F.col(quoted(c)) - stats[f"m{i}"], stats[f"s{i}"]) for i, c in enumerate(components)
    ]
    return df.withColumn(out, row_mean(scores))


def bin_labels(value: Column, edges: Sequence[float], stem: str = "Q") -> Column:
    """Right-closed bins with the lowest edge included, labelled by position; tied edges merge their bins."""
    unique = [e for i, e in enumerate(edges) if i == 0 or e > edges[i - 1]]
    if len(unique) < 2:
        return F.when(value.isNotNull(), F.lit(f"{stem}1"))
    label = None
    for i, high in enumerate(unique[1:], start=1):
        inside = value <= F.lit(float(high)) if i < len(unique) - 1 else value.isNotNull()
        label = F.when(inside, F.lit(f"{stem}{i}")) if label is None else label.when(inside, F.lit(f"{stem}{i}"))
    return label


def quantile_table(
    df: DataFrame, index: str, summaries: Sequence[str], bins: int = 4, out: str = "quartile"
) -> DataFrame:
    """Mean of each summary column per quantile bin of the index. What it needs of ``df`` is computed and written once."""
    needed = list(dict.fromkeys([index, *summaries]))
    kept = materialise(df.dropna(subset=[index]).select(*map(quoted, needed)))
    edges = exact_quantiles(kept, index, [i / bins for i in range(bins + 1)])
    if not edges:
        raise QualityError(f"{index} has no value")
    labelled = kept.withColumn(out, bin_labels(F.col(quoted(index)), edges))
    return labelled.groupBy(out).agg(*[F.avg(quoted(c)).alias(c) for c in summaries])

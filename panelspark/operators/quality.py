"""Data-quality gates.

Each gate returns a report DataFrame; the ``assert_*`` forms run one job and raise. ``guard`` puts a failing check
inside the plan, so that it costs no job of its own.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelspark.operators.schema import quoted


class QualityError(ValueError):
    """A gate found violations."""


def guard(value: Column, broken: Column, message: Column) -> Column:
    """``value``, or an error at run time where ``broken`` holds."""
    return F.when(F.coalesce(broken, F.lit(False)), F.raise_error(message)).otherwise(value)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their row count (counts combine map-side, so a hot key is cheap)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).filter("n_rows > 1")


def assert_unique(df: DataFrame, keys: Sequence[str], what: str = "table", examples: int = 10) -> DataFrame:
    found = duplicate_keys(df, keys).orderBy(*keys).limit(examples).collect()
    if found:
        rows = "; ".join(", ".join(f"{k}={r[k]}" for k in keys) for r in found)
        raise QualityError(f"{what}: duplicate keys {list(keys)}: {rows}")
    return df


def range_violations(df: DataFrame, ranges: Mapping[str, tuple[float, float]]) -> DataFrame:
    """Per column: non-null values and how many lie outside the closed range; one aggregation for all columns."""
    parts = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.count(quoted(name)).alias("n_values"),
            F.count_if(~F.col(quoted(name)).between(low, high)).alias("n_outside"),
        )
        for name, (low, high) in ranges.items()
    ]
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def assert_ranges(df: DataFrame, ranges: Mapping[str, tuple[float, float]], what: str = "table") -> DataFrame:
    bad = {r["column_name"]: r["n_outside"] for r in range_violations(df, ranges).filter("n_outside > 0").collect()}
    if bad:
        raise QualityError(f"{what}: values outside {({c: ranges[c] for c in bad})}: {bad}")
    return df


def missing_categories(df: DataFrame, column: str, required: DataFrame) -> DataFrame:
    """Required categories (single-column table) that never occur."""
    name = required.columns[0]
    present = df.select(F.col(column).alias(name)).distinct()
    return required.join(present, name, "left_anti")


def coverage_profile(df: DataFrame, unit: str, period: str, category: str | None = None) -> DataFrame:
    """Rows, units, period span and (optionally) the number of categories.

    Rows first shrink to one per unit (and category) map-side; the distinct counts then run on that small table.
    """
    keys = [unit, *([category] if category else [])]
    reduced = df.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.min(period).alias("first"), F.max(period).alias("last")
    )
    parts = [
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
        F.countDistinct(unit).alias("n_units"),
        F.min("first").alias("first_period"),
        F.max("last").alias("last_period"),
    ]
    if category:
        parts.append(F.countDistinct(category).alias("n_categories"))
    return reduced.agg(*parts)


def null_profile(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Nulls per column."""
    parts = [
        F.struct(F.lit(c).alias("column_name"), F.count_if(F.col(quoted(c)).isNull()).alias("n_null"))
        for c in (columns or df.columns)
    ]
    return df.agg(F.array(*parts).alias("parts")).select(F.inline("parts"))


def missing_pattern(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per pattern of present (1) and missing (0) columns."""
    flags = [F.col(quoted(c)).isNotNull().cast("int").alias(c) for c in columns]
    counted = df.select(*flags).groupBy(*columns).agg(F.count(F.lit(1)).alias("n_rows"))
    absent = reduce(lambda a, b: a + b, [F.lit(1) - F.col(quoted(c)) for c in columns])
    return counted.withColumn("n_missing", absent)


def filled_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows with at least one of the columns, and non-null values per column."""
    any_filled = F.coalesce(*[F.col(quoted(c)).cast(T.StringType()) for c in columns]).isNotNull()
    counts = [F.count(quoted(c)).alias(f"n_{c}") for c in columns]
    return df.agg(F.count_if(any_filled).alias("n_any"), *counts)


def assert_not_empty(df: DataFrame, what: str = "table") -> DataFrame:
    if df.isEmpty():
        raise QualityError(f"{what}: no row left")
    return df

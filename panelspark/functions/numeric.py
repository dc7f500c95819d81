"""Numeric Column expressions: lenient casts, row-wise statistics, spline terms."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:inf|infinity)$"


def to_double(c: Column) -> Column:
    """Lenient cast; text that is no plain number (such as ``7D`` or ``1.5f``) and NaN both become null."""
    text = F.trim(c.cast("string"))
    return F.when(text.rlike(NUMBER), text.try_cast("double"))


def to_int(c: Column) -> Column:
    """Lenient cast through double, so that ``'6.0'`` is 6."""
    return to_double(c).try_cast("int")


def number_array(values: Sequence[float]) -> Column:
    """Constant array of doubles from one literal (folded at planning; a literal per value is slow to build)."""
    return F.split(F.lit(",".join(repr(float(v)) for v in values)), ",").cast("array<double>")


def no_nan(c: Column) -> Column:
    return F.when(~F.isnan(c), c)


def _sum(columns: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, columns)


def row_sum(columns: Sequence[Column]) -> Column:
    """Sum over the non-null columns; null only if all are null."""
    total = _sum([F.coalesce(c, F.lit(0.0)) for c in columns])
    return F.when(F.coalesce(*columns).isNotNull(), total)


def row_mean(columns: Sequence[Column]) -> Column:
    """Mean over the non-null columns; null only if all are null."""
    count = _sum([c.isNotNull().cast("int") for c in columns])
    return F.try_divide(row_sum(columns), count)


def z_score(c: Column, mean: Column, sd: Column) -> Column:
    """Standard score; a constant column is only centred."""
    return (c - mean) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)


def log_positive(c: Column) -> Column:
    """Natural log, null where the value is not positive."""
    return F.when(c > 0, F.ln(c))


def spline_terms(x: Column, knots: Sequence[float]) -> list[Column]:
    """Non-linear terms of a restricted cubic spline (linear beyond the outer knots)."""
    if len(knots) < 3:
        raise ValueError("a restricted cubic spline needs at least 3 knots")
    if any(b <= a for a, b in zip(knots, knots[1:])):
        raise ValueError(f"spline knots must increase: {list(knots)}")
    last, before = float(knots[-1]), float(knots[-2])
    scale = (last - float(knots[0])) ** 2

    def cube(t: float) -> Column:
        return F.pow(F.greatest(x - F.lit(t), F.lit(0.0)), F.lit(3.0))

    terms = []
    for t in (float(k) for k in knots[:-2]):
        lifted = cube(t) - cube(before) * ((last - t) / (last - before)) + cube(last) * ((before - t) / (last - before))
        terms.append(lifted / scale)
    return terms


def ordered_bits(x: Column) -> Column:
    """The 64-bit image of a double that is not NaN, as a long in the order of the values; both zeros are 0.

    Exponent and fraction come from exact scaling by powers of two, so infinities and subnormal numbers have theirs.
    """
    size = F.abs(x)
    rough = F.floor(F.log2(size)).cast("double")
    exponent = (
        rough + F.when(size >= F.pow(F.lit(2.0), rough + 1), 1.0).otherwise(0.0)
        - F.when(size < F.pow(F.lit(2.0), rough), 1.0).otherwise(0.0)
    )
    # by halves, since two to the exponent, or its inverse, may be no double
    half = F.floor(exponent / 2)
    fraction = size / F.pow(F.lit(2.0), half) / F.pow(F.lit(2.0), exponent - half) - 1
    normal = (exponent.cast("bigint") + 1023) * F.lit(1 << 52) + (fraction * F.lit(2.0**52)).cast("bigint")
    subnormal = (size * F.lit(2.0**537) * F.lit(2.0**537)).cast("bigint")
    image = (
        F.when(size == 0, F.lit(0)).when(size == F.lit(float("inf")), F.lit(2047 << 52))
        .when(size < F.lit(2.0**-1022), subnormal).otherwise(normal)
    )
    return F.when(x < 0, -image).otherwise(image)

"""Exact order statistics and quantiles that never gather a column in one task."""

from __future__ import annotations

from collections.abc import Sequence
from math import floor, isinf

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.functions.numeric import ordered_bits
from panelspark.operators.schema import quoted
from panelspark.session import materialise, release

#: Bits of the values' images that one pass settles.
BITS_A_PASS = 10


def exact_quantiles(df: DataFrame, column: str, probabilities: Sequence[float]) -> list[float]:
    """Linearly interpolated quantiles of the non-null values; ``[]`` when there are none.

    The column is written once, so that its source is computed in one pass; see :func:`order_statistics`.
    """
    values = df.select(F.col(quoted(column)).cast("double").alias("x")).filter("x is not null and not isnan(x)")
    probs = [float(p) for p in probabilities]
    values = materialise(values)
    n = values.count()
    if n == 0:
        release(values)
        return []
    places = [(n - 1) * p for p in probs]
    wanted = sorted({k for h in places for k in (floor(h), min(floor(h) + 1, n - 1))})
    found = order_statistics(values, "x", wanted)
    release(values)
    out = []
    for h in places:
        out.append(_between(found[floor(h)], found[min(floor(h) + 1, n - 1)], h - floor(h)))
    return out


def _between(low: float, high: float, share: float) -> float:
    """The value at a share of the way; an infinite end is the value itself."""
    if share == 0 or low == high or isinf(low):
        return low
    if isinf(high):
        return high
    return low + share * (high - low) if not isinf(high - low) else low * (1 - share) + high * share


def order_statistics(df: DataFrame, column: str, ranks: Sequence[int]) -> dict[int, float]:
    """Exact values at 0-based ranks of a non-null column without NaN, by repeated narrowing.

    Values are told apart by their 64-bit images, which are whole numbers in the same order, so that infinities, numbers
    near zero and ranges of any size are like any other. A pass counts the images of every open interval by their next
    BITS_A_PASS bits (a grouped count that combines map-side), keeps the bin that holds the rank and shrinks it to the
    images seen there. An interval of one image is done, so ties of any size end it; no task or driver ever holds more
    than the bins, and seven passes settle 64 bits.
    """
    x = F.col(quoted(column)).cast("double")
    images = df.select(x.alias("x"), ordered_bits(x).alias("o"))
    span = images.agg(F.min("o"), F.max("o"), F.count("o"), F.min("x"), F.max("x")).first()
    if span[2] == 0:
        return {}
    open_ranks = {k: (span[0], span[1], 0, span[3]) for k in ranks}
    found: dict[int, float] = {}
    while True:
        for k, (low, high, _, value) in list(open_ranks.items()):
            if low == high:
                found[k] = value + 0.0  # one zero
                del open_ranks[k]
        if not open_ranks:
            return found
        intervals = sorted({v[:2] for v in open_ranks.values()})
        marks = []
        for i, (low, high) in enumerate(intervals):
            shift = max(0, (high - low).bit_length() - BITS_A_PASS)
            place = F.shiftright("o", shift) - F.lit(low >> shift)
            marks.append(F.when(F.col("o").between(low, high), F.struct(F.lit(i).alias("i"), place.alias("b"))))
        binned = images.select("x", "o", F.explode(F.array_compact(F.array(*marks))).alias("mark"))
        counted = binned.groupBy("mark.i", "mark.b").agg(
            F.count(F.lit(1)).alias("n"), F.min("o").alias("low"), F.max("o").alias("high"), F.min("x").alias("x")
        ).collect()
        table: dict[int, list] = {}
        for r in sorted(counted, key=lambda r: (r["i"], r["b"])):
            table.setdefault(r["i"], []).append(r)
        for k, (low, high, below, _) in list(open_ranks.items()):
            seen = below
            for r in table[intervals.index((low, high))]:
                if k < seen + r["n"]:
                    open_ranks[k] = (r["low"], r["high"], seen, r["x"])
                    break
                seen += r["n"]

"""Filters, vocabulary maps, pivots and joins that build a unit x period panel."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelspark.functions.text import item_key, plain_lower
from panelspark.operators.quality import QualityError, duplicate_keys, guard
from panelspark.operators.schema import quoted
from panelspark.session import materialise


def has_any_word(c: Column, words: Sequence[str]) -> Column:
    """Whether the accent-free lower-case text holds any of the (already plain) words."""
    return F.exists(F.array(plain_lower(c)), lambda text: reduce(lambda a, b: a | b, [text.contains(w) for w in words]))


def keyword_filter(df: DataFrame, rules: Mapping[str, Sequence[str]], optional: Sequence[str] = ()) -> DataFrame:
    """Keep rows where every ruled column holds one of its words; rules on absent optional columns are skipped."""
    for column, words in rules.items():
        if column in optional and column not in df.columns:
            continue
        df = df.filter(has_any_word(F.col(quoted(column)), words))
    return df


def period_filter(df: DataFrame, period: str, first: int, last: int, not_null: Sequence[str] = ()) -> DataFrame:
    """Inclusive period range and non-null columns; bare column comparisons, so they reach a Parquet scan."""
    return df.filter(F.col(period).between(first, last)).dropna(subset=[period, *not_null])


def map_values(c: Column, table: Mapping[str, str]) -> Column:
    """``table[c]`` or null, as one CASE per distinct target."""
    sources: dict[str, list[str]] = {}
    for key, value in table.items():
        sources.setdefault(value, []).append(key)
    return F.coalesce(*[F.when(c.isin(keys), F.lit(value)) for value, keys in sources.items()])


def canonical_item(c: Column, items: Mapping[str, str]) -> Column:
    """Known item for the space-collapsed lower-case label, else null."""
    return map_values(item_key(c), items)


def canonical_measure(c: Column, measures: Mapping[str, str]) -> Column:
    """Canonical measure, or the plain label with blanks as underscores when it is not in the vocabulary."""
    key = plain_lower(c)
    return F.coalesce(map_values(key, measures), F.replace(key, F.lit(" "), F.lit("_")))


def catalogue_search(catalogue: DataFrame, name: str, keywords: Mapping[str, str], tag: str = "tema") -> DataFrame:
    """Rows whose name holds a theme's keyword, once per theme; one pass over the catalogue for all themes."""
    text = F.lower(F.col(name))
    hits = F.array(*[
        F.when(F.contains(text, F.lit(word.lower())), F.lit(theme)) for theme, word in keywords.items()
    ])
    themed = catalogue.withColumn(tag, F.explode(F.array_compact(hits)))
    return themed.dropDuplicates()


def min_size_units(df: DataFrame, unit: str, sizes: DataFrame, size: str, minimum: float) -> DataFrame:
    """Rows of units whose total size reaches the minimum."""
    large = sizes.groupBy(unit).agg(F.sum(size).alias("_size")).filter(F.col("_size") >= minimum).select(unit)
    return df.join(large, unit, "left_semi")


def distinct_measures(df: DataFrame, measure: str) -> list[str]:
    """Sorted distinct measures, which become the columns of a pivot; more than ``spark.sql.pivotMaxValues`` are an error,
    as in Spark's own pivot, and do not reach the driver."""
    most = int(df.sparkSession.conf.get("spark.sql.pivotMaxValues"))
    found = df.select(measure).dropna().distinct().limit(most + 1).collect()
    if len(found) > most:
        raise QualityError(f"{measure}: more than {most} distinct measures")
    return sorted(r[0] for r in found)


def present_rows(df: DataFrame, columns: Sequence[str], how: str = "any") -> DataFrame:
    """Rows without nulls in the columns, or (``how='all'``) with a value in at least one."""
    return df.dropna(how=how, subset=list(columns))


def _wide(
    df: DataFrame, keys: Sequence[str], measure: str, value: str, measures: Sequence[str] | None, cell: Column
) -> tuple[DataFrame, list[str]]:
    """One row per key and one column per measure: cells are aggregated first, then the keys' cells are laid out."""
    kept = present_rows(df, [*keys, measure, value])
    if measures is None:
        names = distinct_measures(kept, measure)
    else:
        names = list(measures)
        kept = kept.filter(F.col(quoted(measure)).isin(names))
    return kept.groupBy(*keys).pivot(measure, names).agg(cell), names


def pivot_mean(
    df: DataFrame,
    keys: Sequence[str],
    measure: str,
    value: str,
    measures: Sequence[str] | None = None,
    prefix: str = "",
) -> DataFrame:
    """Long -> wide with the mean per cell. Keys whose every value is null vanish, as do null keys and, where
    ``measures`` are given (which saves the job that discovers them), keys that have none of these.
    """
    wide, names = _wide(df, keys, measure, value, measures, F.avg(value))
    return wide.withColumnsRenamed({str(n): f"{prefix}{n}" for n in names}) if prefix else wide


def pivot_strict(
    df: DataFrame, keys: Sequence[str], measure: str, value: str, measures: Sequence[str] | None = None
) -> DataFrame:
    """Long -> wide where each cell has exactly one row; a duplicate cell fails the call.

    The result is written before it is returned, so that no column or row selection can skip the check.
    """
    kept = present_rows(df, [*keys, measure, value])
    cells = kept.groupBy(*keys, measure).agg(F.count(F.lit(1)).alias("_n"), F.max(value).alias("_v"))
    where = F.concat_ws(", ", *[F.col(quoted(c)).cast("string") for c in [*keys, measure]])
    single = cells.withColumn("_v", guard(F.col("_v"), F.col("_n") > 1, F.concat(F.lit("duplicate cell: "), where)))
    return materialise(_wide(single.drop("_n"), keys, measure, "_v", measures, F.max("_v"))[0])


def left_many_to_one(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left join whose right side must be unique on the keys; a duplicate, matched or not, fails the call.

    The check is a job of its own over the right side, since a plan may drop whatever its columns do not need.
    """
    broken = duplicate_keys(right.dropna(subset=list(keys)), keys).orderBy(*keys).limit(10).collect()
    if broken:
        rows = "; ".join(", ".join(str(r[k]) for k in keys) for r in broken)
        raise QualityError(f"right side is not unique at {rows}")
    extra = [c for c in right.columns if c not in keys]
    joined = left.join(right.select(*keys, *map(quoted, extra)), list(keys), "left")
    return joined.select(*map(quoted, left.columns), *map(quoted, extra))


def outer_panel(parts: Mapping[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Full outer 1:1 join of any number of wide tables in one shuffle.

    The tables are stacked and grouped once by the keys; each contributes at most one row per key, or the call fails.
    The result is written before it is returned, so that no column or row selection can skip the check.
    """
    if not parts:
        raise ValueError("outer_panel needs at least one table")
    owner: dict[str, str] = {}
    for name, part in parts.items():
        for c in part.columns:
            if c not in keys and owner.setdefault(c, name) != name:
                raise ValueError(f"column {c} is in both {owner[c]} and {name}")
    stacked = [part.withColumn("_part", F.lit(i)) for i, part in enumerate(parts.values())]
    union = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), stacked)
    values = [c for c in union.columns if c not in keys and c != "_part"]
    counts = [F.count_if(F.col("_part") == i).alias(f"_n{i}") for i in range(len(stacked))]
    merged = union.groupBy(*keys).agg(*[F.max(quoted(c)).alias(c) for c in values], *counts)
    most = F.greatest(*[F.col(f"_n{i}") for i in range(len(stacked))], F.lit(0))
    where = F.concat_ws(", ", *[F.col(quoted(c)).cast("string") for c in keys])
    first_key = guard(F.col(quoted(keys[0])), most > 1, F.concat(F.lit("duplicate key in a part: "), where))
    return materialise(merged.select(first_key.alias(keys[0]), *keys[1:], *[quoted(c) for c in values]))

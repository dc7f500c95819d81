"""Plan-time column resolution: only schemas are looked at, each call adds one ``select``."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def first_present(columns: Sequence[str], wanted: Sequence[str]) -> str | None:
    """First wanted name that is present, exact and case-sensitive."""
    present = set(columns)
    return next((name for name in wanted if name in present), None)


def find_loose(columns: Sequence[str], names: Sequence[str], hints: Sequence[str] = ()) -> str | None:
    """The column that reads like the earliest of the names; without one, the first that holds all hints."""
    spelled = [c.strip().lower() for c in columns]
    places = [(rank, spelled.index(n)) for rank, n in enumerate(map(str.lower, names)) if n in spelled]
    if places:
        return columns[min(places)[1]]
    return _holding(columns, spelled, hints) if hints else None


def find_by_hints(columns: Sequence[str], hints: Sequence[str]) -> str | None:
    """The first column that holds all hints, with blanks ignored and hyphens read as underscores."""
    return _holding(columns, [c.lower().translate(_SQUEEZE) for c in columns], hints)


_SQUEEZE = {ord(" "): None, ord("\t"): None, ord("-"): "_"}


def _holding(columns: Sequence[str], spelled: Sequence[str], hints: Sequence[str]) -> str | None:
    wanted = [h.lower() for h in hints]
    hits = (column for column, text in zip(columns, spelled) if sum(h in text for h in wanted) == len(wanted))
    return next(hits, None)


def missing_targets(columns: Sequence[str], aliases: Mapping[str, Sequence[str]]) -> list[str]:
    return [target for target, names in aliases.items() if first_present(columns, names) is None]


def alias_project(
    df: DataFrame, aliases: Mapping[str, Sequence[str]], source: str, source_column: str = "fonte",
    keep_absent: bool = False,
) -> DataFrame:
    """Project onto the target vocabulary.

    A target without a match is left out, so that later steps can tell an absent column from an empty one;
    ``keep_absent`` makes it a column of null strings instead. See :func:`missing_targets` for what was left out.
    """
    picked = []
    for target, names in aliases.items():
        found = first_present(df.columns, names)
        if found or keep_absent:
            column = F.col(quoted(found)) if found else F.lit(None).cast(T.StringType())
            picked.append(column.alias(target))
    return df.select(*picked, F.lit(source).alias(source_column))


def require_columns(df: DataFrame, wanted: Iterable[str], what: str = "table") -> DataFrame:
    missing = sorted(set(wanted) - set(df.columns))
    if missing:
        raise ValueError(f"{what}: missing columns {missing}; found {df.columns}")
    return df


def prefix_columns(df: DataFrame, prefix: str, keys: Sequence[str]) -> DataFrame:
    return df.withColumnsRenamed({c: prefix + c for c in df.columns if c not in keys})


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def columns_with_prefix(df: DataFrame, prefix: str) -> list[str]:
    return sorted(c for c in df.columns if c.startswith(prefix))


def available(df: DataFrame, wanted: Sequence[str]) -> list[str]:
    """Wanted columns that exist, in the wanted order."""
    present = set(df.columns)
    return [c for c in wanted if c in present]


def fresh_name(name: str, taken: Sequence[str]) -> str:
    """``name``, with underscores added until no column (in any case) is called so."""
    used = {c.lower() for c in taken}
    while name.lower() in used:
        name += "_"
    return name

"""Text normalisation as Column expressions (no Python per row).

Spark has no compatibility-decomposition function, so the character tables below are derived by rule from the
Unicode database for the Basic Multilingual Plane up to U+2FFF plus the Latin ligatures. Characters outside that
range are left as they are.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

_RANGES = ((0x00A0, 0x2FFF), (0xFB00, 0xFB06))


def _plain(ch: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", ch) if not unicodedata.combining(c))


@lru_cache(maxsize=1)
def _accent_tables() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """(characters with a one-character plain form followed by those to delete, their plain forms, expansions)."""
    one_from, one_to, drop, many = [], [], [], []
    for first, last in _RANGES:
        for code in range(first, last + 1):
            ch = chr(code)
            plain = _plain(ch)
            if plain == ch:
                continue
            if not plain:
                drop.append(ch)
            elif len(plain) == 1:
                one_from.append(ch)
                one_to.append(plain)
            else:
                many.append((ch, plain))
    return "".join(one_from + drop), "".join(one_to), tuple(many)


@lru_cache(maxsize=1)
def _fold_pairs() -> tuple[tuple[str, str], ...]:
    """Characters whose case folding differs from lower case, after accents are gone."""
    return tuple(
        (chr(code), chr(code).casefold())
        for code in range(0x80, 0x2000)
        if chr(code) == chr(code).lower() and chr(code).casefold() != chr(code) and _plain(chr(code)) == chr(code)
    )


def _covering_class(chars: str, bridge: int = 64) -> str:
    """Character class of a few ranges that cover the characters; a long list of single ones is slow to match."""
    ranges: list[list[int]] = []
    for code in sorted(map(ord, chars)):
        if ranges and code - ranges[-1][1] <= bridge:
            ranges[-1][1] = code
        else:
            ranges.append([code, code])
    return "[" + "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in ranges) + "]"


def _literal(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _in_turn(c: Column, *bodies: str) -> Column:
    """Apply SQL expressions over ``t`` one after the other; each value is computed once however often it is used."""
    steps = F.array(c)
    for body in bodies:
        steps = F.call_function("transform", steps, F.expr(f"t -> {body}"))
    return F.element_at(steps, F.lit(1))


def _expansion(pairs: tuple[tuple[str, str], ...]) -> str:
    """SQL that replaces each key of ``pairs``; the replacements run only on rows that may hold one of the keys."""
    keys, values = (_literal("|".join(side)) for side in zip(*pairs))
    table = f"arrays_zip(split({keys}, '[|]'), split({values}, '[|]'))"
    guard = _literal(_covering_class("".join(k for k, _ in pairs)))
    return f"CASE WHEN t RLIKE {guard} THEN aggregate({table}, t, (acc, p) -> replace(acc, p.`0`, p.`1`)) ELSE t END"


@lru_cache(maxsize=1)
def _accent_steps() -> tuple[str, str]:
    source, target, many = _accent_tables()
    beyond_ascii = _literal(r"[^\x00-\x7F]")
    swap = f"CASE WHEN t RLIKE {beyond_ascii} THEN translate(t, {_literal(source)}, {_literal(target)}) ELSE t END"
    return swap, _expansion(many)


def strip_accents(c: Column) -> Column:
    """Compatibility decomposition without combining marks."""
    return _in_turn(c, *_accent_steps())


def plain_lower(c: Column) -> Column:
    """Accent-free lower case; null becomes the empty string."""
    return _in_turn(F.coalesce(c.cast("string"), F.lit("")), *_accent_steps(), "lower(t)")


_SPACE = r"[\s\x1c-\x1f\x85\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+"


def collapse_spaces(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, _SPACE, " "))


def name_key(c: Column) -> Column:
    """Join key of a name: accent-free, case-folded, single-spaced, trimmed; null becomes the empty string."""
    text = F.coalesce(c.cast("string"), F.lit(""))
    return collapse_spaces(_in_turn(text, *_accent_steps(), "lower(t)", _expansion(_fold_pairs())))


def item_key(c: Column) -> Column:
    """Lower case, single-spaced, trimmed; accents kept."""
    return collapse_spaces(F.lower(c.cast("string")))


def code_key(c: Column) -> Column:
    """Trimmed upper-case code."""
    return F.upper(F.trim(c.cast("string")))


def slug(c: Column, prefix: str = "", suffix: str = "") -> Column:
    """Accent-free lower case with every run of other characters turned into one underscore."""
    core = F.regexp_replace(F.regexp_replace(plain_lower(c), "[^a-z0-9]+", "_"), "^_+|_+$", "")
    return F.concat(F.lit(prefix), core, F.lit(suffix))


def slug_text(text: str, prefix: str = "", suffix: str = "") -> str:
    """Plan-time twin of :func:`slug` for column names."""
    plain = _plain(text).lower()
    words = "".join(ch if ch.isascii() and ch.isalnum() else " " for ch in plain).split()
    return prefix + "_".join(words) + suffix


def zero_fill(c: Column, width: int) -> Column:
    """Left-pad with zeros up to ``width``; longer text is never cut."""
    return F.when(F.length(c) < width, F.lpad(c, width, "0")).otherwise(c)

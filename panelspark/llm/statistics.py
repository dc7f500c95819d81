"""Statistics of a whole text, taken from its UTF-8 bytes: what the quality models read."""

from __future__ import annotations

import numpy as np

_SYMBOLS = list(b"#*$%&|<>")
_PUNCTUATION = list(b".,;:!?'\"()-")


def shape(text: bytes) -> list[float]:
    """Shares and means that do not depend on language: an empty text gives zeros.

    In order: log of characters, log of words, mean word length, shares of upper-case letters, digits, symbols,
    punctuation and line breaks among characters, of "!!" among words, of distinct words, of words equal to the word
    before, of distinct lines, of words in the longest line, of non-ASCII characters.
    """
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(counts[:128].sum() + counts[192:].sum())
    words = text.split()
    n = len(words)
    if not n:
        return [float(np.log1p(chars)), *[0.0] * 13]
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    again = sum(map(bytes.__eq__, words, words[1:]))
    return [
        float(np.log1p(chars)), float(np.log1p(n)), sum(map(len, words)) / n,
        counts[65:91].sum() / chars, counts[48:58].sum() / chars, counts[_SYMBOLS].sum() / chars,
        counts[_PUNCTUATION].sum() / chars, counts[10] / chars, text.count(b"!!") / n, len(set(words)) / n, again / n,
        len(set(lines)) / len(lines), max(map(len, lines)) / len(text), counts[192:].sum() / chars,
    ]


SHAPE_NAMES = [
    "log_chars", "log_words", "word_length", "upper", "digits", "symbols", "punctuation", "breaks", "shouts",
    "distinct_words", "repeated_next", "distinct_lines", "longest_line", "non_ascii",
]


def repeated_words(words: list[bytes], width: int) -> int:
    """Words that lie in a run of ``width`` words found twice or more in the text, the first one included."""
    n = len(words) - width + 1
    if n < 2:
        return 0
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    if len(numbers) > len(words) - 2:
        return 0  # a run found twice repeats its words
    place = np.uint64(0x9E3779B97F4A7C15)
    key = np.zeros(n, np.uint64)
    for k in range(width):
        key = key * place + ids[k:n + k].astype(np.uint64)
        key ^= key >> np.uint64(29)
    if len(np.unique(key)) == n:
        return 0  # equal runs have equal keys
    # number the runs of 1, 2, 4, ... words exactly, by sorting the pairs of numbers of their halves
    length, rank = 1, ids
    while length < width:
        step = min(length, width - length)
        base = int(rank.max()) + 1
        pair = rank[:len(rank) - step] * base + rank[step:]
        rank = np.unique(pair, return_inverse=True)[1]
        length += step
    often = np.bincount(rank)[rank] > 1
    edge = np.zeros(len(words) + 1, np.int64)
    starts = np.flatnonzero(often)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + width, -1)
    return int((edge.cumsum()[:-1] > 0).sum())


def rule_counts(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a text.

    Words are runs of characters other than ASCII white space; a line counts as a duplicate if it has a word and equals
    an earlier line; repeated words lie in runs of eight words.
    """
    words = text.split()
    counts = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    chars = int(counts[:128].sum() + counts[192:].sum())
    lines = [line for line in text.split(b"\n") if line and not line.isspace()]
    return (
        len(words), chars - int(counts[9:14].sum() + counts[32]), int(counts[_SYMBOLS].sum()),
        len(lines) - len(set(lines)), repeated_words(words, 8),
    )

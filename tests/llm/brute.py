"""Plain versions of the operators' contracts, for small tables."""

from __future__ import annotations

import hashlib
import itertools
import re
from collections import Counter, defaultdict

SPACE_WORDS = re.compile(r"[^\x20\x09-\x0D]+")
LETTER_WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans({c: c + 32 for c in range(65, 91)})


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def near_duplicates(rows: list[tuple], words_each: int = 4, percent: int = 80) -> dict:
    """doc_id -> (set size, smallest id of its component), by counting shared shingles of all pairs."""
    sets = {}
    for doc, text in rows:
        w = SPACE_WORDS.findall((text or "").translate(LOWER))
        runs = [tuple(w[i:i + words_each]) for i in range(len(w) - words_each + 1)] or ([tuple(w)] if w else [])
        sets[doc] = frozenset(runs)
    root = {d: d for d in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for doc, s in sets.items():
        for x in s:
            holders[x].append(doc)
    common = Counter(pair for v in holders.values() for pair in itertools.combinations(sorted(v), 2))
    for (a, b), n in common.items():
        if 100 * n >= percent * (len(sets[a]) + len(sets[b]) - n):
            root[max(find(a), find(b))] = min(find(a), find(b))
    return {d: (len(s), find(d)) for d, s in sets.items()}


def contamination(docs: list[tuple], items: list[tuple], window: int = 13) -> dict:
    """doc_id -> (n_words, n_hit, sorted item ids as strings)."""
    patterns = defaultdict(set)
    for item, text in items:
        w = LETTER_WORDS.findall((text or "").translate(LOWER))
        m = min(window, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            patterns[tuple(w[i:i + m])].add("" if item is None else str(item))
    lengths = {len(p) for p in patterns}
    out = {}
    for doc, text in docs:
        w = LETTER_WORDS.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                if (p := tuple(w[i:i + m])) in patterns:
                    hit.update(range(i, i + m))
                    found |= patterns[p]
        out[doc] = (len(w), len(hit), sorted(found))
    return out


_ASSIGN = re.compile(
    r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.I | re.A
)


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, stop) of the base secrets."""
    spans = [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def rule_counts(text: str) -> tuple[int, int, int, int, int]:
    w = SPACE_WORDS.findall(text)
    often = Counter(tuple(w[i:i + 8]) for i in range(len(w) - 7))
    covered = {k for i in range(len(w) - 7) if often[tuple(w[i:i + 8])] > 1 for k in range(i, i + 8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if SPACE_WORDS.search(line):
            again += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), again, len(covered)

"""Quality rules: counts of a text, fixed failures, and boosted trees over the counts for what the rules let pass.

The trees are held monotone: the score can only fall as symbols, duplicate lines or repeated words grow, and only rise
with distinct words, so a text never gains by getting worse.

Defined results: null and empty texts have no words and fail; without labels every score is 0.5; repeated rows give
equal rows; null keys are kept as they are; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import boosting
from panelspark.llm.common import map_documents
from panelspark.llm.labelled import SAMPLE_ROWS, training_rows
from panelspark.llm.statistics import SHAPE_NAMES, rule_counts, shape

LEAST_WORDS = 20
#: Percent of repeated words from which a text fails.
MOST_REPEATED = 30
#: Scores from here on are kept.
CUT = 0.3
BLOCK = 256
_FEATURES = [*SHAPE_NAMES, "symbols_per_word", "dup_lines", "repeated"]
#: Direction in which the score may move with a feature.
MONOTONE = {
    _FEATURES.index(name): sign
    for name, sign in {
        "symbols": -1, "shouts": -1, "repeated_next": -1, "distinct_words": 1, "distinct_lines": 1,
        "symbols_per_word": -1, "dup_lines": -1, "repeated": -1,
    }.items()
}


def counts_and_features(text: bytes) -> tuple[tuple[int, ...], list[float]]:
    counts = n_words, _, n_symbols, n_dup_lines, n_repeat = rule_counts(text)
    n = max(1, n_words)
    return counts, [*shape(text), n_symbols / n, float(np.log1p(n_dup_lines)), n_repeat / n]


def _features(picked: DataFrame) -> DataFrame:
    def make(keys, labels, texts):
        for k, y, t in zip(keys, labels, texts):
            yield 200, (k, y, counts_and_features(t)[1])

    return map_documents(picked, ["_key", "_label"], ["_text"], make, "_key {_key}, _label int, _x array<double>")


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> boosting.Trees:
    x, y = training_rows(
        _features, docs.select(key, F.col(text).alias("_text")), labels, key, label, sample_rows
    )
    return boosting.fit(x, y, MONOTONE)


def judge(docs: DataFrame, trees: boosting.Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, score)."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def make(keys, texts):
        for i in range(0, len(texts), BLOCK):
            told = [counts_and_features(t) for t in texts[i:i + BLOCK]]
            scores = model.value.score(np.array([x for _, x in told])).tolist()
            for k, (counts, _), s in zip(keys[i:i + BLOCK], told, scores):
                yield 64, (k, *counts, s)

    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    fields = f"`{key}` {{{key}}}, " + ", ".join(f"{n} bigint" for n in names) + ", score double"
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return map_documents(docs, [key], [text], make, fields).select(
        key, *names, failed.alias("base_failed"), (~failed & (F.col("score") >= CUT)).alias("kept"), "score"
    )

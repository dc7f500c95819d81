"""Quality classifier: histogram gradient-boosted trees over document statistics.

The fit uses at most ``sample_rows`` labelled rows outside the held-out fold; the trees, a few thousand numbers, are
broadcast, and every whole text is scored where it lies, without a shuffle.

Defined results: null and empty texts have the statistics of an empty text and a score; without labels every score is
0.5, with labels of one kind their smoothed share; a null key is scored and held out in no fold; repeated rows give
equal rows; an empty table gives an empty one; other columns are not read.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelspark.llm import boosting
from panelspark.llm.common import filter_documents, map_documents
from panelspark.llm.labelled import SAMPLE_ROWS, fold, training_rows
from panelspark.llm.statistics import shape

#: Scores from here on are predicted as good.
CUT = 0.3
BLOCK = 256


def _features(picked: DataFrame) -> DataFrame:
    def make(keys, labels, texts):
        for k, y, t in zip(keys, labels, texts):
            yield 200, (k, y, shape(t))

    return map_documents(picked, ["_key", "_label"], ["_text"], make, "_key {_key}, _label int, _x array<double>")


def fit(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality",
    sample_rows: int = SAMPLE_ROWS,
) -> boosting.Trees:
    x, y = training_rows(
        _features, docs.select(key, F.col(text).alias("_text")), labels, key, label, sample_rows
    )
    return boosting.fit(x, y)


def score(docs: DataFrame, trees: boosting.Trees, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, held_out, score, predicted): one row for each row of ``docs``."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def make(keys, texts):
        for i in range(0, len(texts), BLOCK):
            x = np.array([shape(t) for t in texts[i:i + BLOCK]])
            for k, s in zip(keys[i:i + BLOCK], model.value.score(x).tolist()):
                yield 16, (k, s)

    scored = map_documents(docs, [key], [text], make, f"`{key}` {{{key}}}, score double")
    return scored.select(
        key, F.coalesce(fold(F.col(key)) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= CUT).cast("int").alias("predicted"),
    )


def keep(docs: DataFrame, trees: boosting.Trees, text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are predicted as good, with all their columns."""
    model = docs.sparkSession.sparkContext.broadcast(trees)

    def decide(texts):
        parts = [texts[i:i + BLOCK] for i in range(0, len(texts), BLOCK)]
        return [s >= CUT for part in parts for s in model.value.score(np.array([shape(t) for t in part]))]

    return filter_documents(docs, text, decide)

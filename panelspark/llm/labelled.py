"""The labelled rows that a quality model learns from: outside the held-out fold, at most a documented number."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that a fit may use; beyond that, those of smallest hash. 20,000 rows of 20 features are 3 MB.
SAMPLE_ROWS = 20_000
FOLDS = 5


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo FOLDS; a null key is in no fold."""
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(FOLDS))


def sample_keys(labels: DataFrame, key: str, label: str, rows: int = SAMPLE_ROWS) -> DataFrame:
    """(key, label) of at most ``rows`` labelled keys outside fold 0, by hash; a key labelled twice takes the least."""
    return labels.select(F.col(key).alias("_key"), F.col(label).cast("int").alias("_label")).filter(
        "_key IS NOT NULL AND _label IS NOT NULL"
    ).filter(fold(F.col("_key")) != 0).groupBy("_key").agg(F.min("_label").alias("_label")).orderBy(
        F.xxhash64("_key"), "_key"
    ).limit(rows)


def training_rows(features, docs: DataFrame, labels: DataFrame, key: str, label: str, rows: int):
    """(x, y) of the sampled keys' documents. ``features`` maps a table with key, _label and text to rows that have the
    key, the label and a list of numbers. The sampled keys are broadcast: their number is bounded by ``rows``."""
    keys = F.broadcast(sample_keys(labels, key, label, rows))
    picked = docs.join(keys, F.col(key) == F.col("_key"))
    # of several documents with one key that of the least statistics counts, in every run
    one = features(picked).groupBy("_key").agg(F.min(F.struct("_x", "_label")).alias("_one")).select("_key", "_one.*")
    found = one.orderBy("_key").limit(rows).collect()
    if not found:
        return np.zeros((0, 1)), np.zeros(0)
    return np.array([r["_x"] for r in found], float), np.array([r["_label"] for r in found], float)

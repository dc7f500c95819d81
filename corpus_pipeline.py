"""A corpus from documents to token ids: five stages, each written as Parquet and read again as the next one's input.

Each stage takes (spark, docs, sf_dir) and returns a table; all but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelspark.llm import bbit_minhash, bpe, decontaminate, quality_model, secret_scan
from panelspark.llm.common import table
from panelspark.session import materialise


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labels of these documents, predicts as good."""
    return quality_model.keep(docs, quality_model.fit(docs, table(spark, sf_dir, "labels")))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of smallest id of each group of near copies: five-word shingles, similarity of 0.8 or more."""
    return bbit_minhash.deduplicate(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth lies in windows of the benchmark."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with secrets replaced by a mark."""
    return secret_scan.redact(docs)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of each document as little-endian unsigned 32-bit integers, their number, and the digest of what they
    decode to."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode(docs, ranks, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"), "ids",
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


STAGES = [
    ("quality classifier", quality),
    ("MinHash near-dedup", near_duplicates),
    ("benchmark decontamination", decontamination),
    ("secret scans", secrets),
    ("byte-level BPE", token_ids),
]

#: The classifier is a fitted model, which SQL cannot state; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir))
    return docs

"""The registered queries of this subpackage, each over whole tables, and their SQL twins."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from panelspark.llm import alignment, arrow_tokens, bbit_minhash, bpe, decontaminate, html_text, packing, quality_model
from panelspark.llm import quality_rules, secret_scan, sharding, warc, whitening
from panelspark.llm.sql import OP2, OP3, OP4, OP9
from panelspark.llm.common import table

QUERIES: dict = {}
ORACLES: dict[str, str] = {}

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
BYTE_VOCABULARY = public_tokenizers.path("byte_bpe_50k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")
END_ID = 2
PACK_END_ID = 0
SHARDS = 8


def register(fn):
    QUERIES[fn.__name__] = fn
    return fn


@register
def op1_token_files(spark, sf_dir):
    """Ids of every document in Arrow files and each document's place and checksum as read back from them."""
    docs = table(spark, sf_dir, "documents")
    manifest = arrow_tokens.write_sequences(docs, WORD_VOCABULARY, END_ID)
    return arrow_tokens.read_documents(spark, manifest, dict(docs.dtypes)["doc_id"])


@register
def op10_byte_bpe(spark, sf_dir):
    """Ids of every document by the rank file, and the bytes they decode to."""
    docs = table(spark, sf_dir, "documents")
    return bpe.encode(docs, BYTE_RANKS, public_tokenizers.PATTERN, decoded=True).select(
        "doc_id", (F.octet_length("ids") / 4).cast("bigint").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@register
def op9_decontamination(spark, sf_dir):
    """Words of every document that lie inside a window of a benchmark item."""
    found = decontaminate.find_contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


ORACLES["op9_decontamination"] = OP9


@register
def op7_near_duplicates(spark, sf_dir):
    """The component of near copies that every document belongs to."""
    return bbit_minhash.near_duplicates(table(spark, sf_dir, "documents"), words_each=4, percent=80)


@register
def op6_quality(spark, sf_dir):
    """Quality score of every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_model.score(docs, quality_model.fit(docs, labels))


@register
def op8_quality_rules(spark, sf_dir):
    """Counts, fixed failures and the trees' verdict for every document."""
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality_rules.judge(docs, quality_rules.fit(docs, labels))


@register
def op2_secret_scan(spark, sf_dir):
    """Secrets of every document, with spans added for tokens that stay with one owner."""
    found = secret_scan.scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *secret_scan.digest_columns(F.col("spans")))


ORACLES["op2_secret_scan"] = OP2


@register
def op3_sharding(spark, sf_dir):
    """Shard and slot of every document among eight equal shards, and its shard among nine."""
    placed = sharding.assign(table(spark, sf_dir, "documents"), [1.0] * SHARDS, [1.0] * (SHARDS + 1))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


ORACLES["op3_sharding"] = OP3


@register
def op4_warc(spark, sf_dir):
    """Every page as a WARC record, as read back from the archives."""
    pages = table(spark, sf_dir, "pages")
    manifest = warc.write_archives(pages)
    found = warc.read_archives(spark, manifest, dict(pages.dtypes)["page_id"])
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register
def op5_html_text(spark, sf_dir):
    """The main text of every page."""
    found = html_text.extract(table(spark, sf_dir, "pages"))
    return found.select(
        "page_id", "url", "text", F.length("text").cast("bigint").alias("n_chars"), "n_outside", "n_covered"
    )


ORACLES["op4_warc"] = OP4


@register
def op11_whitening(spark, sf_dir):
    """Every vector on the first components of the distinct ones."""
    vectors = table(spark, sf_dir, "embeddings")
    model = whitening.fit(vectors)
    rows = whitening.transform(vectors, model).select("vec_id", "deviation", F.posexplode("whitened").alias("i", "whitened"))
    share = [e / model.trace if model.trace else None for e in model.values] if model else [0.0]
    return rows.select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.n if model else 0).cast("bigint").alias("n"),
        "deviation", "whitened", F.get(F.array(*map(F.lit, share)), "i").cast("double").alias("explained"),
        F.lit(model.identity_error if model else 0.0).alias("identity_error"),
    )


@register
def op12_alignment(spark, sf_dir):
    """Every document's groups of two tokenizers' tokens, and how common its linked id pairs are."""
    aligned = alignment.align(table(spark, sf_dir, "documents"), BYTE_VOCABULARY, PIECE_MODEL)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    return alignment.count_links(aligned.withColumn("groups_sha256", digest).drop("groups"))


@register
def op13_packing(spark, sf_dir):
    """The sequence and the place there of every piece of every document."""
    pieces = packing.encode_pieces(table(spark, sf_dir, "documents"), WORD_VOCABULARY, PACK_END_ID)
    return packing.place(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids"))

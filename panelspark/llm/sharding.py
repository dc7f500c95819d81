"""Sharding by weighted rendezvous hashing of stable record keys.

Every (key, shard) pair has a pseudo-random u in (0, 1]; the key goes to the shard with the largest ln(u) / weight, the
smallest shard of equals. A shard more takes rows only into itself, and each shard's share follows its weight. The shard
of a row depends on its key and the shards alone, so any row can be placed without a look at the others.

Slots number the rows of a shard without gaps. Rows are dealt out by ranges of their keys (split further by text and
place, so one key may hold a third of all rows), numbered inside each range, and moved up by the rows that the ranges
before have in that shard; no shard is gathered in one task. Only DataFrame functions run here.

Defined results: a null text has no bytes, so its size is 1 and its checksum 0; a null key hashes as the empty string and
has the last slots; rows that share a key lie side by side; an empty table gives an empty one; other columns are not
read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelspark.session import materialise

#: Hex digits of the hash that make u: 52 bits, which a double holds exactly.
DIGITS = 13


def rendezvous(key: Column, weights: list[float]) -> Column:
    """The shard, counted from 0, that the key belongs to."""
    text = F.coalesce(key.cast("string"), F.lit(""))

    def bid(shard: int, weight: float) -> Column:
        draw = F.conv(F.substring(F.md5(F.concat(text, F.lit(f":{shard}")).cast("binary")), 1, DIGITS), 16, 10)
        u = (draw.cast("bigint") + 1).cast("double") / float(16 ** DIGITS)
        return F.struct((F.log(u) / F.lit(float(weight))).alias("bid"), F.lit(-shard).alias("shard"))

    bids = [bid(i, w) for i, w in enumerate(weights)]
    return -F.greatest(*bids)["shard"] if len(bids) > 1 else F.lit(0)


def assign(
    docs: DataFrame, weights: list[float], grown: list[float], key: str = "doc_id", text: str = "text"
) -> DataFrame:
    """(key, size, text_crc32, shard, slot, grown_shard): ``grown`` are the weights after the shard count has changed."""
    body = F.col(text).cast("binary")
    placed = docs.select(
        F.col(key).alias("_k"), (F.coalesce(F.octet_length(body), F.lit(0)) + 1).cast("bigint").alias("size"),
        F.coalesce(F.crc32(body), F.lit(0)).cast("bigint").alias("text_crc32"),
    ).withColumn("_i", F.monotonically_increasing_id())
    order = [F.asc_nulls_last("_k"), F.asc("text_crc32"), F.asc("size"), F.asc("_i")]
    ranged = materialise(placed.repartitionByRange(*order).select(
        "*", rendezvous(F.col("_k"), weights).alias("shard"), rendezvous(F.col("_k"), grown).alias("grown_shard"),
        F.spark_partition_id().alias("part"),
    ))
    # ranges by shards: as many rows as there are tasks, times the shards
    before = ranged.groupBy("shard", "part").agg(F.count("*").alias("n")).withColumn(
        "before", F.sum("n").over(Window.partitionBy("shard").orderBy("part")) - F.col("n")
    ).drop("n")
    inside = F.row_number().over(Window.partitionBy("shard", "part").orderBy(*order)) - 1
    return ranged.withColumn("inside", inside).join(before, ["shard", "part"]).select(
        F.col("_k").alias(key), "size", "text_crc32", "shard",
        (F.col("before") + F.col("inside")).cast("bigint").alias("slot"), "grown_shard",
    )

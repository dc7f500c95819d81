"""Near duplicates by b-bit MinHash: band candidates, collision-corrected estimates, exact confirmation, components.

1. A document's set is its distinct word shingles. Equal sets form one class, pre-aggregated before anything is paired.
2. Each class has HASHES minima. Bands of ROWS minima give candidate buckets; the low BITS bits of every minimum are
   packed, and the share of equal packed values, corrected for chance collisions, estimates the similarity.
3. Star: every class meets the smallest class of each of its buckets. Estimates below the threshold less a margin of
   five standard deviations fall away; the best partner of each class is confirmed on the full sets, then the partners
   that would still join two components.
4. Rest: buckets that still hold several components are compared whole, in blocks of bounded size: first by the packed
   bits, then, for classes that have a partner near enough, on the full sets. Classes of one component are not compared, since no link between them changes a component.

A link of similarity s escapes the bands with probability (1 - s**ROWS)**BANDS: under 3e-6 at 0.8, and a component is
lost only if all links that hold it do. Bands and the rule for small sets hold from LEAST_PERCENT on; less is refused.

Defined results: texts without words have an empty set and stay alone; rows of one doc_id share what that id is linked
with; a null id takes the smallest id of its component, or null; an empty table gives an empty one; other columns are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelspark.llm.common import Memo, content_key, dealt_by_rows, in_batches, map_documents, map_in_arrow, sole_memo
from panelspark.operators.schema import fresh_name
from panelspark.session import materialise, release

HASHES = 256
BANDS, ROWS = 42, 6
BITS = 2
#: Least similarity that BANDS find nearly every link of, and at which sets of up to three shingles link equal ones only.
LEAST_PERCENT = 80
#: Standard deviations that an estimate may lie below the threshold.
MARGIN = 5.0
#: Ids that may be broadcast to pick the documents whose sets are needed, or that go (8 to 40 bytes each); more are
#: joined by a shuffle.
BROADCAST_IDS = 1_000_000
#: Classes of one bucket that a task compares with as many others.
BLOCK_CLASSES = 500
#: Bytes of words and hashes that one Python worker remembers.
MEMO_BYTES = 24 << 20
_LANES = HASHES * BITS // 64


def _mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads them evenly (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_MULTIPLIERS = _mixed(np.arange(1, HASHES + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
_PLACES = _mixed(np.arange(1, 9, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03)) | np.uint64(1)


class _WordHashes(Memo):
    def make(self, word: bytes) -> int:
        return xxhash.xxh3_64_intdigest(word)

    def size(self, value: int) -> int:
        return 0


_WORDS = _WordHashes(MEMO_BYTES)


def shingle_set(text: bytes, words_each: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of ``words_each`` words; fewer words are one run, none give no hash."""
    words = text.lower().split()  # bytes: A-Z only, and ASCII white space only
    n = len(words)
    if not n:
        return np.zeros(0, np.uint64)
    if n < words_each:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), n)], np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, n)
    total = np.zeros(n - words_each + 1, np.uint64)
    for k in range(words_each):
        total += _mixed(h[k:n - words_each + 1 + k] * _PLACES[k])
    return np.unique(_mixed(total))


def minima(hashes: np.ndarray) -> np.ndarray:
    """The least value of each of HASHES permutations of a set's hashes."""
    least = np.full(HASHES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(hashes), 512):
        part = hashes[i:i + 512]
        np.minimum(least, np.multiply.outer(_MULTIPLIERS, part).min(axis=1), out=least)
    return least


def band_keys(least: np.ndarray) -> np.ndarray:
    rows = _mixed(least[:BANDS * ROWS].reshape(BANDS, ROWS) * _PLACES[:ROWS]).sum(axis=1, dtype=np.uint64)
    return _mixed(rows + np.arange(BANDS, dtype=np.uint64) * _PLACES[6]).view(np.int64)


def packed_bits(least: np.ndarray) -> np.ndarray:
    """The low BITS bits of the upper half of every minimum, side by side in 64-bit lanes."""
    low = ((least >> np.uint64(32)) & np.uint64((1 << BITS) - 1)).reshape(_LANES, 64 // BITS)
    return (low << np.arange(0, 64, BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64).view(np.int64)


def least_matches(threshold: float) -> int:
    """Equal packed values, of HASHES, that a pair at the threshold has but for MARGIN standard deviations."""
    chance = 0.5 ** BITS
    share = threshold + (1 - threshold) * chance
    return int(np.floor(HASHES * share - MARGIN * np.sqrt(HASHES * share * (1 - share))))


def _matches(a: str, b: str) -> Column:
    """Equal packed values of two arrays of lanes: a lane's mismatches are the groups with any bit of a ^ b set."""
    low = int("01" * 32, 2)
    count = F.lit(HASHES)
    for i in range(_LANES):
        x = F.col(a)[i].bitwiseXOR(F.col(b)[i])
        count = count - F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(low)))
    return count


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 * intersection >= percent * union, of sorted distinct hashes."""
    both = np.concatenate((a, b))
    both.sort()
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= percent * (len(a) + len(b) - common)


def document_sets(docs: DataFrame, key: str, text: str, words_each: int) -> DataFrame:
    """(key, set_key, n_shingles, bands, packed); the key of an empty set is null."""

    def make(keys, texts):
        sole_memo(_WORDS)
        for k, t in zip(keys, texts):
            hashes = shingle_set(t, words_each)
            if not len(hashes):
                yield 16, (k, None, 0, None, None)
                continue
            least = minima(hashes)
            # sets of up to three shingles can link with equal ones only
            bands = band_keys(least).tolist() if len(hashes) > 3 else []
            digest = xxhash.xxh3_128_digest(hashes)
            yield 500, (k, digest, len(hashes), bands, packed_bits(least).tolist())

    fields = f"`{key}` {{{key}}}, set_key binary, n_shingles bigint, bands array<bigint>, packed array<bigint>"
    return map_documents(docs, [key], [text], make, fields)


def components(edges: DataFrame) -> DataFrame:
    """(node, label): the smallest node that the edges (a, b) reach, for every node that has an edge.

    Each round takes the smallest label among the neighbours, then the label of the label, until nothing changes.
    """
    both = materialise(edges.select("a", "b").union(edges.select("b", "a")).distinct())
    labels = materialise(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select(
        "node", F.least("node", "m").alias("label")
    ))
    while True:
        near = both.join(labels.withColumnRenamed("node", "b"), "b").groupBy(F.col("a").alias("node")).agg(
            F.min("label").alias("near")
        )
        hooked = labels.join(near, "node").select("node", F.least("label", "near").alias("hook"), "label")
        # a label is a node: follow it once
        ahead = labels.select(F.col("node").alias("hook"), F.col("label").alias("ahead"))
        moved = materialise(hooked.join(ahead, "hook").select(
            "node", F.least("hook", "ahead").alias("label"), F.col("label").alias("was")
        ))
        labels = moved.select("node", "label")
        if moved.filter("label < was").isEmpty():
            return labels


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of the pairs (a, b) whose full sets are similar enough."""
    ddl = "a bigint, b bigint"
    out = to_arrow_schema(StructType.fromDDL(ddl))
    joined = pairs.select("a", "b").join(
        sets.select(F.col("cid").alias("a"), F.col("shingles").alias("left")), "a"
    ).join(sets.select(F.col("cid").alias("b"), F.col("shingles").alias("right")), "b").select("a", "b", "left", "right")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
                for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3))):
                    if similar(np.frombuffer(x.as_py(), np.uint64), np.frombuffer(y.as_py(), np.uint64), percent):
                        yield 16, (a[i], b[i])

        yield from in_batches(rows(), out)

    return map_in_arrow(joined, run, ddl)


def _class_sets(docs, key, text, words_each, needed: DataFrame) -> DataFrame:
    """(cid, shingles) of the needed classes (cid, set_key, first_doc), from one document of each."""
    if needed.count() <= BROADCAST_IDS:
        needed = F.broadcast(needed)
    picked = docs.select(F.col(key).alias("_id"), F.col(text).alias("_t")).join(
        needed, F.col("_id").eqNullSafe(F.col("first_doc"))
    )

    def make(cids, wanted, texts):
        sole_memo(_WORDS)
        for cid, digest, t in zip(cids, wanted, texts):
            hashes = shingle_set(t, words_each)
            if xxhash.xxh3_128_digest(hashes) == digest:  # ids may be shared by different texts
                yield 8 * len(hashes), (cid, hashes.tobytes())

    return map_documents(picked, ["cid", "set_key"], ["_t"], make, "cid bigint, shingles binary")


def _rest(members: DataFrame, labels: DataFrame, classes: DataFrame, sets: DataFrame, threshold: float, percent: int):
    """Links (a, b) that join components within the buckets that still hold several."""
    least = least_matches(threshold)
    told = members.join(labels.withColumnRenamed("node", "cid"), "cid", "left").withColumn(
        "label", F.coalesce("label", "cid")
    )
    open_buckets = told.groupBy("bucket").agg(
        F.min("label").alias("lo"), F.max("label").alias("hi"), F.count("*").alias("n")
    ).filter("lo < hi").select("bucket", F.ceil(F.col("n") / BLOCK_CLASSES).cast("int").alias("chunks"))
    rows = told.join(open_buckets, "bucket").withColumn("chunk", F.pmod(F.xxhash64("cid"), F.col("chunks")).cast("int"))
    # a class goes to the block of its chunk with each other chunk, the smaller chunk first
    blocks = rows.select("bucket", "cid", "label", "chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("o")
    ).select("bucket", "cid", "label", "chunk", F.least("chunk", "o").alias("i"), F.greatest("chunk", "o").alias("j"))
    place = ["bucket", "i", "j", "chunk", "cid", "label"]

    def dealt(rows: DataFrame, values: list[str]) -> DataFrame:
        return rows.select(*place, *values).repartition("bucket", "i", "j").sortWithinPartitions(*place[:5])

    def run(each, schema: pa.Schema):
        def mapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            yield from in_batches(((24, row) for block in _blocks(batches) for row in each(block)), schema)

        return mapped

    # by the packed bits alone: which classes have a partner near enough; only those fetch their sets
    fields = ", ".join(f"{name} {kind}" for name, kind in blocks.dtypes)
    with_bits = dealt(blocks.join(classes.select("cid", "packed"), "cid"), ["packed"])
    order = [place.index(c) for c in blocks.columns]
    with_partner = map_in_arrow(with_bits, run(lambda b: _near_members(b, least, order), _schema(fields)), fields)
    full = with_partner.join(classes.select("cid", "bands", "packed"), "cid").join(sets, "cid")
    ddl = "a bigint, b bigint"
    complete = dealt(full, ["packed", "bands", "shingles"])
    return map_in_arrow(complete, run(lambda b: _block_links(b, least, percent), _schema(ddl)), ddl)


def _schema(ddl: str) -> pa.Schema:
    return to_arrow_schema(StructType.fromDDL(ddl))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """The rows of each (bucket, i, j); rows arrive sorted."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if held and held[0][:3] != row[:3]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _near_in_block(block: list[tuple], least: int) -> Iterator[tuple[int, np.ndarray]]:
    """For each row of a block, the later rows of another component whose estimate is high enough."""
    _, i, j = block[0][:3]
    chunk, label = np.array([r[3] for r in block]), np.array([r[5] for r in block])
    packed = np.array([r[6] for r in block], np.int64).view(np.uint64)
    low = np.uint64(int("01" * 32, 2))
    for x in range(len(block) - 1):
        unlike = packed[x + 1:] ^ packed[x]
        apart = np.bitwise_count((unlike | (unlike >> np.uint64(1))) & low).sum(axis=1)
        near = (HASHES - apart >= least) & (label[x + 1:] != label[x])
        if i != j:
            near &= chunk[x + 1:] != chunk[x]
        yield x, np.flatnonzero(near) + x + 1


def _near_members(block: list[tuple], least: int, order: list[int]) -> Iterator[tuple]:
    """The rows of a block that have a partner, without their bits."""
    some = np.zeros(len(block), bool)
    for x, partners in _near_in_block(block, least):
        some[partners] = True
        some[x] |= len(partners) > 0
    for x in np.flatnonzero(some):
        yield tuple(block[x][k] for k in order)


def _block_links(block: list[tuple], least: int, percent: int) -> Iterator[tuple[int, int]]:
    bucket = block[0][0]
    root = {r[5]: r[5] for r in block}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    bands = np.array([r[7] for r in block], np.int64)
    label = [r[5] for r in block]
    sets = [np.frombuffer(r[8], np.uint64) for r in block]
    for x, partners in _near_in_block(block, least):
        for y in partners:
            # the first band that two classes share answers for the pair
            if bands[x][np.argmax(bands[x] == bands[y])] != bucket or find(label[x]) == find(label[y]):
                continue
            if similar(sets[x], sets[y], percent):
                root[find(label[x])] = find(label[y])
                yield block[x][4], block[y][4]


def near_duplicates(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 80
) -> DataFrame:
    """(key, n_shingles, component_id, kept): one row for each row of ``docs``. ``percent`` is LEAST_PERCENT or more."""
    if percent < LEAST_PERCENT:
        raise ValueError(f"the bands miss links below {LEAST_PERCENT} percent, got {percent}")
    told = materialise(document_sets(docs, key, text, words_each).withColumnRenamed(key, "_id"))
    classes = materialise(told.filter("set_key IS NOT NULL").groupBy("set_key").agg(
        F.min("_id").alias("first_doc"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"),
        F.first("packed").alias("packed"),
    ).withColumn("cid", F.monotonically_increasing_id()))
    links = _links(docs, key, text, words_each, percent, classes)
    groups = components(links)
    firsts = classes.select("cid", "first_doc", "set_key").join(groups.withColumnRenamed("node", "cid"), "cid", "left")
    firsts = firsts.withColumn("label", F.coalesce("label", "cid"))
    smallest = firsts.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    named = firsts.join(smallest, "label").select("set_key", "component_id")
    joined = told.select("_id", "set_key", "n_shingles").join(named, "set_key", "left")
    component = F.when(F.col("set_key").isNull(), F.col("_id")).otherwise(F.col("component_id"))
    return joined.select(
        F.col("_id").alias(key), "n_shingles", component.alias("component_id"),
        F.col("_id").eqNullSafe(component).alias("kept"),
    )


def _links(docs, key, text, words_each, percent, classes: DataFrame) -> DataFrame:
    """Confirmed links (a, b) between classes, enough of them to connect every component."""
    least = least_matches(percent / 100)
    # written once and dealt by rows: there are 42 short ones for each class, many in few bytes
    banded = materialise(classes.select("cid", F.explode("bands").alias("bucket")))
    with dealt_by_rows(docs.sparkSession, banded.count()):
        shared = banded.groupBy("bucket").agg(F.min("cid").alias("rep"), F.count("*").alias("n")).filter("n > 1")
        shared = materialise(shared.select("bucket", "rep"))
        members = materialise(banded.join(shared, "bucket"))
    release(banded, shared)
    light = classes.select("cid", "packed")
    pairs = members.filter("rep <> cid").select(F.col("rep").alias("a"), F.col("cid").alias("b")).distinct()
    rated = pairs.join(light.toDF("a", "pa"), "a").join(light.toDF("b", "pb"), "b").select(
        "a", "b", _matches("pa", "pb").alias("matches")
    )
    stars = materialise(rated.filter(F.col("matches") >= least))
    needed = members.select("cid").distinct().join(classes.select("cid", "set_key", "first_doc"), "cid")
    sets = materialise(_class_sets(docs, key, text, words_each, needed))

    best = stars.groupBy("b").agg(F.max_by("a", F.struct("matches", "a")).alias("a")).select("a", "b")
    links = materialise(_confirmed(best, sets, percent))
    label = components(links)
    told = stars.join(label.toDF("a", "la"), "a", "left").join(label.toDF("b", "lb"), "b", "left")
    across = told.filter(F.coalesce("la", "a") != F.coalesce("lb", "b")).select("a", "b").join(best, ["a", "b"], "left_anti")
    links = materialise(links.union(_confirmed(across, sets, percent)))
    links = links.union(_rest(members, components(links), classes, sets, percent / 100, percent))
    return materialise(links)


def deduplicate(docs: DataFrame, key: str = "doc_id", text: str = "text", words_each: int = 5, percent: int = 80):
    """The rows of ``docs`` without those whose component has a smaller id; one of equal rows stays."""
    content = fresh_name("_content", docs.columns)
    keyed = docs.withColumn(content, content_key(key, text))
    told = materialise(near_duplicates(keyed, content, text, words_each, percent))
    gone = materialise(told.filter("NOT kept").select(content).distinct())
    left = keyed.join(F.broadcast(gone) if gone.count() <= BROADCAST_IDS else gone, content, "left_anti")
    again = told.filter("kept").groupBy(content).agg(F.count("*").alias("n")).filter("n > 1")
    if not again.isEmpty():  # rows equal in id and text: only then are the texts worth a shuffle
        left = left.dropDuplicates([content])
    return left.select(docs.columns)

"""Benchmark decontamination: Wu-Manber search of benchmark windows, word by word.

The patterns are the windows of an item: every run of ``window`` words, or all its words where it has fewer. A shift
table over blocks of two words tells how far a search may jump; where it says zero, the bucket of that last block, split
by the first block, names the windows to compare directly.

The benchmark is cut into pieces of words, each (item, piece) once however often its row recurs. Pieces are broadcast in
blocks of bounded size, dealt by their summed bytes, so a benchmark of any size is searched whole. Each block is a pass
over the documents that writes only the spans it finds; then its broadcast goes. Only these spans are shuffled, by row.

Defined results: null and empty texts have no words and no hits, a null or wordless item no windows; items that share an
id count once, a null id counts as the empty string; repeated rows give equal rows; empty tables give an empty table or
no hits; other columns are not read.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelspark.llm.common import as_bytes, content_key, in_batches, map_documents, map_in_arrow
from panelspark.operators.schema import fresh_name
from panelspark.session import materialise

WINDOW = 13
#: UTF-8 bytes of pieces and item ids in one broadcast, at most, unless a single piece has more.
BLOCK_BYTES = 1 << 20
#: Words of a piece; the next one repeats the last words of the one before, as many as a window less one.
PIECE_WORDS = 4096
#: Buckets of pieces for each block, which are dealt whole.
BUCKETS_EACH = 8
#: Letters and digits after lower-casing A-Z, and all bytes of other characters; the rest becomes a space.
_FOLD = bytes(
    b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256)
)


def words_of(text: bytes) -> list[bytes]:
    """Maximal runs of ASCII letters and digits and of other characters from U+0080 on, with A-Z in lower case."""
    return text.translate(_FOLD).split()


class WuManber:
    """Search of many word sequences of one length."""

    def __init__(self, length: int, patterns: dict[bytes, set[str]]):
        self.length = length
        self.block = min(2, length)
        self.jump = length - self.block + 1
        self.shift: dict[bytes, int] = {}
        self.buckets: dict[bytes, dict[bytes, list[tuple[bytes, set[str]]]]] = defaultdict(dict)
        for pattern, items in patterns.items():
            words = pattern.split(b" ")
            for end in range(self.block, length + 1):
                key = b" ".join(words[end - self.block:end])
                self.shift[key] = min(self.shift.get(key, self.jump), length - end)
            first = b" ".join(words[:self.block])
            self.buckets[key].setdefault(first, []).append((pattern, items))

    def search(self, words: list[bytes]) -> Iterator[tuple[int, set[str]]]:
        """(place of the first word, items) of every occurrence."""
        at, shift, jump, m = self.length - 1, self.shift.get, self.jump, self.length
        pairs = self.block == 2
        while at < len(words):
            key = words[at - 1] + b" " + words[at] if pairs else words[at]
            step = shift(key, jump)
            if step:
                at += step
                continue
            start = at - m + 1
            first = words[start] + b" " + words[start + 1] if pairs else words[start]
            for pattern, items in self.buckets[key].get(first, ()):
                if b" ".join(words[start:at + 1]) == pattern:
                    yield start, items
            at += 1


def build(items: Iterable[tuple[str, bytes]], window: int = WINDOW) -> list[WuManber]:
    """One search for each length of window that the items have."""
    patterns: dict[int, dict[bytes, set[str]]] = defaultdict(lambda: defaultdict(set))
    for item, text in items:
        words = words_of(text)
        m = min(window, len(words))
        for i in range(len(words) - m + 1 if m else 0):
            patterns[m][b" ".join(words[i:i + m])].add(item)
    return [WuManber(m, patterns[m]) for m in sorted(patterns)]


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text", item_key: str = "item_id",
    item_text: str = "text", window: int = WINDOW,
) -> DataFrame:
    """(key, n_words, n_hit, items): words of the whole text, those inside any occurrence of a window, and the ids (as
    strings, ascending) of the items whose windows occur."""
    spark = docs.sparkSession
    pieces = _pieces(benchmark, item_key, item_text, window)
    blocks = _blocks(pieces)
    kept = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    kind = kept.schema["key"].dataType.simpleString()
    if len(blocks) == 1:
        found = _search(kept, f"key {kind}, n_words bigint, n_hit bigint, items array<string>", _sent(spark, pieces), window)
        return found.withColumnRenamed("key", key)
    rows = materialise(kept.withColumn("row", F.monotonically_increasing_id()).select("row", "key", "text"))
    spans = None
    for lo, hi in blocks:
        block = _sent(spark, pieces.filter(F.col("bucket").between(lo, hi)))
        found = materialise(_search(
            rows.select("row", "text"), "row bigint, starts array<int>, stops array<int>, items array<string>", block, window
        ))
        block.destroy()
        spans = found if spans is None else spans.union(found)
    return _joined(rows, spans, kind).withColumnRenamed("key", key)


def _pieces(benchmark: DataFrame, item_key: str, item_text: str, window: int) -> DataFrame:
    """(item, piece, bytes, bucket): the distinct pieces of every item, whose windows are the item's."""

    def make(items, texts):
        for item, text in zip(items, texts):
            words = words_of(text)
            step = max(1, PIECE_WORDS - window + 1)
            for i in range(0, max(1, len(words) - window + 1) if words else 0, step):
                piece = b" ".join(words[i:i + step + window - 1])
                yield len(piece), (item, piece.decode())

    items = benchmark.select(F.coalesce(F.col(item_key).cast("string"), F.lit("")).alias("item"), F.col(item_text).alias("text"))
    cut = map_documents(items.distinct(), ["item"], ["text"], make, "item string, piece string").distinct()
    size = cut.withColumn("bytes", F.octet_length("item") + F.octet_length("piece"))
    pieces = materialise(size.withColumn("hash", F.xxhash64("item", "piece")))
    total = pieces.agg(F.sum("bytes")).first()[0] or 0
    n_buckets = BUCKETS_EACH * -(-total // BLOCK_BYTES) if total > BLOCK_BYTES else 1
    return pieces.withColumn("bucket", F.pmod("hash", F.lit(n_buckets)))


def _blocks(pieces: DataFrame) -> list[tuple[int, int]]:
    """First and last bucket of each block; only a bucket that is larger by itself exceeds BLOCK_BYTES."""
    blocks: list[tuple[int, int]] = []
    held = 0
    for bucket, size in sorted(tuple(r) for r in pieces.groupBy("bucket").agg(F.sum("bytes")).collect()):
        if blocks and held + size <= BLOCK_BYTES:
            blocks[-1], held = (blocks[-1][0], bucket), held + size
        else:
            blocks.append((bucket, bucket))
            held = size
    return blocks or [(0, 0)]


def _sent(spark: SparkSession, pieces: DataFrame) -> Broadcast:
    return spark.sparkContext.broadcast([(r.item, r.piece.encode()) for r in pieces.select("item", "piece").collect()])


def _merged(spans: Iterable[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for start, stop in sorted(spans):
        if out and start <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], stop))
        else:
            out.append((start, stop))
    return out


def _search(df: DataFrame, ddl: str, block: Broadcast, window: int) -> DataFrame:
    """One block's occurrences in (key, text): counts and items of every row, or with a field "starts" the spans and items
    of the rows that have any."""
    out = to_arrow_schema(StructType.fromDDL(ddl))
    whole = "starts" not in out.names

    def rows(batches: Iterator[pa.RecordBatch]):
        searches = None
        for batch in batches:
            searches = build(block.value, window) if searches is None else searches
            for key, text in zip(batch.column(0).to_pylist(), as_bytes(batch.column(1))):
                words = words_of(text)
                spans, names = [], set()
                for search in searches:
                    for start, owners in search.search(words):
                        names |= owners
                        if spans and spans[-1][0] <= start <= spans[-1][1]:
                            spans[-1] = (spans[-1][0], max(spans[-1][1], start + search.length))
                        else:
                            spans.append((start, start + search.length))
                spans = _merged(spans)
                if whole:
                    yield 32, (key, len(words), sum(z - a for a, z in spans), sorted(names))
                elif spans:
                    yield 8 * len(spans), (key, [a for a, _ in spans], [z for _, z in spans], sorted(names))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), out)

    return map_in_arrow(df, run, ddl)


def _joined(rows: DataFrame, spans: DataFrame, kind: str) -> DataFrame:
    """The result for the rows (row, key, text) from the spans that all blocks found."""

    def count(ids, keys, texts):
        for row, key, text in zip(ids, keys, texts):
            yield 32, (row, key, len(words_of(text)))

    def merge(ids, starts, stops, items):
        for row, a, z, names in zip(ids, starts, stops, items):
            merged = _merged((x, y) for s, t in zip(a, z) for x, y in zip(s, t))
            yield 32, (row, sum(y - x for x, y in merged), sorted({n for some in names for n in some}))

    counted = map_documents(rows, ["row", "key"], ["text"], count, f"row bigint, key {kind}, n_words bigint")
    lists = spans.groupBy("row").agg(*(F.collect_list(c).alias(c) for c in ("starts", "stops", "items")))
    hits = map_documents(lists, lists.columns, [], merge, "row bigint, n_hit bigint, items array<string>")
    return counted.join(hits, "row", "left").select(
        "key", "n_words", F.coalesce("n_hit", F.lit(0)).cast("bigint").alias("n_hit"),
        F.coalesce("items", F.array().cast("array<string>")).alias("items"),
    )


def contaminated() -> Column:
    """Whether a twentieth or more of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    content = fresh_name("_content", docs.columns)
    keyed = docs.withColumn(content, content_key(key, text))
    found = find_contamination(keyed, benchmark, content, text)
    gone = materialise(found.filter(contaminated()).select(content).distinct())
    return keyed.join(gone, content, "left_anti").select(docs.columns)

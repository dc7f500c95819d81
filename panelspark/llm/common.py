"""Helpers that the operators of this subpackage share: tables, folders that Python tasks can write, Arrow batches."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelspark.session import shared_folder

#: Bytes of values after which a task hands an Arrow batch back to Spark.
BATCH_BYTES = 4 << 20
#: Most rows that Spark hands to a task in one Arrow batch: texts and sets may be long, so a batch holds few of them.
BATCH_ROWS = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def new_folder(spark: SparkSession, kind: str) -> str:
    """A fresh path below the folder that driver and executors share."""
    return f"{shared_folder(spark)}/{kind}-{uuid.uuid4().hex}"


def open_path(path: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a URI, or of a plain local path."""
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path.removeprefix("file:").lstrip("/")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def as_bytes(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of a string column, without a copy into Python strings; null becomes empty."""
    return [v or b"" for v in column.cast(pa.binary()).to_pylist()]


def in_batches(rows: Iterable[tuple[int, tuple]], schema: pa.Schema) -> Iterator[pa.RecordBatch]:
    """Rows, each with its size in bytes, as record batches of about BATCH_BYTES."""
    held: list[tuple] = []
    size = 0
    for n, row in rows:
        held.append(row)
        size += n + 64
        if size >= BATCH_BYTES:
            yield _batch(held, schema)
            held, size = [], 0
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=f.type) for values, f in zip(zip(*rows), schema)], schema=schema
    )


_ABSENT = object()


class Memo(dict):
    """What ``make`` gives for a byte string, remembered within ``limit`` bytes, in two generations: a younger one of half
    of that becomes the older one, whose entries move over when they are asked for again. Frequent keys so stay; keys of
    over LONGEST bytes are not remembered."""

    #: Bytes of the Python objects of an entry, beside what they hold.
    ENTRY_BYTES = 140
    LONGEST = 64

    def __init__(self, limit: int):
        super().__init__()
        self.limit, self.held, self.older = limit, 0, {}

    def make(self, key: bytes):
        raise NotImplementedError

    def size(self, value) -> int:
        return len(value)

    def __missing__(self, key: bytes):
        value = self.older.pop(key, _ABSENT)
        if value is _ABSENT:
            value = self.make(key)
        if len(key) <= self.LONGEST:
            if self.held >= self.limit // 2:
                self.older = dict(self)
                super().clear()
                self.held = 0
            self[key] = value
            self.held += self.ENTRY_BYTES + len(key) + self.size(value)
        return value

    def clear(self) -> None:
        super().clear()
        self.older, self.held = {}, 0


def byte_alphabet() -> dict[int, str]:
    """Byte-level vocabularies write a byte as the printable Latin-1 character of its number; the others, in order, as
    the characters from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(0x100 + i) for i, b in enumerate(others)}


_BYTE_LEVEL = byte_alphabet()


def model_ids(model, text: str) -> list[int]:
    """Ids of one pre-token by a byte-level model alone, without normalisers and splitting."""
    return [t.id for t in model.tokenize(text.encode().decode("latin-1").translate(_BYTE_LEVEL))]


_MEMOS_IN_USE: list[dict] = []


def sole_memo(memo: dict) -> None:
    """Mark the memo that this worker process fills; one that an earlier stage left in the process is emptied."""
    if _MEMOS_IN_USE and _MEMOS_IN_USE[0] is memo:
        return
    if _MEMOS_IN_USE:
        _MEMOS_IN_USE[0].clear()
    _MEMOS_IN_USE[:] = [memo]
    gc.freeze()  # modules and vocabularies stay: the collector need not visit them while the memo fills


def map_in_arrow(df: DataFrame, run: Callable, schema: StructType | str) -> DataFrame:
    """``df.mapInArrow`` with batches of BATCH_ROWS rows at most, which bounds what a task holds beside one text."""
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, BATCH_ROWS)

    def run_and_rest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        _hand_back()

    return df.mapInArrow(run_and_rest, schema)


def _hand_back() -> None:
    """Gives free memory back to the machine: an idle worker process should not keep what a long text once took."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # glibc only
        ctypes.CDLL("libc.so.6").malloc_trim(0)


@contextmanager
def dealt_by_rows(spark: SparkSession, rows: int, each: int = 250_000) -> Iterator[None]:
    """Shuffles that run inside have a partition for ``each`` rows, however few bytes those are."""
    partitions, coalesce = "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled"
    before = {k: spark.conf.get(k) for k in (partitions, coalesce)}
    spark.conf.set(partitions, max(int(before[partitions]), -(-rows // each)))
    spark.conf.set(coalesce, False)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)


def map_documents(
    df: DataFrame, keys: list[str], texts: list[str], make: Callable[..., Iterable[tuple[int, tuple]]], fields: str
) -> DataFrame:
    """``make`` gets a batch as one list for each column: keys as they are, texts as UTF-8 bytes with null as empty. It
    yields (size in bytes, values of ``fields``), a DDL string in which ``{name}`` is the type of the column of ``df``."""
    out = StructType.fromDDL(fields.format(**{f.name: f.dataType.simpleString() for f in df.schema}))
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                yield from make(*[b.column(c).to_pylist() for c in keys], *[as_bytes(b.column(c)) for c in texts])

        yield from in_batches(rows(), schema)

    return map_in_arrow(df.select(*keys, *texts), run, out)


def filter_documents(df: DataFrame, text: str, decide: Callable[[list[bytes]], Iterable[bool]]) -> DataFrame:
    """The rows of ``df`` whose text ``decide`` lets stay, with all their columns; texts arrive as UTF-8 bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.filter(pa.array(decide(as_bytes(b.column(b.schema.get_field_index(text)))), pa.bool_()))

    return map_in_arrow(df, run, df.schema)


def content_key(key: str = "doc_id", text: str = "text") -> Column:
    """Key of a row's content: rows that share an id but not the text differ."""
    return F.struct(F.col(key).alias("id"), F.xxhash64(text).alias("hash"))

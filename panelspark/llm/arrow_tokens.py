"""Token ids in Arrow files: record batches of fixed-size lists, one list for each equal-length sequence and its mask.

Documents are laid out in ascending key order, each followed by an end id, and cut into sequences of one length; only
the last sequence of a file is padded, with zeros that its mask marks. Beside each data file lies an Arrow file with the
place of every document. Both are written uncompressed, so a reader that maps a file gets sequences, masks and whole
documents as views of the mapped pages.

Every attempt of a task writes files of its own name; the manifest, a table that Spark commits, names those that count.
A retried or speculative task therefore never spoils a result, and files it left behind are not read.

Defined results: a null or empty text is the end id alone; rows that share a key lie side by side, by a hash of the text
and then by their place in the input; null keys come last; an empty table makes no data file; other columns are not read.
"""

from __future__ import annotations

import re
import unicodedata
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructType

from panelspark.llm.common import Memo, as_bytes, in_batches, map_in_arrow, model_ids, new_folder, open_path, sole_memo
from panelspark.session import materialise

SEQUENCE_LENGTH = 2048
#: Sequences of a record batch; every batch of a file but the last has as many, so a place gives its batch.
BATCH_SEQUENCES = 128
#: Bytes that one Python worker's memo may take.
MEMO_BYTES = 160 << 20
#: Lower-case letters that normalisation leaves as they are; a word of them is one pre-token.
_SETTLED = re.compile("[a-zß-öø-ÿ]+").fullmatch
#: Punctuation behind an ASCII letter starts a pre-token, whatever follows: words are remembered without it.
_AFTER_LETTER = re.compile(rb"[.,;:!?](?<=[a-z].)").sub
#: Punctuation that may end a word; no contraction starts with it.
_TAIL = b".,;:!?#$%&*|)"
_MANIFEST = "part int, data_path string, index_path string, n_docs bigint, n_ids bigint"


def _only_letters(text: str) -> bool:
    """Whether the composed text is letters, also in lower case: either form gives some letters a combining mark, which
    would be one pre-token with punctuation behind it."""
    text = unicodedata.normalize("NFC", text)
    return text.isalpha() and text.lower().isalpha()


class WordMemo(Memo):
    """Memo from a word, cut at ASCII white space, to its ids.

    Right for tokenizers that drop white space, compose (NFC), lower-case, and split letters from punctuation before they
    merge: for those, letters with punctuation after them have the ids of both parts, and a word in lower case those of
    the word, unless combining marks follow a letter of it: h with a macron below composes, H with one does not. Where the
    tokenizer is byte-level, a word of settled letters goes to its model without normalisers and splitting.
    """

    def __init__(self, tokenizer, dtype: str):
        super().__init__(MEMO_BYTES)
        self.tokenizer, self.dtype = tokenizer, dtype
        added = tokenizer.get_added_tokens_decoder()
        if any(not t.special or t.normalized or t.single_word or t.lstrip or t.rstrip for t in added.values()):
            raise ValueError("added tokens must be special ones that are matched as they are written")
        tokenizer.encode_special_tokens = True  # words are in lower case, which must not make an added token of them
        self.added = {t.content.encode(): np.array([i], dtype).tobytes() for i, t in added.items()}
        longest_first = sorted(self.added, key=len, reverse=True)
        self.cut = re.compile(b"(" + b"|".join(map(re.escape, longest_first)) + b")").split if added else lambda text: [text]

        probes = ("the", "stra\u00dfe", "na\u00efvet\u00e9")
        self.direct = all(model_ids(tokenizer.model, w) == self._whole(w) for w in probes)

    def _whole(self, word: str) -> list[int]:
        return self.tokenizer.encode(word, add_special_tokens=False).ids

    def make(self, word: bytes) -> bytes:
        letters = word.rstrip(_TAIL)
        if len(letters) < len(word) and _only_letters(letters.decode()):
            return self[letters] + self[word[len(letters):]]
        text = word.decode()
        ids = model_ids(self.tokenizer.model, text) if self.direct and _SETTLED(text) else self._whole(text)
        return np.array(ids, self.dtype).tobytes()

    def encode(self, text: bytes) -> bytes:
        """The ids of a text; it is cut at the strings of added tokens, which have ids of their own, in their case only."""
        parts = self.cut(text)
        if len(parts) == 1:
            return self._plain(text)
        return b"".join(self.added[p] if i % 2 else self._plain(p) for i, p in enumerate(parts))

    def _plain(self, text: bytes) -> bytes:
        # bytes: A-Z and ASCII white space only
        if b"\xcc" not in text and b"\xcd" not in text:  # lead bytes of U+0300-037F, all marks that compose with A-Z
            return b"".join(map(self.__getitem__, _AFTER_LETTER(rb" \g<0>", text.lower()).split()))
        return b"".join(self[w if b"\xcc" in w or b"\xcd" in w else w.lower()] for w in text.split())


_MEMOS: dict[tuple[str, str], WordMemo] = {}


def id_type(vocabulary_size: int) -> str:
    return "<u2" if vocabulary_size <= 1 << 16 else "<u4"


def _memo(path: str) -> WordMemo:
    """This process's memo; its ids are those of the library with its defaults."""
    if path not in _MEMOS:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _MEMOS[path] = WordMemo(tokenizer, id_type(tokenizer.get_vocab_size()))
    return _MEMOS[path]


class SequenceWriter:
    """Appends the ids of documents to a data file and keeps their places for the index file."""

    def __init__(self, folder: str, name: str, dtype: str, key_type: pa.DataType, length: int):
        self.files, root = open_path(folder)
        self.files.create_dir(root, recursive=True)
        self.paths = [f"{folder}/{name}.arrow", f"{folder}/{name}.docs.arrow"]
        self.length, self.dtype = length, np.dtype(dtype)
        self.schema = pa.schema([
            ("input_ids", pa.list_(pa.from_numpy_dtype(self.dtype), length)),
            ("attention_mask", pa.list_(pa.bool_(), length)),
        ])
        self.index_schema = pa.schema([("key", key_type), ("start", pa.int64()), ("n_ids", pa.int64())])
        self.sinks = [self.files.open_output_stream(open_path(p)[1]) for p in self.paths]
        self.data = pa.ipc.new_file(self.sinks[0], self.schema)
        self.index = pa.ipc.new_file(self.sinks[1], self.index_schema)
        self.held: list[bytes] = []
        self.held_ids = self.n_ids = self.n_docs = 0
        self.places: list[tuple] = []

    def add(self, key, ids: bytes) -> None:
        n = len(ids) // self.dtype.itemsize
        self.places.append((key, self.n_ids, n))
        self.held.append(ids)
        self.held_ids += n
        self.n_ids += n
        self.n_docs += 1
        if self.held_ids >= BATCH_SEQUENCES * self.length:
            self._write(last=False)
        if len(self.places) >= 10_000:
            self._write_places()

    def _write(self, last: bool) -> None:
        ids = np.frombuffer(b"".join(self.held), self.dtype)
        step = BATCH_SEQUENCES * self.length
        whole = len(ids) if last else len(ids) // step * step
        for i in range(0, whole, step):
            part = ids[i:i + step]
            rows = -(-len(part) // self.length)
            mask = np.arange(rows * self.length) < len(part)
            padded = np.zeros(rows * self.length, self.dtype)
            padded[:len(part)] = part
            self.data.write_batch(pa.RecordBatch.from_arrays([
                pa.FixedSizeListArray.from_arrays(pa.array(padded), self.length),
                pa.FixedSizeListArray.from_arrays(pa.array(mask), self.length),
            ], schema=self.schema))
        self.held = [ids[whole:].tobytes()]
        self.held_ids = len(ids) - whole

    def _write_places(self) -> None:
        if self.places:
            columns = [pa.array(c, type=f.type) for c, f in zip(zip(*self.places), self.index_schema)]
            self.index.write_batch(pa.RecordBatch.from_arrays(columns, schema=self.index_schema))
            self.places = []

    def close(self) -> None:
        self._write(last=True)
        self._write_places()
        for x in (self.data, self.index, *self.sinks):
            x.close()


class SequenceReader:
    """Random access to a data file: sequences, masks, and the ids of any stretch of places."""

    def __init__(self, path: str):
        files, inner = open_path(path)
        local = files.type_name == "local"
        self.source = pa.memory_map(inner) if local else files.open_input_file(inner)
        self.file = pa.ipc.open_file(self.source)
        self.length = self.file.schema.field("input_ids").type.list_size

    def sequence(self, i: int) -> tuple[np.ndarray, pa.Array]:
        """The ids (a view of the file where it is mapped) and the mask of sequence ``i``."""
        batch, row = divmod(i, BATCH_SEQUENCES)
        found = self.file.get_batch(batch)
        ids = found.column(0).flatten().to_numpy(zero_copy_only=True)
        return ids[row * self.length:(row + 1) * self.length], found.column(1)[row].values

    def ids(self, start: int, n: int) -> np.ndarray:
        """``n`` ids from place ``start`` on: a view where they lie in one record batch."""
        step = BATCH_SEQUENCES * self.length
        parts = []
        while n > 0:
            batch, at = divmod(start, step)
            flat = self.file.get_batch(batch).column(0).flatten().to_numpy(zero_copy_only=True)
            parts.append(flat[at:at + n])
            start, n = start + len(parts[-1]), n - len(parts[-1])
        return parts[0] if len(parts) == 1 else np.concatenate(parts) if parts else np.zeros(0, np.uint32)

    def close(self) -> None:
        self.source.close()


def write_sequences(
    docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
    length: int = SEQUENCE_LENGTH, folder: str | None = None,
) -> DataFrame:
    """Encodes ``docs`` in ascending key order into Arrow files below ``folder``; returns the manifest of the files.

    The order comes from a range partitioning of the rows, so no task holds more than its range; equal keys are split
    by a hash of the text and the row's place, so a key with a third of all rows is no single task's either.
    """
    folder = folder or new_folder(docs.sparkSession, "sequences")
    order = [F.asc_nulls_last("_k"), F.asc("_h"), F.asc("_i")]
    placed = docs.select(F.col(key).alias("_k"), F.col(text).alias("_t")).select(
        "*", F.xxhash64("_t").alias("_h"), F.monotonically_increasing_id().alias("_i")
    )
    key_type = to_arrow_type(placed.schema["_k"].dataType)
    out = to_arrow_schema_of(_MANIFEST)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        memo = _memo(tokenizer_path)
        sole_memo(memo)
        end = np.array([end_id], memo.dtype).tobytes()
        writer = None
        for b in batches:
            for k, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                writer = writer or SequenceWriter(
                    folder, f"part-{part:06d}-{uuid.uuid4().hex}", memo.dtype, key_type, length
                )
                writer.add(k, memo.encode(t) + end)
        if writer:
            writer.close()
            row = (part, *writer.paths, writer.n_docs, writer.n_ids)
            yield from in_batches([(0, row)], out)

    written = placed.repartitionByRange(*order).sortWithinPartitions(*order).select("_k", "_t")
    return materialise(map_in_arrow(written, write, _MANIFEST))


def to_arrow_schema_of(ddl: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema

    return to_arrow_schema(StructType.fromDDL(ddl))


def read_documents(spark: SparkSession, manifest: DataFrame, key_type: str, key: str = "doc_id") -> DataFrame:
    """From the files that ``manifest`` names: (key, start, n_tokens, ids_crc32), ``start`` counting the ids of all
    documents before, ``ids_crc32`` over the ids as little-endian unsigned 32-bit integers. One task reads one file."""
    files = manifest.withColumn(
        "before", F.sum("n_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    ).select("data_path", "index_path", F.coalesce("before", F.lit(0)).cast("bigint").alias("before"))
    ddl = f"`{key}` {key_type}, start bigint, n_tokens bigint, ids_crc32 bigint"
    out = to_arrow_schema_of(ddl)

    def rows(batches):
        for b in batches:
            for data_path, index_path, before in zip(*(c.to_pylist() for c in b.columns)):
                reader = SequenceReader(data_path)
                store, inner = open_path(index_path)
                with store.open_input_file(inner) as source:
                    index = pa.ipc.open_file(source)
                    for i in range(index.num_record_batches):
                        for k, start, n in zip(*(c.to_pylist() for c in index.get_batch(i).columns)):
                            crc = zlib.crc32(reader.ids(start, n).astype("<u4"))
                            yield 32, (k, before + start, n, crc)
                reader.close()

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from in_batches(rows(batches), out)

    return files.repartition(max(1, manifest.count())).mapInArrow(read, ddl)

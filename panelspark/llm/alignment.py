"""Alignment of two tokenizers' tokens over the same bytes, and how common their linked id pairs are in the corpus.

A is a byte-level vocabulary of the tokenizers library, which gets a space and the text; B a piece model of the
sentencepiece library, which adds that space itself. For each id list a dictionary maps the byte where a token ends to its
index. The keys that both dictionaries hold, in order, cut both lists into groups; inside a group, tokens whose bytes
overlap are linked. A text is cut before single spaces first, where tokens of both always end, so that a stretch that
repeats is encoded and aligned once for each worker (its memo is bounded by bytes).

Counting needs the distinct pairs of every document. A task therefore gathers documents into chunks, numbers the chunk's
distinct pairs, and keeps each document's links as those numbers. What Spark shuffles to count pairs, and to bring the
counts back, is a row for each chunk and pair, not for each document and pair; the counts then meet the chunk's documents
in one bounded group. A frequent pair has one row a chunk, already counted; the highest count of an A id is one row for
each entry of A's vocabulary, which bounds what is broadcast.

Defined results: a text that is null, empty, or whose tokens' bytes differ from space and text has no tokens (zeros, and
empty groups); it still is a row. Repeated rows and ids, and null keys, are documents of their own; an empty table gives
an empty one; other columns are not read. Texts of any length are aligned whole.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate, count

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelspark.llm.bpe import stretches
from panelspark.llm.common import Memo, as_bytes, byte_alphabet, in_batches, map_in_arrow, model_ids, sole_memo
from panelspark.session import materialise

#: Bytes that one Python worker's memo may take.
MEMO_BYTES = 288 << 20
#: A chunk ends with the document that brings it to so many distinct links (summed over documents), or bytes of groups.
CHUNK_LINKS, CHUNK_BYTES = 400_000, 32 << 20
_PIECE_SPACE = "▁"
_LETTERS, _PUNCTUATION = "A-Za-zÀ-ÖØ-öø-ÿ", r"!-&(-/:-@\[-`{-~"
#: A space and letters, then punctuation: a pre-token each, which no normaliser changes.
_TWO_PARTS = re.compile(f"( [{_LETTERS}]+)([{_PUNCTUATION}]*)").fullmatch
_MIXED = re.compile(f"[{_LETTERS}][{_PUNCTUATION}]").search
_MARK = re.compile(f"[{_PUNCTUATION}]").fullmatch


def token_groups(a_ends: list[int], b_ends: list[int]) -> list[tuple[int, int]]:
    """For each group, the indices behind its last token in either list; both lists end at the same byte."""
    a_at = dict(zip(a_ends, count(1)))
    b_at = dict(zip(b_ends, count(1)))
    return [(a_at[end], b_at[end]) for end in sorted(a_at.keys() & b_at.keys())]


def overlaps(a_ends: list[int], b_ends: list[int], group: tuple[int, int, int, int]) -> Iterator[tuple[int, int]]:
    """Pairs (i, j) of tokens of a group, ``a[i0:i1]`` and ``b[j0:j1]``, whose byte ranges overlap."""
    i0, i1, j0, j1 = group
    for i in range(i0, i1):
        start = a_ends[i - 1] if i else 0
        j = bisect_right(b_ends, start, j0, j1)
        while j < j1 and (b_ends[j - 1] if j else 0) < a_ends[i]:
            yield i, j
            j += 1


class Aligner(Memo):
    """Memo from a stretch of text (UTF-8, with the space before it) to (tokens of A, of B, groups, their text, linked id
    pairs as 64-bit integers), or None where the tokens' bytes are not the stretch."""

    ENTRY_BYTES = 300

    def __init__(self, a_path: str, b_path: str):
        import sentencepiece
        from tokenizers import Tokenizer, decoders

        super().__init__(MEMO_BYTES)
        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.model = self.a.model
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        number = {c: i for i, c in byte_alphabet().items()}
        vocabulary = self.a.get_vocab(with_added_tokens=False)
        self.a_bytes = [b""] * (1 + max(vocabulary.values()))
        for token, i in vocabulary.items():
            self.a_bytes[i] = bytes(map(number.get, token))
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [
            bytes([int(p[3:-1], 16)]) if self.b.is_byte(i) else p.replace(_PIECE_SPACE, " ").encode()
            for i, p in enumerate(pieces)
        ]
        if not isinstance(self.a.decoder, decoders.ByteLevel) or any(_PIECE_SPACE in p.lstrip(_PIECE_SPACE) for p in pieces):
            raise ValueError("A must be byte-level, and no piece of B may reach over a space")
        # no piece reaches from a letter to the punctuation behind it: both are encoded, and remembered, apart
        marks = {chr(i) for i in range(128) if _MARK(chr(i))}
        special = (self.b.is_byte, self.b.is_control, self.b.is_unknown)
        plain = {p for i, p in enumerate(pieces) if not any(told(i) for told in special)}
        self.apart = marks <= plain and not any(map(_MIXED, plain))
        self.before_mark = len(self.b.encode("a", num_threads=1))
        self.direct = False
        self.direct = all(self._a_ids(t) == self._a_direct(*_TWO_PARTS(t).groups()) for t in (" the", " Stra\u00dfe,", " \u00c9t\u00e9&&"))

    def _a_direct(self, letters: str, punctuation: str) -> list[int]:
        ids = model_ids(self.model, letters)
        return ids + model_ids(self.model, punctuation) if punctuation else ids

    def _a_ids(self, text: str) -> list[int]:
        parts = _TWO_PARTS(text) if self.direct else None
        return self._a_direct(*parts.groups()) if parts else self.a.encode(text, add_special_tokens=False).ids

    def make(self, stretch: bytes) -> tuple | None:
        text = stretch.decode()
        if text[0] != " ":  # punctuation behind letters
            a, b = model_ids(self.model, text), self.b.encode("a" + text, num_threads=1)[self.before_mark:]
        else:
            parts = _TWO_PARTS(text) if self.direct else None
            if parts and parts[2] and self.apart:
                return self._together([self[parts[1].encode()], self[parts[2].encode()]])
            a = self._a_direct(*parts.groups()) if parts else self._a_ids(text)
            b = self.b.encode(text[1:], num_threads=1)
        a_parts, b_parts = list(map(self.a_bytes.__getitem__, a)), list(map(self.b_bytes.__getitem__, b))
        if b"".join(a_parts) != stretch or b"".join(b_parts) != stretch:
            return None
        a_ends, b_ends = list(accumulate(map(len, a_parts))), list(accumulate(map(len, b_parts)))
        if a_ends == b_ends:  # a group for each token
            links = [i << 32 | j for i, j in zip(a, b)]
            return len(a), len(a), len(a), ";".join([f"{i}|{j}" for i, j in zip(a, b)]), array("q", links).tobytes()
        texts, links, i0, j0 = [], [], 0, 0
        for i1, j1 in token_groups(a_ends, b_ends):
            if i1 - i0 == 1:  # one token on a side: it overlaps all of the other
                i = a[i0]
                if j1 - j0 == 1:
                    links.append(i << 32 | b[j0])
                    texts.append(f"{i}|{b[j0]}")
                else:
                    links += [i << 32 | j for j in b[j0:j1]]
                    texts.append(f"{i}|{','.join(map(str, b[j0:j1]))}")
            else:
                if j1 - j0 == 1:
                    links += [i << 32 | b[j0] for i in a[i0:i1]]
                else:
                    links += [a[i] << 32 | b[j] for i, j in overlaps(a_ends, b_ends, (i0, i1, j0, j1))]
                texts.append(",".join(map(str, a[i0:i1])) + "|" + ",".join(map(str, b[j0:j1])))
            i0, j0 = i1, j1
        return len(a), len(b), len(texts), ";".join(texts), array("q", links).tobytes()

    def size(self, value: tuple | None) -> int:
        return len(value[3]) + len(value[4]) if value else 0

    @staticmethod
    def _together(parts: list) -> tuple | None:
        if None in parts:
            return None
        n_a, n_b, n_groups, groups, links = zip(*parts)
        return sum(n_a), sum(n_b), sum(n_groups), ";".join(groups), b"".join(links)

    def document(self, text: bytes) -> tuple[int, int, int, str, bytes]:
        """As an entry of the memo, for a whole text."""
        whole = None
        if text:
            first, *rest = stretches(text)
            whole = self._together([self[b" " + first], *map(self.__getitem__, rest)])
        return whole or (0, 0, 0, "", b"")


_ALIGNERS: dict[tuple[str, str], Aligner] = {}


def _aligner(a_path: str, b_path: str) -> Aligner:
    if (a_path, b_path) not in _ALIGNERS:
        _ALIGNERS[a_path, b_path] = Aligner(a_path, b_path)
    sole_memo(_ALIGNERS[a_path, b_path])
    return _ALIGNERS[a_path, b_path]


def align(docs: DataFrame, a_path: str, b_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, n_a, n_b, n_groups, n_links, groups, chunk, links, times, pairs, holding): ``groups`` as
    ``a1,a2|b1;a3|b2,b3`` in decimal ids; ``links`` and ``times`` (32-bit integers) number the document's distinct id
    pairs within its chunk and say how often each is linked. The last row of a chunk has in ``pairs`` the chunk's pairs
    (64-bit, the A id in the upper half) and in ``holding`` (32-bit) how many documents of the chunk hold each."""
    fields = StructType.fromDDL(
        "n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, chunk bigint, links binary, "
        "times binary, pairs binary, holding binary"
    )
    out = StructType([docs.select(key).schema[0], *fields])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        chunk = TaskContext.get().partitionId() << 32
        aligner = _aligner(a_path, b_path)

        def numbered(held):
            pairs, number, holding = np.unique(
                np.concatenate([h[1] for h in held]), return_inverse=True, return_counts=True
            )
            ends = np.cumsum([len(h[1]) for h in held])
            numbers = np.split(number.astype("<u4"), ends[:-1])
            for i, ((row, _, times), links) in enumerate(zip(held, numbers), 1):
                last = (pairs.tobytes(), holding.astype("<u4").tobytes()) if i == len(held) else (None, None)
                size = len(row[5]) + 8 * len(links) + (12 * len(pairs) if last[0] else 0)
                yield size, (*row, chunk, links.tobytes(), times.astype("<u4").tobytes(), *last)

        def rows():
            nonlocal chunk
            held, n_links, size = [], 0, 0
            for b in batches:
                for k, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                    n_a, n_b, n_groups, groups, links = aligner.document(t)
                    pairs, times = np.unique(np.frombuffer(links, "<i8"), return_counts=True)
                    held.append(((k, n_a, n_b, n_groups, len(links) // 8, groups), pairs, times))
                    n_links, size = n_links + len(pairs), size + len(groups)
                    if n_links >= CHUNK_LINKS or size >= CHUNK_BYTES:
                        yield from numbered(held)
                        held, n_links, size = [], 0, 0
                        chunk += 1
            if held:
                yield from numbered(held)

        yield from in_batches(rows(), schema)

    return map_in_arrow(docs.select(key, text), run, out)


def pair_counts(written: DataFrame) -> tuple[DataFrame, DataFrame]:
    """From a written table of :func:`align`: (chunk, at, a, b, n), the pairs of every chunk, and (a, b, count, best),
    in how many documents of all a pair is linked, and whether no other pair of its A id is in more."""
    ddl = "chunk bigint, at int, a int, b int, n bigint"
    schema = to_arrow_schema(StructType.fromDDL(ddl))

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for chunk, pairs, holding in zip(*(c.to_pylist() for c in batch.columns)):
                p, n = np.frombuffer(pairs, "<i8"), np.frombuffer(holding, "<u4")
                columns = [
                    np.full(len(p), chunk), np.arange(len(p), dtype=np.int32), (p >> 32).astype(np.int32),
                    (p & 0xFFFFFFFF).astype(np.int32), n.astype(np.int64),
                ]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], schema=schema)

    packed = written.where("pairs IS NOT NULL").select("chunk", "pairs", "holding")
    in_chunks = map_in_arrow(packed, unpack, ddl)
    counts = in_chunks.groupBy("a", "b").agg(F.sum("n").alias("count"))
    highest = counts.groupBy("a").agg(F.max("count").alias("highest"))
    # a row for each entry of A's vocabulary at most
    counts = counts.join(F.broadcast(highest), "a").select("a", "b", "count", (F.col("count") == F.col("highest")).alias("best"))
    return in_chunks, counts


def count_links(aligned: DataFrame) -> DataFrame:
    """The rows of :func:`align` without its chunk columns (and with any others), and ``n_best``, ``count_sum``: links
    whose pair has the highest count of its A id, and the counts of all links, summed."""
    written = materialise(aligned)
    in_chunks, counts = pair_counts(written)
    looked = in_chunks.join(counts, ["a", "b"]).select("chunk", "at", "count", "best")
    packing = ("chunk", "links", "times", "pairs", "holding")
    kept = [c for c in aligned.columns if c not in packing]
    out = StructType([aligned.schema[c] for c in kept] + StructType.fromDDL("n_best bigint, count_sum bigint").fields)
    schema = to_arrow_schema(out)

    def judge(docs: pa.Table, found: pa.Table) -> pa.Table:
        docs, at = docs.combine_chunks(), found["at"].to_numpy()
        counts, best = np.zeros(len(at), np.int64), np.zeros(len(at), np.int64)
        counts[at], best[at] = found["count"].to_numpy(), found["best"].to_numpy()
        sums = []
        for links, times in zip(docs["links"].to_pylist(), docs["times"].to_pylist()):
            number, n = np.frombuffer(links, "<u4"), np.frombuffer(times, "<u4").astype(np.int64)
            sums.append((int(best[number] @ n), int(counts[number] @ n)))
        n_best, count_sum = zip(*sums) if sums else ((), ())
        columns = [docs[c] for c in kept] + [pa.array(n_best, pa.int64()), pa.array(count_sum, pa.int64())]
        return pa.Table.from_arrays(columns, schema=schema)

    docs = written.drop("pairs", "holding")
    return docs.groupBy("chunk").cogroup(looked.groupBy("chunk")).applyInArrow(judge, out)

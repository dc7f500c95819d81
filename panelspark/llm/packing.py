"""Best-fit packing of documents into sequences, planned on the histogram of lengths.

One pass encodes the documents and cuts them into pieces of at most one sequence. How well pieces pack depends on their
lengths alone, so the plan is made on counts: from the longest length down, all pieces of a length go, as many at a time
as fit, into the open sequences with the least room that is enough, then into new ones. Sequences that were filled alike
stay together as one range of numbers, so a length with a billion pieces costs the plan no more than one with ten.

A piece then takes the slot that the plan has for its rank within its length. Ranks need no sort and no window over a
length: each encoding task numbers its own pieces of a length, and a sum over the tasks, of at most one row for each
task and length, says where its numbers start.

Size of what reaches the driver: one count for each length (2,048 at most). Size of the plan, which is broadcast: a
length splits one range of sequences in up to three and opens two at most; a range that takes pieces keeps less than half
of its room, so a range of room r is used log2(r) times at most. For 2,048 tokens that bounds the plan by 5 x 2,048 x 11
runs, a few megabytes, whatever the corpus.

Defined results: a null or empty text is the end id alone; texts that are longer than a sequence are cut, and only they;
repeated rows and ids, and null keys, are documents of their own; an empty table gives an empty result; other columns are
not read. Which of two pieces of one length takes which slot is open, the number of sequences is not.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructType

from panelspark.llm.arrow_tokens import _memo
from panelspark.llm.common import as_bytes, in_batches, map_in_arrow, sole_memo
from panelspark.session import materialise

SEQUENCE_LENGTH = 2048
#: Bits of a rank in the key (length, rank) of the plan.
_RANK_BITS = 42


class Run(NamedTuple):
    """Pieces ``rank`` to ``rank + each * sequences - 1`` of a length: ``each`` in a row from ``offset`` on, in the
    sequences from ``first`` on."""

    length: int
    rank: int
    each: int
    first: int
    sequences: int
    offset: int


def best_fit(counts: dict[int, int], limit: int) -> list[Run]:
    """Runs that place all pieces: ``counts`` says how many there are of each length from 1 to ``limit``."""
    if any(not 1 <= length <= limit for length in counts):
        raise ValueError(f"lengths must lie between 1 and {limit}")
    open_ranges: list[list[tuple[int, int]]] = [[] for _ in range(limit + 1)]  # by room: (first sequence, how many)
    opened, runs = 0, []
    for length in sorted(counts, reverse=True):
        left, rank, room = counts[length], 0, length

        def place(each: int, first: int, sequences: int) -> None:
            nonlocal left, rank
            runs.append(Run(length, rank, each, first, sequences, limit - room))
            open_ranges[room - each * length].append((first, sequences))
            rank += each * sequences
            left -= each * sequences

        while left:
            while room < limit and not open_ranges[room]:
                room += 1
            each = room // length
            if not open_ranges[room]:
                needed = -(-left // each)
                open_ranges[room].append((opened, needed))
                opened += needed
            first, free = open_ranges[room].pop()
            filled = min(free, left // each)
            if filled:
                place(each, first, filled)
            if left and free > filled:  # the last pieces of this length do not fill a sequence
                place(left, first + filled, 1)
                filled += 1
            if free > filled:
                open_ranges[room].append((first + filled, free - filled))
    return runs


def encode_pieces(
    docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
    length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """(key, piece, start, length, ids, task, nth), written: the pieces of every document, ``ids`` as little-endian
    unsigned 32-bit integers, ``nth`` counting the pieces of one length that the encoding task has made before."""
    fields = StructType.fromDDL("piece int, start bigint, length bigint, ids binary, task int, nth bigint")
    out = StructType([docs.select(key).schema[0], *fields])
    schema = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task = TaskContext.get().partitionId()
        memo = _memo(tokenizer_path)
        sole_memo(memo)
        end = np.array([end_id], "<u4").tobytes()
        made = [0] * (length + 1)

        def rows():
            for b in batches:
                for k, t in zip(b.column(0).to_pylist(), as_bytes(b.column(1))):
                    ids = np.frombuffer(memo.encode(t), memo.dtype).astype("<u4").tobytes() + end
                    for i, at in enumerate(range(0, len(ids), 4 * length)):
                        part = ids[at:at + 4 * length]
                        n = len(part) // 4
                        yield len(part), (k, i, at // 4, n, part, task, made[n])
                        made[n] += 1

        yield from in_batches(rows(), schema)

    return materialise(map_in_arrow(docs.select(key, text), run, out))


def place(pieces: DataFrame, length: int = SEQUENCE_LENGTH) -> DataFrame:
    """``pieces`` (written, as :func:`encode_pieces` does) with ``sequence_id`` and ``offset`` in place of task and nth.

    Columns that are not needed, ids above all, are best dropped before: the rows are shuffled once.
    """
    by_task = pieces.groupBy("task", "length").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in by_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    runs = best_fit(counts, length)
    table = np.array(runs, np.int64).reshape(-1, len(Run._fields))
    starts = (table[:, 0] << _RANK_BITS) + table[:, 1]
    order = np.argsort(starts)
    plan = pieces.sparkSession.sparkContext.broadcast((starts[order], table[order]))

    earlier = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    bases = by_task.select("task", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    ranked = pieces.join(bases, ["task", "length"])
    kept = [c for c in pieces.columns if c not in ("task", "nth")]
    ranked = ranked.select(*kept, (F.col("base") + F.col("nth")).alias("rank"))
    out = StructType(ranked.select(*kept).schema.fields).add("sequence_id", LongType()).add("offset", LongType())
    schema = to_arrow_schema(out)

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        starts, table = plan.value
        for b in batches:
            size, rank = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "rank"))
            run = table[np.searchsorted(starts, (size << _RANK_BITS) + rank, "right") - 1]
            nth = rank - run[:, 1]
            slots = run[:, 3] + nth // run[:, 2], run[:, 5] + nth % run[:, 2] * size
            columns = [b.column(b.schema.get_field_index(c)) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, *map(pa.array, slots)], schema=schema)

    return ranked.mapInArrow(take, out)


def pack(
    docs: DataFrame, tokenizer_path: str, end_id: int, key: str = "doc_id", text: str = "text",
    length: int = SEQUENCE_LENGTH,
) -> DataFrame:
    """(key, piece, start, length, ids, sequence_id, offset) for every piece of every document."""
    return place(encode_pieces(docs, tokenizer_path, end_id, key, text, length), length)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_ids, ids) of the packed sequences; no group holds more than one sequence."""
    return packed.groupBy("sequence_id").agg(
        F.sum("length").alias("n_ids"), F.expr("listagg(ids, X'') WITHIN GROUP (ORDER BY offset)").alias("ids")
    )

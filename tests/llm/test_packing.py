import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelspark.llm import packing
from panelspark.llm.queries import PACK_END_ID, QUERIES, WORD_VOCABULARY
from tests.llm.conftest import EDGE, SF


@pytest.fixture(scope="module")
def ids():
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    return lambda text: [*tokenizer.encode(text or "", add_special_tokens=False).ids, PACK_END_ID]


def piece_by_piece(lengths, limit):
    """Rooms left by best fit, longest first, one piece at a time."""
    rooms = []
    for n in sorted(lengths, reverse=True):
        fits = [r for r in rooms if r >= n]
        if fits:
            rooms.remove(min(fits))
            rooms.append(min(fits) - n)
        else:
            rooms.append(limit - n)
    return rooms


def unrolled(runs):
    """(length, rank) -> (sequence, offset) of a plan."""
    return {
        (r.length, r.rank + i): (r.first + i // r.each, r.offset + i % r.each * r.length)
        for r in runs for i in range(r.each * r.sequences)
    }


@settings(max_examples=150, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 30), max_size=12))
def test_plan_is_best_fit(counts):
    limit = 40
    slots = unrolled(packing.best_fit(counts, limit))
    assert sorted(slots) == sorted((n, i) for n, c in counts.items() for i in range(c))
    filled = defaultdict(list)
    for (n, _), (sequence, offset) in slots.items():
        filled[sequence].append((offset, n))
    rooms = []
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        rooms.append(limit - at)
    assert sorted(rooms) == sorted(piece_by_piece(Counter(counts).elements(), limit))


def test_plan_stays_small():
    rng = np.random.default_rng(3)
    counts = {n: int(10 ** rng.uniform(0, 10)) for n in range(1, 2049)}
    runs = packing.best_fit(counts, 2048)
    assert sum(r.each * r.sequences for r in runs) == sum(counts.values())
    assert len(runs) < 5 * 2048 * 11
    assert max(r.rank + r.each * r.sequences for r in runs) < 1 << packing._RANK_BITS


def test_plan_refuses_what_does_not_fit():
    with pytest.raises(ValueError):
        packing.best_fit({5: 1}, 4)


def held(rows, documents, ids, limit):
    """Checks the pieces of (id, text) rows; returns the number of sequences."""
    expected = Counter()
    for k, text in documents:
        all_ids = ids(text)
        for i, at in enumerate(range(0, len(all_ids), limit)):
            part = np.array(all_ids[at:at + limit], "<u4")
            expected[k, i, at, len(part), zlib.crc32(part)] += 1
    assert Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in rows) == expected
    filled = defaultdict(list)
    for r in rows:
        filled[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in filled.values():
        at = 0
        for offset, n in sorted(places):
            assert offset == at
            at += n
        assert at <= limit
    assert len(filled) == len(piece_by_piece([r["length"] for r in rows], limit))
    return len(filled)


def test_query_on_the_whole_table(spark, documents, ids):
    rows = QUERIES["op13_packing"](spark, SF).collect()
    n = held(rows, documents, ids, packing.SEQUENCE_LENGTH)
    assert n <= 1 + math.ceil(sum(r["length"] for r in rows) / packing.SEQUENCE_LENGTH)


@pytest.mark.parametrize("limit", [16, 2048])
def test_odd_rows(edge, ids, limit):
    packed = packing.pack(edge.repartition(5), WORD_VOCABULARY, PACK_END_ID, length=limit)
    held(packed.withColumn("ids_crc32", F.crc32("ids")).collect(), EDGE, ids, limit)


def test_sequences_hold_the_pieces_in_order(edge, ids):
    packed = packing.pack(edge, WORD_VOCABULARY, PACK_END_ID, length=64).persist()
    expected = defaultdict(list)
    for r in sorted(packed.collect(), key=lambda r: r["offset"]):
        expected[r["sequence_id"]] += np.frombuffer(r["ids"], "<u4").tolist()
    got = {r["sequence_id"]: (r["n_ids"], np.frombuffer(r["ids"], "<u4").tolist()) for r in packing.sequences(packed).collect()}
    assert got == {k: (len(v), v) for k, v in expected.items()}
    packed.unpersist()


def test_no_rows(nothing):
    assert packing.pack(nothing, WORD_VOCABULARY, PACK_END_ID).collect() == []

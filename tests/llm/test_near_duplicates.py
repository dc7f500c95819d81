import random

import numpy as np
import pytest

from panelspark.llm import bbit_minhash
from panelspark.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import EDGE, SF


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_query_equals_brute_force(spark, documents):
    got = QUERIES["op7_near_duplicates"](spark, SF)
    assert found(got) == brute.near_duplicates(documents)
    assert got.filter("kept != (doc_id = component_id)").count() == 0


def test_odd_rows(spark, edge, nothing):
    got = [tuple(r) for r in bbit_minhash.near_duplicates(edge, words_each=4).collect()]
    assert len(got) == len(EDGE)
    told = {(k, n, c) for k, n, c, _ in got}
    assert {(1, 0, 1), (2, 0, 2), (3, 0, 3), (4, 1, 4), (5, 1, 4), (6, 57, 6), (None, 57, 6), (10, 1, 10), (11, 1, 11)} <= told
    assert [kept for k, _, _, kept in got if k == 4] == [True, True]
    assert bbit_minhash.near_duplicates(nothing).count() == 0
    left = bbit_minhash.deduplicate(edge)
    assert left.columns == edge.columns
    assert left.filter("doc_id = 4").count() == 1 and left.filter("doc_id = 5").count() == 0
    assert left.filter("doc_id = 7").count() == 2  # two texts of one id


@pytest.fixture(scope="module")
def group():
    """A chain and a crowd of near copies whose links the stars alone do not give, among strangers."""
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(4000)]
    first = rnd.sample(words, 120)
    rows, chain = [], list(first)
    for i in range(30):  # each close to the one before only
        rows.append((i, " ".join(chain)))
        at = (i * 7) % 110
        chain[at:at + 3] = rnd.sample(words, 3)
    for i in range(30, 90):
        text = list(first)
        for at in rnd.sample(range(120), rnd.randrange(0, 5)):
            text[at] = rnd.choice(words)
        rows.append((i, " ".join(text)))
    rows += [(i, " ".join(first[:40] + rnd.sample(words, 60))) for i in range(90, 130)]
    return rows


@pytest.mark.parametrize("small", [False, True])
def test_group_of_near_copies(spark, group, monkeypatch, small):
    if small:  # many blocks, and the texts joined by a shuffle
        monkeypatch.setattr(bbit_minhash, "BLOCK_CLASSES", 7)
        monkeypatch.setattr(bbit_minhash, "BROADCAST_IDS", 0)
    docs = spark.createDataFrame(group, "doc_id long, text string")
    assert found(bbit_minhash.near_duplicates(docs, words_each=4)) == brute.near_duplicates(group)


def test_estimate_follows_similarity():
    rnd = np.random.default_rng(3)
    pool = rnd.integers(0, 2**63, 3000, dtype=np.uint64)
    for shared in (400, 700, 900, 1000):
        a, b = np.unique(pool[:1000]), np.unique(pool[1000 - shared:2000 - shared])
        x = bbit_minhash.packed_bits(bbit_minhash.minima(a)) ^ bbit_minhash.packed_bits(bbit_minhash.minima(b))
        x = x.view(np.uint64)
        apart = int(np.bitwise_count((x | (x >> np.uint64(1))) & np.uint64(int("01" * 32, 2))).sum())
        share = (256 - apart) / 256
        assert abs((share - 0.25) / 0.75 - shared / (2000 - shared)) < 0.15


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(1, 200)] + [(500, 501)], "a long, b long")
    assert {r.node: r.label for r in bbit_minhash.components(edges).collect()} == {
        **{i: 1 for i in range(1, 201)}, 500: 500, 501: 500
    }


def test_similarities_that_the_bands_would_miss_are_refused(edge):
    for run in (bbit_minhash.near_duplicates, bbit_minhash.deduplicate):
        with pytest.raises(ValueError, match="80 percent"):
            run(edge, percent=79)

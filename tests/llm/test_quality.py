import numpy as np
import pytest
import zlib

from panelspark.llm import boosting, quality_model, quality_rules, statistics
from panelspark.llm.queries import QUERIES
from tests.llm import brute
from tests.llm.conftest import EDGE, SF


def sample(n=2000, seed=1):
    rnd = np.random.default_rng(seed)
    x = rnd.normal(size=(n, 4))
    y = (x[:, 0] + 0.5 * np.sin(3 * x[:, 1]) + 0.3 * rnd.normal(size=n) > 0).astype(float)
    return x, y


def test_trees_learn_and_flat_walk_equals_recursion():
    x, y = sample()
    trees = boosting.fit(x, y)
    score = trees.score(x)
    assert ((score > 0.5) == y).mean() > 0.9

    def walk(node, row):
        if trees.left[node] == node:
            return trees.value[node]
        side = trees.left if row[trees.feature[node]] <= trees.threshold[node] else trees.right
        return walk(side[node], row)

    for i in range(0, 2000, 200):
        total = trees.prior + sum(walk(r, x[i]) for r in trees.roots)
        assert score[i] == pytest.approx(1 / (1 + np.exp(-total)))


def test_monotone_features_only_rise_or_fall():
    x, y = sample(seed=2)
    trees = boosting.fit(x, y, {0: 1, 1: -1})
    grid = np.linspace(-3, 3, 200)
    for base in x[:20]:
        rows = np.repeat(base[None], 200, axis=0)
        for k, sign in ((0, 1), (1, -1)):
            moved = rows.copy()
            moved[:, k] = grid
            assert (sign * np.diff(trees.score(moved)) >= -1e-12).all()


def test_trees_without_labels_or_with_one_kind():
    assert boosting.fit(np.zeros((0, 1)), np.zeros(0)).score(np.zeros((2, 1))).tolist() == [0.5, 0.5]
    assert boosting.fit(np.zeros((3, 1)), np.ones(3)).score(np.zeros((1, 1)))[0] == pytest.approx(0.8)


def test_query_scores_held_out_rows(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = QUERIES["op6_quality"](spark, "/root/testdata/sf0.01").collect()
    assert len(got) == 1000 and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got)
    held = [(labels[r.doc_id], r.predicted) for r in got if r.held_out and r.doc_id in labels]
    assert len(held) > 40 and np.mean([a == b for a, b in held]) > 0.95


def test_fit_ignores_held_out_labels(spark):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    from pyspark.sql import functions as F

    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    turned = labels.withColumn("quality", F.when(held, 1 - F.col("quality")).otherwise(F.col("quality")))
    a, b = quality_model.fit(docs, labels), quality_model.fit(docs, turned)
    assert a.prior == b.prior and np.array_equal(a.value, b.value)


def test_odd_rows(spark, edge, nothing):
    labels = spark.createDataFrame([(9, 1, 0), (10, 0, 0), (None, 1, 0), (12, None, 0)], "doc_id long, quality int, toxic int")
    for trees in (quality_model.fit(edge, labels), quality_model.fit(nothing, labels.limit(0))):
        got = quality_model.score(edge, trees).collect()
        assert len(got) == len(EDGE) and all(0 < r.score < 1 for r in got)
        assert quality_model.keep(edge, trees).columns == edge.columns
        assert quality_model.keep(edge, trees).count() == sum(r.predicted for r in got)
    assert quality_model.score(nothing, trees).count() == 0
    judged = quality_rules.judge(edge, quality_rules.fit(edge, labels)).collect()
    assert sorted(repr((r.doc_id, *tuple(r)[1:6])) for r in judged) == sorted(
        repr((k, *brute.rule_counts(t or ""))) for k, t in EDGE
    )
    assert all(not r.kept for r in judged if r.base_failed)
    assert quality_rules.judge(nothing, boosting.Trees(0.0)).count() == 0


def test_rule_counts_query(spark, documents):
    got = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, SF).collect()}
    assert len(got) == len(documents)
    for doc, text in documents:
        n, chars, symbols, lines, repeated = want = brute.rule_counts(text)
        assert tuple(got[doc])[1:6] == want
        assert got[doc].base_failed == (n < 20 or 100 * repeated > 30 * n)


def test_verdicts_follow_held_out_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet("/root/testdata/sf0.01/labels.parquet").collect()}
    got = {r.doc_id: r for r in QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").collect()}
    assert len(got) == 1000 and not any(r.kept for r in got.values() if r.base_failed)
    held = [k for k in got if zlib.crc32(str(k).encode()) % 5 == 0 and k in labels]
    assert len(held) > 40 and np.mean([got[k].kept == (labels[k] == 1) for k in held]) > 0.9
    assert {got[k].kept for k in held if not got[k].base_failed} == {True, False}


def test_repeated_words_overlap():
    for text in ("a " * 9, "a b " * 9, "a b c d e f g h i " * 2, "x a b c d e f g h y a b c d e f g h z", "a b c d e f g"):
        assert statistics.repeated_words(text.encode().split(), 8) == brute.rule_counts(text)[4], text

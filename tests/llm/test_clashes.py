"""Whole-row operators give back the caller's columns as they were, whatever they are called."""

from pyspark.sql import functions as F

from panelspark.llm import bbit_minhash, decontaminate, labelled, secret_scan


def test_columns_named_like_helpers_are_kept(spark, edge):
    benchmark = spark.createDataFrame([("a", "word " * 13)], "item_id string, text string")
    for out in (
        decontaminate.clean(edge, benchmark), secret_scan.redact(edge), bbit_minhash.deduplicate(edge.filter("doc_id < 7")),
    ):
        assert out.columns == edge.columns and dict(out.dtypes) == dict(edge.dtypes)
        rows = out.select("_content", "_spans", "shard").distinct().collect()
        assert [tuple(r) for r in rows] == [("kept", 7, 1)]


def test_one_document_of_a_shared_key_is_learnt_from(spark):
    """The same one in every order of the rows."""
    rows = [(k, f"text {i}") for k in range(30) for i in range(4)]
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    features = lambda t: t.select("_key", "_label", F.array(F.crc32(F.col("text")).cast("double")).alias("_x"))
    found = [
        labelled.training_rows(features, spark.createDataFrame(part, "doc_id long, text string").repartition(n), labels, "doc_id", "quality", 100)
        for part, n in ((rows, 1), (rows[::-1], 5))
    ]
    assert len(found[0][0]) > 20
    assert (found[0][0] == found[1][0]).all() and (found[0][1] == found[1][1]).all()

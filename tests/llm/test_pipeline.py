import base64
from array import array

import public_tokenizers as vocabularies
import tiktoken

import corpus_pipeline
from panelspark.llm import quality_model
from panelspark.llm.queries import BYTE_RANKS
from panelspark.session import materialise
from tests.llm import brute
from tests.llm.conftest import SF


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    steps = []
    for _, stage in corpus_pipeline.STAGES:
        docs = materialise(stage(spark, docs, SF))
        steps.append(docs)
    good, single, clean, safe, ids = steps
    assert all(s.columns == columns for s in steps[:-1])

    first = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    scored = quality_model.score(first, quality_model.fit(first, labels))
    texts = {r.doc_id: r.text for r in good.collect()}
    assert set(texts) == {r.doc_id for r in scored.filter("predicted = 1").collect()} and texts

    near = brute.near_duplicates(list(texts.items()), words_each=5)
    kept = {r.doc_id: r.text for r in single.collect()}
    assert kept == {k: texts[k] for k, (_, component) in near.items() if k == component}

    items = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").select("item_id", "text").collect()]
    hits = brute.contamination(list(kept.items()), items)
    left = {r.doc_id: r.text for r in clean.collect()}
    assert left == {k: kept[k] for k, (n, hit, _) in hits.items() if not (hit and 20 * hit >= n)}

    told = {r.doc_id: (r.text, r.n_chars) for r in safe.collect()}
    assert set(told) == set(left)
    for k, text in left.items():
        if not brute.base_spans(text) and "[SECRET]" not in told[k][0]:
            assert told[k][0] == text
        for start, _, stop in brute.base_spans(text):
            assert text[start:stop] not in told[k][0]
        assert told[k][1] == len(told[k][0])

    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_RANKS, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = {r.doc_id: r for r in ids.collect()}
    for k, (text, _) in told.items():
        want = encoding.encode_ordinary(text)
        assert bytes(rows[k].ids) == array("I", want).tobytes() and rows[k].n_tokens == len(want)
        assert rows[k].decoded_sha256 == brute.sha(text)
    assert len(rows) == len(told)


def test_run_is_the_last_stage(spark):
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "n_tokens", "ids", "decoded_sha256"]
    assert [name for name, _ in corpus_pipeline.STAGES][0] == "quality classifier" and len(corpus_pipeline.STAGES) == 5

import time
import zlib

import pytest
from pyspark.sql import functions as F

from panelspark.llm import decontaminate, secret_scan, sharding
from panelspark.llm.queries import QUERIES
from tests.compare import database, difference
from tests.llm import brute
from tests.llm.conftest import EDGE, SF


@pytest.mark.parametrize("name", ["op2_secret_scan", "op3_sharding", "op4_warc", "op9_decontamination"])
def test_query_equals_its_sql(spark, name):
    assert difference(spark, database(SF), SF, name) is None


ITEMS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron"), (2, "pi RHO, sigma!"),
    (2, "tau"), (None, "漢字 é1"), (3, None), (4, " ... "), (5, "same same same"),
]
TEXTS = [
    (1, "x alpha BETA gamma-delta epsilon zeta eta theta iota kappa lambda mu nu xi y"), (2, "pi rho sigma pi rho sigma tau"),
    (3, "same same same same"), (4, "漢字 é1 tau"), (5, None), (6, ""), (7, "alpha beta gamma"), (8, "tau " * 5000),
]


@pytest.mark.parametrize("block", [1 << 20, 20])
def test_windows_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    docs = spark.createDataFrame([(*r, 1) for r in TEXTS * 2], "doc_id long, text string, items int")
    items = spark.createDataFrame([(*r, "z") for r in ITEMS], "item_id long, text string, `key` string")
    want = brute.contamination(TEXTS, ITEMS)
    got = decontaminate.find_contamination(docs, items).collect()
    assert len(got) == 2 * len(TEXTS) and all(tuple(r)[1:] == want[r.doc_id] for r in got)
    none = decontaminate.find_contamination(docs, items.limit(0)).collect()
    assert [r.n_hit for r in none] == [0] * len(got)
    assert decontaminate.find_contamination(docs.limit(0), items).count() == 0
    assert {r.doc_id for r in decontaminate.clean(docs, items).collect()} == {
        k for k, (n, hit, _) in want.items() if not (hit and 20 * hit >= n)
    }


@pytest.mark.parametrize("block", [1 << 20, 60])
def test_benchmark_blocks_are_bounded(spark, monkeypatch, block):
    monkeypatch.setattr(decontaminate, "BLOCK_BYTES", block)
    monkeypatch.setattr(decontaminate, "PIECE_WORDS", 4)
    sent = []

    class Context:
        def broadcast(self, value):
            sent.append(sum(len(str(i)) + len(t) for i, t in value))
            return spark.sparkContext.broadcast(value)

    class Session:
        sparkContext = Context()

    told = decontaminate._sent
    monkeypatch.setattr(decontaminate, "_sent", lambda _, pieces: told(Session, pieces), raising=False)
    rows = [*ITEMS, (9, "one two three four five six seven eight nine")]
    items = spark.createDataFrame(rows + 500 * [(2, "pi RHO, sigma!")], "item_id long, text string")
    docs = [*TEXTS, (9, "one two three four five. Six seven eight nine tau alpha"), (None, "eight nine"), (9, "six seven eight")]
    for window in (3, 13):
        got = decontaminate.find_contamination(spark.createDataFrame(docs, "doc_id long, text string"), items, window=window)
        want = [brute.contamination([d], rows, window)[d[0]] for d in docs]
        assert sorted(map(repr, (tuple(r) for r in got.collect()))) == sorted(repr((d[0], *w)) for d, w in zip(docs, want))
    assert sent and max(sent) <= max(block, 85) and (len(sent) > 4) == (block == 60)


def test_many_patterns_equal_brute_force(documents):
    items = [(i, " ".join(t.split()[5:40])) for i, t in documents[::20]]
    searches = decontaminate.build([(str(i), t.encode()) for i, t in items])
    want = brute.contamination(documents, items)
    for doc, text in documents:
        words = decontaminate.words_of(text.encode())
        names = sorted({n for s in searches for _, o in s.search(words) for n in o})
        assert (len(words), names) == (want[doc][0], want[doc][2])


SECRETS = [
    (1, "see TOKEN = abcdef and token: token : abcdefgh", "a", "en"), (2, "é🙂 AKIA" + "B2" * 9, "a", "en"),
    (3, "é🙂 AKIA" + "B2" * 9, "b", "en"), (4, "0123456789abcdef0123456789abcdef01", "a", "fr"),
    (5, "key Zx9" + "aB3" * 9 + " end", "a", "en"), (6, "key Zy9" + "aB3" * 9, "a", "en"), (7, "key Zy9" + "aB3" * 9, "b", "en"),
    (8, 'api_key="' + "Q1w" * 20 + '"', None, None), (9, None, "a", "en"), (10, "", "a", "en"), (11, "passwd=12345", "a", "en"),
    (12, "Passwd'  :  'x/y+z=" * 3, "a", "en"), (8, 'api_key="' + "Q1w" * 20 + '"', None, None),
]


def test_secrets_and_their_owners(spark):
    docs = spark.createDataFrame([(*r, 0) for r in SECRETS], "doc_id long, text string, source string, lang string, n_chars long")
    rows = secret_scan.scan(docs).collect()
    assert len(rows) == len(SECRETS)
    got = {r.doc_id: [tuple(s) for s in r.spans] for r in rows}
    for doc, text, _, _ in SECRETS:
        assert [s[:3] for s in got[doc] if s[1] < 3] == brute.base_spans(text or "")
    assert got[2][0][3] is False and got[4][0][3] is True  # two owners, one owner
    assert [s[1] for s in got[5]] == [3] and got[6] == got[7] == []  # an owned token, and one that two owners hold
    clean = {r.doc_id: r for r in secret_scan.redact(docs).collect()}
    assert clean[5].text == "key [SECRET] end" and clean[5].n_chars == 16 and clean[9].text is None and clean[9].n_chars == 0
    assert secret_scan.redact(docs).count() == len(SECRETS)
    assert secret_scan.scan(docs.limit(0)).count() == 0


def many_matches(n):
    """A text of n matches of each kind and own tokens, beside each other and apart, outside ASCII too."""
    each = ["token=aBc{0:08d}xyz é ", "AKIA{0:020d} 🙂", "{0:032x}\n", "kEy{0:030d}Z ", "secret: {0:032x}", " zZ9{0:024d} "]
    return "".join(t.format(i) for i in range(n) for t in each)


def test_many_matches_in_one_text(spark):
    texts = [(1, many_matches(400)), (2, many_matches(400)[:-3] + "é" * 3000), (3, "token=abcdef" * 3), (4, "AKIA" + "Z" * 5000)]
    docs = spark.createDataFrame([(k, t, f"s{k}", "en") for k, t in texts], "doc_id long, text string, source string, lang string")
    got = {r.doc_id: [tuple(s)[:3] for s in r.spans] for r in secret_scan.scan(docs).collect()}
    clean = {r.doc_id: r.text for r in secret_scan.redact(docs).collect()}
    for doc, text in texts:
        base = brute.base_spans(text)
        assert [s for s in got[doc] if s[1] < 3] == base
        own = [s for s in got[doc] if s[1] == 3]
        assert all(b[2] <= s[0] or s[2] <= b[0] for s in own for b in base)
        marked = bytearray(len(text))
        for start, _, stop in got[doc]:
            marked[start:stop] = b"\1" * (stop - start)
        want, i = [], 0
        while i < len(text):
            if marked[i]:
                want.append("[SECRET]")
                while i < len(text) and marked[i]:
                    i += 1
            else:
                want.append(text[i])
                i += 1
        assert clean[doc] == "".join(want)


def test_time_follows_the_number_of_matches(spark):
    def seconds(n):
        docs = spark.createDataFrame([(1, many_matches(n), "a", "en")], "doc_id long, text string, source string, lang string")
        started = time.perf_counter()
        assert secret_scan.redact(docs).count() == 1 and len(secret_scan.scan(docs).first().spans) >= 5 * n
        return time.perf_counter() - started

    seconds(10)
    few, many = seconds(1000), seconds(8000)  # 6,000 and 48,000 matches
    assert many < 8 * few + 10


def test_secrets_of_odd_rows(spark, edge):
    got = secret_scan.scan(edge).select("doc_id", *secret_scan.digest_columns(F.col("spans"))).collect()
    assert len(got) == len(EDGE)
    by = {r.doc_id: r for r in got}
    assert (by[12].n_assign, by[12].n_access, by[1].base_sha256) == (1, 1, brute.sha(""))


def test_shards_of_odd_rows(spark, edge, nothing):
    got = sharding.assign(edge, [1.0, 2.0, 0.5], [1.0, 2.0, 0.5, 1.0]).collect()
    assert sorted(repr((r.doc_id, r.size, r.text_crc32)) for r in got) == sorted(
        repr((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()))) for k, t in EDGE
    )
    for shard in range(3):
        slots = sorted((r.slot for r in got if r.shard == shard))
        assert slots == list(range(len(slots)))
    assert all(r.grown_shard in (r.shard, 3) for r in got)
    assert sharding.assign(nothing, [1.0], [1.0, 1.0]).count() == 0


def test_shards_follow_weights_and_move_few(spark):
    keys = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"))
    got = sharding.assign(keys, [1.0, 1.0, 2.0], [1.0, 1.0, 2.0, 1.0]).groupBy("shard", "grown_shard").count().collect()
    share = {s: sum(r["count"] for r in got if r.shard == s) / 20_000 for s in range(3)}
    assert share[0] == pytest.approx(0.25, abs=0.02) and share[2] == pytest.approx(0.5, abs=0.02)
    moved = sum(r["count"] for r in got if r.shard != r.grown_shard)
    assert moved == sum(r["count"] for r in got if r.grown_shard == 3) and moved / 20_000 == pytest.approx(0.2, abs=0.02)

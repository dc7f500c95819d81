import random
from collections import Counter

import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from panelspark.llm import alignment
from panelspark.llm.common import byte_alphabet
from panelspark.llm.queries import BYTE_VOCABULARY, PIECE_MODEL, QUERIES
from tests.llm.brute import sha
from tests.llm.conftest import EDGE, SF

ODD = "  \n\t\r\x1c\x85\xa0　aAbZ.,!'sTll12漢éÉ́İΣ🙂|$▁\x00​<|endoftext|>x"


@pytest.fixture(scope="module")
def whole():
    """A whole text's tokens of both libraries, as (id, bytes); none where the bytes differ from space and text."""
    a = Tokenizer.from_file(BYTE_VOCABULARY)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    alphabet = {c: i for i, c in byte_alphabet().items()}

    def b_bytes(i):
        piece = b.id_to_piece(i)
        return bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()

    def tokens(text):
        if not text:
            return [], []
        left = [(i, bytes(alphabet[c] for c in a.id_to_token(i))) for i in a.encode(" " + text, add_special_tokens=False).ids]
        right = [(i, b_bytes(i)) for i in b.encode(text)]
        want = (" " + text).encode()
        same = all(b"".join(t for _, t in side) == want for side in (left, right))
        return (left, right) if same else ([], [])

    return tokens


def spans(tokens):
    at, out = 0, []
    for i, t in tokens:
        out.append((i, at, at + len(t)))
        at += len(t)
    return out


def brute(tokens):
    """(n_a, n_b, groups, links): bytes name the tokens that hold them, ends that both sides have close a group."""
    a, b = map(spans, tokens)
    common = {e for *_, e in a} & {e for *_, e in b}
    groups = []
    for side in (a, b):
        parts, part = [], []
        for i, _, e in side:
            part.append(str(i))
            if e in common:
                parts.append(",".join(part))
                part = []
        groups.append(parts)
    holder = [[n for n, (_, s, e) in enumerate(side) for _ in range(s, e)] for side in (a, b)]
    links = [(a[i][0], b[j][0]) for i, j in set(zip(*holder))]
    return len(a), len(b), list(map("|".join, zip(*groups, strict=True))), links


def corpus(documents, tokens):
    """The rows of the contract for (id, text) rows."""
    found = [(k, *brute(tokens(t))) for k, t in documents]
    count = Counter(pair for *_, links in found for pair in set(links))
    highest = {}
    for (i, _), n in count.items():
        highest[i] = max(n, highest.get(i, 0))
    return Counter(
        (k, n_a, n_b, len(groups), len(links), sum(count[p] == highest[p[0]] for p in links),
         sum(count[p] for p in links), sha(";".join(groups)) if n_a else "")
        for k, n_a, n_b, groups, links in found
    )


NAMES = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def test_query_on_the_whole_table(spark, documents, whole):
    rows = QUERIES["op12_alignment"](spark, SF).collect()
    assert Counter(tuple(r[n] for n in NAMES) for r in rows) == corpus(documents, whole)


def test_stretches_align_like_whole_texts(whole):
    rnd = random.Random(3)
    aligner = alignment.Aligner(BYTE_VOCABULARY, PIECE_MODEL)
    odd = ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(16))) for _ in range(4000)]
    for text in [*odd, "<s> a </s>", "<0x0A>", "x" * 3000, "漢字" * 2000, "a" * 50 + " b" * 2000]:
        n_a, n_b, groups, links = brute(whole(text))
        got = aligner.document(text.encode())
        pairs = [(int.from_bytes(got[4][i + 4:i + 8], "little"), int.from_bytes(got[4][i:i + 4], "little"))
                 for i in range(0, len(got[4]), 8)]
        assert got[:4] == (n_a, n_b, len(groups), ";".join(groups)), text
        assert sorted(pairs) == sorted(links), text


@pytest.mark.parametrize("a_ends, b_ends, groups, links", [
    ([3], [1, 3], [(1, 2)], [(0, 0), (0, 1)]),
    ([2, 4, 6], [3, 6], [(3, 2)], [(0, 0), (1, 0), (1, 1), (2, 1)]),
    ([1, 2], [1, 2], [(1, 1), (2, 2)], [(0, 0), (1, 1)]),
])
def test_groups_and_overlaps(a_ends, b_ends, groups, links):
    assert alignment.token_groups(a_ends, b_ends) == groups
    found, i0, j0 = [], 0, 0
    for i1, j1 in groups:
        found += alignment.overlaps(a_ends, b_ends, (i0, i1, j0, j1))
        i0, j0 = i1, j1
    assert found == links


def test_memo_is_bounded_by_bytes(monkeypatch):
    monkeypatch.setattr(alignment, "MEMO_BYTES", 20_000)
    aligner = alignment.Aligner(BYTE_VOCABULARY, PIECE_MODEL)
    for i in range(500):
        aligner.document(f"word{i} {'long' * 100}{i}".encode())
        assert len(aligner) + len(aligner.older) <= 20_000 // aligner.ENTRY_BYTES + 2
    assert max(map(len, aligner)) <= aligner.LONGEST


@pytest.mark.parametrize("links", [alignment.CHUNK_LINKS, 300, 1])
def test_odd_rows(edge, whole, monkeypatch, links):
    rows = EDGE + [(20, "a▁b"), (21, "\x00"), (22, " lead"), (23, "trail "), (24, "ab\ncd  ef")]
    more = edge.sparkSession.createDataFrame(rows[len(EDGE):], "doc_id long, text string")
    docs = edge.withColumn("chunk", F.lit(1)).unionByName(more, allowMissingColumns=True).repartition(3)
    monkeypatch.setattr(alignment, "CHUNK_LINKS", links)
    aligned = alignment.align(docs, BYTE_VOCABULARY, PIECE_MODEL)
    digest = F.when(F.col("n_groups") > 0, F.sha2("groups", 256)).otherwise("")
    got = alignment.count_links(aligned.withColumn("groups_sha256", digest)).collect()
    assert Counter(tuple(r[n] for n in NAMES) for r in got) == corpus(rows, whole)
    assert all((r["groups"] == "") == (r["n_a"] == 0) for r in got)


def test_no_rows(nothing):
    assert alignment.count_links(alignment.align(nothing, BYTE_VOCABULARY, PIECE_MODEL)).collect() == []


def test_words_and_the_punctuation_behind_them_are_remembered_apart():
    rnd, marks = random.Random(3), "!\"#$%&()*+,-./:;<=>?@[\\]^_`{|}~"
    apart, whole = (alignment.Aligner(BYTE_VOCABULARY, PIECE_MODEL) for _ in range(2))
    assert apart.apart and apart.direct
    whole.apart = whole.direct = False
    for _ in range(5000):
        word = "".join(rnd.choice("abcdefghijklmnopqrstuvwxyzABCXYZÀÖØößÿéñ") for _ in range(rnd.randint(1, 12)))
        stretch = (" " + word + "".join(rnd.choice(marks) for _ in range(rnd.randint(1, 5)))).encode()
        assert apart[stretch] == whole[stretch]
    assert b" " + word.encode() in apart and b" " + word.encode() not in whole

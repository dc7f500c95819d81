import base64
import random
import unicodedata
import zlib
from array import array

import numpy as np
import public_tokenizers as vocabularies
import pyarrow as pa
import pytest
import tiktoken
from tokenizers import Tokenizer

from panelspark.llm import arrow_tokens, bpe
from panelspark.llm.common import Memo
from panelspark.llm.queries import BYTE_RANKS, END_ID, QUERIES, WORD_VOCABULARY
from tests.llm.brute import sha
from tests.llm.conftest import EDGE, SF

ODD = " \n\t\r\x1c\x85\xa0  aAZ.,!'sTll12漢éÉ́İΣ🙂|$<|endoftext|>x"


@pytest.fixture(scope="module")
def reference():
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, open(BYTE_RANKS, "rb"))}
    encoding = tiktoken.Encoding("own", pat_str=vocabularies.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: encoding.encode_ordinary(text)


@pytest.fixture(scope="module")
def words():
    tokenizer = Tokenizer.from_file(WORD_VOCABULARY)
    tokenizer.encode_special_tokens = True
    return lambda text: tokenizer.encode(text, add_special_tokens=False).ids


def odd_texts(n):
    rnd = random.Random(7)
    return ["".join(rnd.choice(ODD) for _ in range(rnd.randrange(14))) for _ in range(n)]


def test_perfect_hash_is_minimal():
    keys = [str(i).encode() for i in range(5000)]
    perfect = bpe.PerfectHash(keys)
    assert sorted(map(perfect.slot, keys)) == list(range(5000))
    again = bpe.PerfectHash(keys, (perfect.seed, perfect.displace))
    assert [again.slot(k) for k in keys] == [perfect.slot(k) for k in keys]


def test_bpe_equals_the_library(reference):
    encoder = bpe._encoder(BYTE_RANKS, vocabularies.PATTERN)
    for text in [*odd_texts(5000), "a" * 20_000]:
        ids = encoder.encode(text.encode())
        assert ids == array("I", reference(text)).tobytes(), text
        assert encoder.decode(ids) == text.encode()


def test_bpe_memo_is_bounded(reference, monkeypatch):
    monkeypatch.setattr(bpe, "MEMO_BYTES", 5 * bpe.Encoder.ENTRY_BYTES)
    encoder = bpe.Encoder({bytes([i]): i for i in range(256)} | {b"ab": 256}, vocabularies.PATTERN)
    for i in range(100):
        assert encoder.decode(encoder.encode(f"ab {i} ab".encode())) == f"ab {i} ab".encode()
        assert len(encoder) + len(encoder.older) <= 6


def test_memos_hold_texts_without_spaces_in_bounded_bytes():
    """A stretch may be a whole text: what is remembered is bounded by bytes, and long stretches are not remembered."""
    encoder = bpe._encoder(BYTE_RANKS, vocabularies.PATTERN)
    words = arrow_tokens._memo(WORD_VOCABULARY)
    rnd = random.Random(2)
    for memo in (encoder, words):
        memo.clear()
        for _ in range(60):
            memo.encode("".join(map(chr, rnd.choices(range(0x4E00, 0x9FA5), k=400))).encode())
        assert not memo and not memo.older and not memo.held


def test_memo_keeps_what_is_asked_for_again():
    class Doubled(Memo):
        made = 0

        def make(self, key):
            self.made += 1
            return key + key

    memo = Doubled(40 * Doubled.ENTRY_BYTES)
    for i in range(1000):
        assert memo[b"often"] == b"oftenoften" and memo[b"%d" % i] == b"%d" % i * 2
        assert len(memo) + len(memo.older) <= 41
    assert memo.made == 1001


def test_settled_words_go_to_the_model(words):
    memo = arrow_tokens._memo(WORD_VOCABULARY)
    assert memo.direct
    rnd = random.Random(4)
    letters = [c for c in map(chr, range(0x61, 0x180)) if c.isalpha()]
    for _ in range(3000):
        word = "".join(rnd.choices(letters, k=rnd.randrange(1, 12))) + rnd.choice(["", ",", "!?", "'s"])
        assert np.frombuffer(memo.encode(word.encode()), memo.dtype).tolist() == words(word), word


def test_bpe_of_odd_rows(spark, edge, nothing, reference):
    encoded = bpe.encode(edge, BYTE_RANKS, vocabularies.PATTERN)
    got = bpe.decode(encoded, BYTE_RANKS, vocabularies.PATTERN).collect()
    want = [(k, array("I", reference(t or "")).tobytes(), (t or "").encode()) for k, t in EDGE]
    assert sorted(map(repr, (tuple(map(lambda v: bytes(v) if isinstance(v, bytearray) else v, r)) for r in got))) == sorted(
        map(repr, want)
    )
    assert bpe.encode(nothing, BYTE_RANKS, vocabularies.PATTERN).count() == 0


def test_bpe_query(spark, documents, reference):
    got = {r.doc_id: tuple(r)[1:] for r in QUERIES["op10_byte_bpe"](spark, SF).collect()}
    import hashlib

    for doc, text in documents:
        ids = array("I", reference(text)).tobytes()
        assert got[doc] == (len(ids) // 4, hashlib.sha256(ids).hexdigest(), sha(text))
    assert len(got) == len(documents)


def test_word_memo_equals_the_library(words):
    memo = arrow_tokens._memo(WORD_VOCABULARY)
    for text in odd_texts(5000):
        assert np.frombuffer(memo.encode(text.encode()), "<u2").tolist() == words(text), text


def test_words_with_combining_marks_equal_the_library(words):
    memo = arrow_tokens._memo(WORD_VOCABULARY)
    letters = [c for c in map(chr, range(0x110000)) if c.isalpha() and not unicodedata.normalize("NFC", c).isalpha()]
    assert len(letters) == 59
    texts = [f"ab{c}{chr(t)}" for c in [*letters, "\u0130", "K"] for t in arrow_tokens._TAIL]
    texts += [f"x{a}{m}, y" for a in map(chr, range(65, 91)) for m in map(chr, range(0x300, 0x370))]
    texts += ["J\u0323\u030c It Q", "\u09b9\u09df, \u09b9\u09df."]
    for text in texts:
        assert np.frombuffer(memo.encode(text.encode()), "<u2").tolist() == words(text), ascii(text)


def test_added_tokens_equal_the_unmodified_library():
    tokenizer, memo = Tokenizer.from_file(WORD_VOCABULARY), arrow_tokens._memo(WORD_VOCABULARY)
    rnd = random.Random(8)
    pieces = ["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|", "|>", "endoftext", " ", "\n", "A b", "'s", "x,", "\u0301", "\u09df"]
    texts = ["a <|endoftext|> b", *("".join(rnd.choices(pieces, k=rnd.randrange(1, 9))) for _ in range(3000))]
    for text in texts:
        got = np.frombuffer(memo.encode(text.encode()), "<u2").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, ascii(text)
    assert np.frombuffer(memo.encode(texts[0].encode()), "<u2").tolist() == [320, 49407, 321]


def places(rows, words):
    out, start = [], 0
    for key, text in rows:
        ids = np.array([*words(text or ""), END_ID], "<u4")
        out.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_sequence_files_of_odd_rows(spark, edge, nothing, words, monkeypatch, tmp_path):
    monkeypatch.setattr(arrow_tokens, "BATCH_SEQUENCES", 4)
    manifest = arrow_tokens.write_sequences(edge, WORD_VOCABULARY, END_ID, length=16, folder=str(tmp_path))
    got = arrow_tokens.read_documents(spark, manifest, "bigint").orderBy("start").collect()
    assert [r.doc_id for r in got] == sorted((k for k, _ in EDGE if k), key=int) + [None]
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:])) and got[0].start == 0
    crc = {(k, zlib.crc32(np.array([*words(t or ""), END_ID], "<u4").tobytes())) for k, t in EDGE}
    assert {(r.doc_id, r.ids_crc32) for r in got} == crc
    none = arrow_tokens.write_sequences(nothing, WORD_VOCABULARY, END_ID)
    assert none.count() == 0 and arrow_tokens.read_documents(spark, none, "bigint").count() == 0


def test_sequences_are_equal_long_views(words, tmp_path):
    writer = arrow_tokens.SequenceWriter(str(tmp_path), "x", "<u2", pa.int64(), 8)
    ids = np.arange(3000, dtype="<u2")
    writer.add(1, ids[:1001].tobytes())
    writer.add(2, ids[1001:].tobytes())
    writer.close()
    reader = arrow_tokens.SequenceReader(writer.paths[0])
    seen, mask = reader.sequence(5)
    assert seen.tolist() == list(range(40, 48)) and mask.to_pylist() == [True] * 8 and not seen.flags.owndata
    assert reader.ids(1001, 1999).tolist() == list(range(1001, 3000))
    assert reader.sequence(374)[1].to_pylist() == [True] * 8
    assert reader.file.schema.field("input_ids").type == pa.list_(pa.uint16(), 8)


def test_sequence_query(spark, documents, words):
    got = QUERIES["op1_token_files"](spark, SF).orderBy("doc_id").collect()
    assert [tuple(r) for r in got] == places(documents, words)

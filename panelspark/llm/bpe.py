"""Byte-level BPE encoding and decoding with two tiers of look-up.

A minimal perfect hash (hash, displace and compress) answers whole pre-tokens that are vocabulary entries; the others
are merged by a heap of pairs over a linked list of bytes. Both tiers stay behind a bounded memo of the text between two
single spaces, since words repeat.

Defined results: a null or empty text has no ids and decodes to nothing; repeated rows and ids give equal rows; texts of
any length are encoded whole; an empty table gives an empty one; columns other than the two named are not read.
"""

from __future__ import annotations

import base64
import heapq
from array import array

import regex
import xxhash
from pyspark.sql import DataFrame

from panelspark.llm.common import Memo, map_documents, sole_memo

#: Bytes that one Python worker's memo may take.
MEMO_BYTES = 128 << 20
#: Keys of a bucket of the perfect hash, on average.
BUCKET_KEYS = 3
_MASK = (1 << 64) - 1


class PerfectHash:
    """Minimal perfect hash of n distinct byte strings onto 0..n-1: one displacement for each bucket of keys."""

    def __init__(self, keys: list[bytes], built: tuple[int, list[int]] | None = None):
        self.n = n = max(1, len(keys))
        self.buckets = max(1, n // BUCKET_KEYS)
        if built is not None:
            self.seed, self.displace = built
            return
        self.seed = next(s for s in range(64) if len({xxhash.xxh3_64_intdigest(k, s) for k in keys}) == len(keys))
        members: list[list[int]] = [[] for _ in range(self.buckets)]
        for k in keys:
            h = xxhash.xxh3_64_intdigest(k, self.seed)
            members[h % self.buckets].append(h)
        self.displace = [0] * self.buckets
        taken = bytearray(n)
        order = sorted(range(self.buckets), key=lambda b: -len(members[b]))
        several = [b for b in order if len(members[b]) > 1]
        for b in several:
            d = 0
            while True:
                slots = [self._place(h, d) for h in members[b]]
                if len(set(slots)) == len(slots) and not any(taken[s] for s in slots):
                    break
                d += 1
            self.displace[b] = d
            for s in slots:
                taken[s] = 1
        free = iter([s for s in range(n) if not taken[s]])
        for b in order[len(several):]:
            if members[b]:
                self.displace[b] = -1 - next(free)  # a key that is alone names its slot

    def _place(self, h: int, d: int) -> int:
        x = (h ^ (d * 0x9E3779B97F4A7C15)) * 0xBF58476D1CE4E5B9 & _MASK
        return ((x ^ (x >> 31)) * 0x94D049BB133111EB & _MASK) % self.n

    def slot(self, key: bytes) -> int:
        """The slot of a key; any slot for what is no key."""
        h = xxhash.xxh3_64_intdigest(key, self.seed)
        d = self.displace[h % self.buckets]
        return -1 - d if d < 0 else self._place(h, d)


def merge_bytes(piece: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of one pre-token: the pair of lowest rank merges first, the leftmost of equals; pairs wait in a heap."""
    n = len(piece)
    end = list(range(1, n + 1))  # of the part that starts at i
    before = list(range(-1, n - 1))
    heap = []
    for i in range(n - 1):
        rank = ranks.get(piece[i:i + 2])
        if rank is not None:
            heap.append((rank, i, i + 2))
    heapq.heapify(heap)
    alive = bytearray(b"\x01") * n
    while heap:
        _, i, stop = heapq.heappop(heap)
        mid = end[i]
        if not alive[i] or mid >= n or end[mid] != stop:
            continue  # one of the two has merged since
        end[i] = stop
        alive[mid] = 0
        if stop < n:
            before[stop] = i
            rank = ranks.get(piece[i:end[stop]])
            if rank is not None:
                heapq.heappush(heap, (rank, i, end[stop]))
        if i:
            left = before[i]
            rank = ranks.get(piece[left:stop])
            if rank is not None:
                heapq.heappush(heap, (rank, left, stop))
    out, i = [], 0
    while i < n:
        out.append(ranks[piece[i:end[i]]])
        i = end[i]
    return out


class Encoder(Memo):
    """Memo from a stretch of text (UTF-8) to its ids as little-endian unsigned 32-bit integers."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, built: tuple[int, list[int]] | None = None):
        super().__init__(MEMO_BYTES)
        self.ranks = ranks
        self.split = regex.compile(pattern).findall
        keys = sorted(ranks, key=ranks.get)
        self.vocabulary = {ranks[k]: k for k in keys}
        self.perfect = PerfectHash(keys, built)
        self.whole: list[tuple[bytes, int] | None] = [None] * self.perfect.n
        for k in keys:
            self.whole[self.perfect.slot(k)] = (k, ranks[k])

    def piece_ids(self, piece: bytes) -> list[int]:
        found = self.whole[self.perfect.slot(piece)]
        return [found[1]] if found is not None and found[0] == piece else merge_bytes(piece, self.ranks)

    def make(self, stretch: bytes) -> bytes:
        ids: list[int] = []
        for token in self.split(stretch.decode()):
            ids += self.piece_ids(token.encode())
        return array("I", ids).tobytes()

    def encode(self, text: bytes) -> bytes:
        return b"".join(map(self.__getitem__, stretches(text)))

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.vocabulary.__getitem__, memoryview(ids).cast("I")))


#: Byte strings of UTF-8 in which white space may stand beside a space.
_BESIDE = (
    b"  ", b"\n ", b" \n", b"\t", b"\r", b"\x0b", b"\x0c", b"\x1c", b"\x1d", b"\x1e", b"\x1f",
    b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80", b"\xe2\x81\x9f", b"\xe3\x80\x80",
)


def stretches(text: bytes) -> list[bytes]:
    """Cuts before single spaces that have no white space on either side: there every match of the pattern ends."""
    parts = text.split(b" ")
    if len(parts) == 1:
        return parts
    if parts[0] and parts[-1] and not any(b in text for b in _BESIDE):
        return [parts[0], *[b" " + p for p in parts[1:]]]
    out, before = [parts[0]], parts[0].decode()
    for part in parts[1:]:
        now = part.decode()
        if before and now and not before[-1].isspace() and not now[0].isspace():
            out.append(b" " + part)
        else:
            out[-1] += b" " + part
        before = now
    return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def _encoder(path: str, pattern: str, built: tuple[int, list[int]] | None = None) -> Encoder:
    """This process's encoder for a rank file; ``built`` spares it the search for the perfect hash."""
    if (path, pattern) not in _ENCODERS:
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        _ENCODERS[path, pattern] = Encoder(ranks, pattern, built)
    return _ENCODERS[path, pattern]


def encode(
    docs: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id", text: str = "text", decoded: bool = False
) -> DataFrame:
    """(key, ids): the ids of each whole text as little-endian unsigned 32-bit integers, one row for each row.

    With ``decoded`` the same pass also decodes the ids, as :func:`decode` does, into a column of bytes.
    ``ranks_path`` is a rank file that every worker can read. What is broadcast, the perfect hash's displacements, has
    a number for every third entry of that vocabulary.
    """
    perfect = _encoder(ranks_path, pattern).perfect
    built = docs.sparkSession.sparkContext.broadcast((perfect.seed, perfect.displace))

    def make(keys, texts):
        encoder = _encoder(ranks_path, pattern, built.value)
        sole_memo(encoder)
        for k, t in zip(keys, texts):
            ids = encoder.encode(t)
            if decoded:
                yield len(ids) + len(t), (k, ids, encoder.decode(ids))
            else:
                yield len(ids), (k, ids)

    fields = f"`{key}` {{{key}}}, ids binary" + ", decoded binary" * decoded
    return map_documents(docs, [key], [text], make, fields)


def decode(encoded: DataFrame, ranks_path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """(key, ids, decoded): the bytes that the ids stand for."""
    perfect = _encoder(ranks_path, pattern).perfect
    built = encoded.sparkSession.sparkContext.broadcast((perfect.seed, perfect.displace))

    def make(keys, ids):
        encoder = _encoder(ranks_path, pattern, built.value)
        for k, i in zip(keys, ids):
            text = encoder.decode(i)
            yield len(i) + len(text), (k, i, text)

    return map_documents(encoded, [key], ["ids"], make, f"`{key}` {{{key}}}, ids binary, decoded binary")

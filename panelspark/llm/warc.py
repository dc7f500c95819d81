"""WARC archives: written by tasks, read back with boundary-chain verification.

Reading does not trust the magic line that starts a record, since a payload may hold it too. Tasks scan stretches of the
files and emit every candidate with the offset at which its record would end. A candidate's pointer is first led through
its own stretch to the first offset beyond it; pointer jumping from the file starts, with pointers that double in every
round, then finds the offset at which the true chain enters each stretch. From those offsets alone records are read.

Every attempt of a writing task has file names of its own; the manifest, a table that Spark commits, names those that
count. Copies are decided by a table of the digests that several pages share, so no payload moves for that.

Defined results: a null payload is empty; of records with one payload the rows with the smallest key are responses,
repeated rows too; a null key counts as larger than any; line breaks and other control characters in an address are
percent-encoded; an empty table makes no archive; other columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from panelspark.llm.common import in_batches, map_in_arrow, new_folder, open_path
from panelspark.session import materialise

MAGIC = b"WARC/1.1\r\n"
#: Payloads of fewer bytes are stored again rather than referred to.
LEAST_REVISIT = 100
#: Bytes of a file that one task scans.
STRETCH = 16 << 20
#: Bytes read at first for a record's head.
HEAD = 8 << 10
#: Fixed values of the format.
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_HEAD = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"


def _clean(value: str) -> str:
    return "".join(f"%{ord(c):02X}" if ord(c) < 33 or ord(c) == 127 else c for c in value)


def record(key, url: str | None, payload: bytes, digest: str, refers_to=None, revisit: bool = False,
           date: str = "1970-01-01T00:00:00Z") -> bytes:
    """One record; a revisit names the response instead of holding the payload."""
    block = HTTP_HEAD + (b"" if revisit else payload)
    lines = [
        f"WARC-Type: {'revisit' if revisit else 'response'}", f"WARC-Record-ID: <urn:uuid:{uuid.uuid4()}>",
        f"WARC-Date: {date}", "Content-Type: application/http; msgtype=response",
        f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {len(payload)}", f"Content-Length: {len(block)}",
    ]
    if key is not None:
        lines.append(f"X-Page-Key: {_clean(str(key))}")
    if url:
        lines.append(f"WARC-Target-URI: {_clean(url)}")
    if revisit:
        lines += [f"WARC-Profile: {PROFILE}", f"X-Refers-To-Key: {_clean(str(refers_to))}"]
    return MAGIC + "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def write_archives(
    pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html", folder: str | None = None
) -> DataFrame:
    """Writes one archive for each task below ``folder``; returns the manifest (path, bytes, n_records)."""
    folder = folder or new_folder(pages.sparkSession, "warc")
    told = pages.select(
        F.col(key).alias("key"), F.col(url).cast("string").alias("url"),
        F.coalesce(F.col(payload).cast("binary"), F.lit(b"")).alias("payload"),
    ).withColumn("digest", F.sha2("payload", 256))
    shared = materialise(told.filter(F.octet_length("payload") >= LEAST_REVISIT).groupBy("digest").agg(
        F.min("key").alias("first"), F.count("*").alias("n")
    ).filter("n > 1").select("digest", "first"))
    judged = told.join(shared, "digest", "left").select(
        "key", "url", "payload", "digest", "first",
        (F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))).alias("revisit"),
    )
    ddl = "path string, bytes bigint, n_records bigint"
    out = to_arrow_schema(StructType.fromDDL(ddl))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path = f"{folder}/{uuid.uuid4().hex}.warc"
        files, inner = open_path(path)
        sink, n = None, 0
        for b in batches:
            if sink is None and b.num_rows:
                files.create_dir(open_path(folder)[1], recursive=True)
                sink = files.open_output_stream(inner)
            # row by row: the payloads of a batch are not all copied at once
            small = [b.column(i).to_pylist() for i in (0, 1, 3, 4, 5)]
            for body, k, u, digest, first, revisit in zip(b.column(2), *small):
                sink.write(record(k, u, body.as_py(), digest, first, revisit))
            n += b.num_rows
        if sink is not None:
            size = sink.tell()
            sink.close()
            yield from in_batches([(0, (path, size, n))], out)

    return materialise(map_in_arrow(judged, write, ddl))


class _File:
    """A file of which parts are read at offsets."""

    def __init__(self, path: str):
        files, inner = open_path(path)
        self.source = files.open_input_file(inner)
        self.size = self.source.size()

    def at(self, offset: int, n: int) -> bytes:
        return self.source.read_at(min(n, self.size - offset), offset) if 0 <= offset < self.size else b""

    def close(self) -> None:
        self.source.close()

    def head(self, offset: int) -> tuple[dict[bytes, bytes], int, int] | None:
        """(fields, offset of the block, offset after the record) of what may be a record; None if it cannot be one."""
        n = HEAD
        while True:
            text = self.at(offset, n)
            end = text.find(b"\r\n\r\n")
            if end >= 0:
                break
            if len(text) < n:
                return None
            n *= 4
        if not text.startswith(MAGIC):
            return None
        fields = {}
        for line in text[len(MAGIC):end].split(b"\r\n"):
            name, colon, value = line.partition(b":")
            if not colon:
                return None
            fields[name.strip().lower()] = value.strip()
        length = fields.get(b"content-length", b"")
        if not length.isdigit():
            return None
        block = offset + end + 4
        stop = block + int(length) + 4
        if stop > self.size or self.at(stop - 4, 4) != b"\r\n\r\n":
            return None
        return fields, block, stop


def _candidates(file: _File, start: int, stop: int) -> list[tuple[int, int]]:
    """(offset, offset after the record) of the magic lines that start in a stretch, ascending."""
    text = file.at(start, stop - start + len(MAGIC) - 1)
    found, at = [], text.find(MAGIC)
    while at >= 0:
        head = file.head(start + at)
        if head is not None:
            found.append((start + at, head[2]))
        at = text.find(MAGIC, at + 1)
    return found


def _led_out(found: list[tuple[int, int]], stop: int) -> dict[int, int]:
    """For each candidate, the first offset on its chain that lies beyond the stretch, or that is no candidate."""
    out: dict[int, int] = {}
    for offset, after in reversed(found):
        out[offset] = out.get(after, after)
    return out


def _entries(stretches: DataFrame) -> DataFrame:
    """(path, offset): where the chains from the file starts enter the stretches."""
    ddl = "path string, offset bigint, leap bigint"
    out = to_arrow_schema(StructType.fromDDL(ddl))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for path, start, stop in zip(*(c.to_pylist() for c in b.columns)):
                    file = _File(path)
                    for offset, leap in _led_out(_candidates(file, start, stop), stop).items():
                        yield 64, (path, offset, leap)
                    file.close()

        yield from in_batches(rows(), out)

    links = materialise(stretches.mapInArrow(scan, ddl))
    # only candidates that some pointer names, and file starts, can be entries
    named = links.select("path", F.col("leap").alias("offset")).distinct()
    jumps = materialise(links.join(named, ["path", "offset"], "left_semi").union(links.filter("offset = 0")).distinct())
    reached = jumps.filter("offset = 0").select("path", "offset")
    known = -1
    while True:
        onward = reached.join(jumps, ["path", "offset"]).select("path", F.col("leap").alias("offset"))
        reached = materialise(reached.union(onward).distinct().join(jumps.select("path", "offset"), ["path", "offset"]))
        n = reached.count()
        if n == known:
            return reached
        known = n
        far = jumps.select("path", F.col("offset").alias("leap"), F.col("leap").alias("further"))
        jumps = materialise(jumps.join(far, ["path", "leap"], "left").select(
            "path", "offset", F.coalesce("further", "leap").alias("leap")
        ))


def read_archives(spark: SparkSession, manifest: DataFrame, key_type: str, key: str = "page_id") -> DataFrame:
    """(key, payload_bytes, payload_digest, record_type, refers_to, url) of every record on a file's chain."""
    stretches = manifest.select("path", F.explode(F.sequence(
        F.lit(0).cast("bigint"), F.col("bytes") - 1, F.lit(STRETCH).cast("bigint")
    )).alias("start"), "bytes").select(
        "path", "start", F.least(F.col("start") + STRETCH, F.col("bytes")).alias("stop")
    )
    stretches = materialise(stretches)
    n = max(1, stretches.count())
    stretches = stretches.repartition(n)
    entries = _entries(stretches).withColumn("start", F.col("offset") - F.col("offset") % STRETCH)
    # a retried stretch may have been led to more than one offset of the chain; the first leads to the others
    entries = entries.groupBy("path", "start").agg(F.min("offset").alias("entry"))
    walks = entries.select("path", "entry", (F.col("start") + STRETCH).alias("stop")).repartition(n)
    ddl = (
        "key string, payload_bytes bigint, payload_digest string, record_type string, refers_to string, url string"
    )
    out = to_arrow_schema(StructType.fromDDL(ddl))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for b in batches:
                for path, at, stop in zip(*(c.to_pylist() for c in b.columns)):
                    file = _File(path)
                    while at < stop and (head := file.head(at)) is not None:
                        fields, block, after = head
                        yield 200, _row(fields, file.at(block, after - 4 - block))
                        at = after
                    file.close()

        yield from in_batches(rows(), out)

    records = walks.mapInArrow(read, ddl)
    return records.select(
        F.col("key").cast(key_type).alias(key), "payload_bytes", "payload_digest", "record_type",
        F.col("refers_to").cast(key_type).alias("refers_to"), "url",
    )


def _row(fields: dict[bytes, bytes], block: bytes) -> tuple:
    text = {k: v.decode() for k, v in fields.items()}
    kind = text.get(b"warc-type")
    if kind == "response":
        payload = block.partition(b"\r\n\r\n")[2]
        size, digest = len(payload), hashlib.sha256(payload).hexdigest()
    else:
        size, digest = int(text[b"x-payload-length"]), text[b"warc-payload-digest"].removeprefix("sha256:")
    return text.get(b"x-page-key"), size, digest, kind, text.get(b"x-refers-to-key"), text.get(b"warc-target-uri")

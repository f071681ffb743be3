"""WARC archives as chunked record tables.

Writing: each task streams its records to gzip archives, one member per record, of about ``ROTATE`` bytes, and returns
one row per archive. That manifest, once written, names the archives that count; what a lost task left behind is
not in it. Equal payloads of ``REVISIT`` bytes or more are written once, at the smallest key; the others are revisits.

Reading: each task streams its archives and emits rows of (record, chunk number) with at most ``CHUNK`` bytes, the bytes and
the digest so far. No record is held whole.

Defined results: a null payload is an empty one. A null URL leaves its header out; control characters in a URL are
percent-encoded. Rows that share the smallest key of their payload are all responses. A record's identifier is its key and the task and number
that wrote it, so that (record_id, chunk_no) is unique among repeated and null keys too. Null keys are larger than
others; if all are null, all are responses. An empty table gives no archive and no rows.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexigrid.llm.common import shared_fs, ship
from lexigrid.plans.session import broadcast_checked, materialize, scratch_path

REVISIT, CHUNK, ROTATE = 100, 1 << 16, 1 << 26
READ = 1 << 18
LEVEL = 6
MANIFEST = "path string, records long, bytes long"
CHUNKS = (
    "record_id string, key long, record_type string, chunk_no int, data binary, bytes_so_far long, digest_so_far string, "
    "last boolean, declared_bytes long, declared_digest string, refers_to long"
)
_END = b"\r\n\r\n"


def typed(pages: DataFrame, key: str = "page_id", payload: str = "html", url: str = "url") -> DataFrame:
    """``(key, url, payload, bytes, digest, refers_to)``: refers_to is null for responses."""
    text = F.coalesce(F.col(f"`{payload}`"), F.lit(""))
    df = pages.select(
        F.col(f"`{key}`").cast("long").alias("key"), F.col(f"`{url}`").alias("url"), text.alias("payload"),
        F.octet_length(text).cast("long").alias("bytes"), F.sha2(text, 256).alias("digest"),
    )
    firsts = df.filter(F.col("bytes") >= REVISIT).groupBy("digest").agg(F.min("key").alias("first"), F.count("*").alias("n"))
    firsts = broadcast_checked(firsts.filter("n > 1").select("digest", "first"), "payloads")
    later = F.col("first").isNotNull() & ~F.col("key").eqNullSafe(F.col("first"))
    return df.join(firsts, "digest", "left").select(
        "key", "url", "payload", "bytes", "digest", F.when(later, F.col("first")).alias("refers_to")
    )


def _header(key, part: str, url, size: int, digest: str, refers_to, date: str) -> bytes:
    """``part`` tells records of one key apart, and those without a key."""
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if key is None else key}:{part}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
        f"X-Payload-Length: {size}",
        f"Content-Length: {size if refers_to is None else 0}",
    ]
    if refers_to is None:
        lines.append("Content-Type: text/html; charset=utf-8")
    else:
        lines += [
            "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest",
            f"WARC-Refers-To: <urn:page:{refers_to}>",
        ]
    if url is not None:
        lines.append("WARC-Target-URI: " + "".join(c if c > "\x20" and c != "\x7f" else f"%{ord(c):02X}" for c in url))
    return "\r\n".join(lines).encode("utf-8", "replace") + _END


class _Archives:
    """The archives of one task; a new one is begun when the last is full."""

    def __init__(self, folder: str, name: str):
        self.fs, self.inner = shared_fs(folder)
        self.fs.create_dir(self.inner, recursive=True)
        self.folder, self.name, self.number, self.out = folder, name, 0, None
        self.done: list[tuple[str, int, int]] = []

    def write(self, header: bytes, payload: bytes) -> None:
        if self.out is None:
            self.file = f"{self.name}-{self.number:05d}.warc.gz"
            self.out, self.records, self.bytes = self.fs.open_output_stream(f"{self.inner}/{self.file}", compression=None), 0, 0
        press = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
        view = memoryview(payload)
        for part in (header, *(view[i : i + CHUNK] for i in range(0, len(view), CHUNK)), _END):
            self._put(press.compress(part))
        self._put(press.flush())
        self.records += 1
        if self.bytes >= ROTATE:
            self.close()

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.bytes += len(data)

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.done.append((f"{self.folder}/{self.file}", self.records, self.bytes))
            self.number, self.out = self.number + 1, None


def write(records: DataFrame, folder: str | None = None, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write typed records as archives; the manifest ``(path, records, bytes)``, itself a written table."""
    ship(records.sparkSession)
    folder = folder or scratch_path(records.sparkSession, "warc")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        me = TaskContext.get()
        mine, number = f"{me.partitionId():06d}-{me.taskAttemptId()}", 0
        archives = _Archives(folder, f"part-{mine}")
        for batch in batches:
            key, url, payload, size, digest, refers_to = batch.columns
            for i in range(batch.num_rows):
                to = refers_to[i].as_py()
                body = b"" if to is not None else payload[i].as_py().encode("utf-8", "replace")
                archives.write(_header(key[i].as_py(), f"{mine}-{number}", url[i].as_py(), size[i].as_py(), digest[i].as_py(), to, date), body)
                number += 1
        archives.close()
        if archives.done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*archives.done)], ["path", "records", "bytes"])

    records = records.select("key", "url", "payload", "bytes", "digest", "refers_to")
    return materialize(records.mapInArrow(task, MANIFEST), "manifest")


def _inflated(source) -> Iterator[bytes]:
    """The bytes of a file of gzip members, in blocks of at most ``CHUNK``."""
    press, data = zlib.decompressobj(31), b""
    while True:
        if not data:
            data = source.read(READ)
            if not data:
                return
        block = press.decompress(data, CHUNK)
        data = press.unconsumed_tail
        if block:
            yield block
        if press.eof:
            data, press = press.unused_data, zlib.decompressobj(31)


def chunk_rows(source) -> Iterator[tuple]:
    """The rows of an archive, in order; at most a header or a chunk is held at a time."""
    blocks, held = _inflated(source), bytearray()

    def fill() -> bool:
        block = next(blocks, None)
        held.extend(block or b"")
        return block is not None

    while True:
        at = 0
        while (end := held.find(_END, at)) < 0:
            at = max(0, len(held) - 3)
            if not fill():
                return
        fields = dict(x.split(": ", 1) for x in bytes(held[:end]).decode().split("\r\n")[1:])
        del held[: end + 4]
        left, size, number, sha = int(fields["Content-Length"]), 0, 0, hashlib.sha256()
        key_in = lambda name: fields.get(name, "<urn:page:>")[10:-1].split(":")[0]
        page = lambda name: int(key_in(name)) if key_in(name) else None
        kind, name = fields["WARC-Type"], fields["WARC-Record-ID"]
        while True:
            while len(held) < min(left, CHUNK):
                if not fill():
                    raise ValueError(f"{name} is cut short")
            part = bytes(held[: min(left, CHUNK)])
            del held[: len(part)]
            sha.update(part)
            left, size = left - len(part), size + len(part)
            yield (
                name, page("WARC-Record-ID"), kind, number, part, size, sha.copy().hexdigest(), left == 0,
                int(fields["X-Payload-Length"]), fields["WARC-Payload-Digest"].removeprefix("sha256:"), page("WARC-Refers-To"),
            )
            number += 1
            if not left:
                break
        while len(held) < 4 and fill():
            pass
        del held[:4]


def read(manifest: DataFrame) -> DataFrame:
    """The chunk table of the archives in a manifest; archives are dealt over the tasks."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    ship(manifest.sparkSession)
    schema = to_arrow_schema(_parse_datatype_string(CHUNKS))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                fs, inner = shared_fs(path)
                rows, size = [], 0
                with fs.open_input_stream(inner, compression=None) as source:
                    for row in chunk_rows(source):
                        rows.append(row)
                        size += len(row[4])
                        if len(rows) >= 1024 or size >= 1 << 22:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema.names)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema.names)

    tasks = manifest.sparkSession.sparkContext.defaultParallelism
    return manifest.select("path").repartition(max(tasks, 8), "path").mapInArrow(task, CHUNKS)


def records(chunks: DataFrame) -> DataFrame:
    """One row per record, from its last chunk: ``(key, payload_bytes, payload_digest, record_type, refers_to, intact)``.

    A response's bytes and digest are those of the payload as read; ``intact`` says that they are the declared ones.
    """
    whole: Column = F.col("record_type") == "response"
    return chunks.filter("last").select(
        "key",
        F.when(whole, F.col("bytes_so_far")).otherwise(F.col("declared_bytes")).alias("payload_bytes"),
        F.when(whole, F.col("digest_so_far")).otherwise(F.col("declared_digest")).alias("payload_digest"),
        "record_type",
        "refers_to",
        (~whole | (F.col("digest_so_far") == F.col("declared_digest"))).alias("intact"),
    )

"""WARC archives and their chunked record table.

Pages are written as response records, one gzip member each, and as revisit
records where an equal payload is stored already. Archives are read as a stream:
a record of any size becomes rows of a record identifier and a chunk number, each
with its bytes, the bytes so far and the digest so far, so no task ever holds a
whole record.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stewardry.llm.staging import file_system, run_folder, staged

CHUNK_BYTES = 64 << 10
READ_BYTES = 256 << 10
BATCH_BYTES = 4 << 20
ARCHIVE_BYTES = 256 << 20
# A record or HTTP header longer than this, and than any the writer tells of, is
# taken for a broken archive.
MOST_HEADER_BYTES = 1 << 20
# Payloads shorter than this are stored again each time.
LEAST_REVISIT_BYTES = 100

RECORD_ID = "urn:page:"
# The revisit profile of WARC 1.1.
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

CHUNKS = (
    "record_id string, record_type string, target_uri string, refers_to string, chunk_no long, chunk binary, "
    "bytes_so_far long, digest_so_far string, is_last boolean, payload_bytes long, payload_digest string"
)


def plan_records(pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html") -> DataFrame:
    """``key, url, payload, digest, refers_to``: null where the payload is stored.

    Of equal payloads of at least ``LEAST_REVISIT_BYTES``, the one with the
    smallest key is stored, and so are rows that share its key; the others refer
    to it. If all keys of a payload are null, each is stored.
    """
    body = F.coalesce(F.col(payload), F.lit(""))
    rows = pages.select(
        F.col(key).alias("key"), F.col(url).alias("url"), body.alias("payload"), F.sha2(body, 256).alias("digest")
    )
    first = (
        rows.where(F.octet_length("payload") >= LEAST_REVISIT_BYTES)
        .groupBy(F.col("digest").alias("_digest"))
        .agg(F.min("key").alias("_first"), F.count(F.lit(1)).alias("_n"))
        .where("_n > 1")
        .drop("_n")
    )
    joined = rows.join(first, F.col("digest") == F.col("_digest"), "left")
    refers = F.when(~F.col("key").eqNullSafe(F.col("_first")), F.col("_first"))
    return joined.select("key", "url", "payload", "digest", refers.alias("refers_to"))


def _value(text: str | None) -> str:
    """A header value; line ends and other controls would break the header."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", text or "")


def record(key, url: str | None, payload: memoryview, digest: str, refers_to, date: str) -> Iterator[bytes | memoryview]:
    """The bytes of one record, in pieces."""
    revisit = refers_to is not None
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    size = len(http) + (0 if revisit else len(payload))
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <{RECORD_ID}{'' if key is None else key}>",
        f"WARC-Target-URI: {_value(url)}",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha256:{digest}",
    ]
    if revisit:
        lines += [f"WARC-Refers-To: <{RECORD_ID}{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {size}"]
    yield "\r\n".join(lines).encode() + b"\r\n\r\n" + http
    if not revisit:
        for at in range(0, len(payload), CHUNK_BYTES):
            yield payload[at : at + CHUNK_BYTES]
    yield b"\r\n\r\n"


def write_archives(records: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z") -> DataFrame:
    """Write planned records; ``file, n_records, n_bytes, longest_header`` of every
    archive. The first piece of a record is its headers."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        out, name, n, size, longest, made = None, "", 0, 0, 0, []

        def close():
            if out is not None:
                out.close()
                made.append((name, n, size, longest))

        for batch in batches:
            keys, urls, digests, refers = (batch.column(c).to_pylist() for c in ("key", "url", "digest", "refers_to"))
            payloads = batch.column("payload")
            for i, (key, url, digest, to) in enumerate(zip(keys, urls, digests, refers)):
                if out is None or size > ARCHIVE_BYTES:
                    close()
                    name, n, size, longest = f"{uuid.uuid4().hex}.warc.gz", 0, 0, 0
                    store.create_dir(base, recursive=True)
                    out = store.open_output_stream(f"{base}/{name}", compression=None)
                packer = zlib.compressobj(1, zlib.DEFLATED, 31)
                for at, piece in enumerate(record(key, url, memoryview(payloads[i].as_buffer()), digest, to, date)):
                    longest = max(longest, len(piece)) if at == 0 else longest
                    packed = packer.compress(piece)
                    size += len(packed)
                    out.write(packed)
                packed = packer.flush()
                size += len(packed)
                out.write(packed)
                n += 1
        close()
        names, *numbers = zip(*made) if made else [()] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), *[pa.array(c, pa.int64()) for c in numbers]],
            ["file", "n_records", "n_bytes", "longest_header"],
        )

    return staged(records.mapInArrow(write, "file string, n_records long, n_bytes long, longest_header long"), "archives")


class Stream:
    """Unpacked bytes of an archive, plain or in gzip members, a piece at a time."""

    def __init__(self, source, most_header: int = MOST_HEADER_BYTES):
        self.most_header = most_header
        self.source, self.left, self.packed, self.unpacker = source, bytearray(), b"", None
        self.ended = False
        start = source.read(2)
        self.zipped = start == b"\x1f\x8b"
        if self.zipped:
            self.packed, self.unpacker = start, zlib.decompressobj(31)
        else:
            self.left += start

    def more(self) -> bool:
        """Unpack one more piece; false at the end of the archive."""
        while not self.ended:
            if not self.zipped:
                piece = self.source.read(READ_BYTES)
                self.ended = not piece
                self.left += piece
                if piece:
                    return True
                continue
            if self.unpacker.eof:
                self.packed, self.unpacker = self.unpacker.unused_data, zlib.decompressobj(31)
            if not self.packed:
                self.packed = self.source.read(READ_BYTES)
                if not self.packed:
                    self.ended = True
                    return False
            piece = self.unpacker.decompress(self.packed, READ_BYTES)
            self.packed = b"" if self.unpacker.eof else self.unpacker.unconsumed_tail
            if piece:
                self.left += piece
                return True
        return False

    def head(self) -> bytes | None:
        """Bytes up to an empty line; None at the end of the archive."""
        searched = 0
        while (at := self.left.find(b"\r\n\r\n", searched)) < 0:
            searched = max(0, len(self.left) - 3)
            if len(self.left) > self.most_header + READ_BYTES:
                raise ValueError("a header has no end")
            if not self.more():
                if bytes(self.left).strip():
                    raise ValueError("the archive ends within a header")
                return None
        found = bytes(self.left[:at])
        del self.left[: at + 4]
        return found

    def take(self, n: int) -> bytes:
        """The next ``n`` bytes, or fewer where more aren't unpacked yet."""
        if not self.left and n and not self.more():
            raise ValueError("the archive ends within a record")
        found = bytes(self.left[:n])
        del self.left[: len(found)]
        return found

    def fill(self, n: int) -> bytes:
        parts = []
        while n:
            parts.append(self.take(n))
            n -= len(parts[-1])
        return b"".join(parts)


def _fields(head: bytes) -> dict[str, str]:
    lines = head.decode("utf-8", "replace").split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}


def _bare(identifier: str | None) -> str | None:
    return identifier.strip("<>") if identifier is not None else None


def chunks(source, most_header: int = MOST_HEADER_BYTES) -> Iterator[tuple]:
    """Rows of the chunk table for one archive."""
    stream = Stream(source, most_header)
    while (head := stream.head()) is not None:
        if not head.startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = _fields(head)
        size = int(fields["content-length"])
        http = {}
        if fields.get("content-type", "").startswith("application/http"):
            block = stream.head()
            if block is None:
                raise ValueError("the archive ends within a record")
            http, size = _fields(block), size - len(block) - 4
        kind = fields.get("warc-type")
        told = fields.get("warc-payload-digest", "").partition(":")[2] or None
        known = (
            _bare(fields.get("warc-record-id")), kind, fields.get("warc-target-uri"), _bare(fields.get("warc-refers-to")),
        )
        digest, done, number = hashlib.sha256(), 0, 0
        while True:
            piece = stream.fill(min(CHUNK_BYTES, size - done))
            digest.update(piece)
            done += len(piece)
            last = done == size
            so_far = digest.copy().hexdigest()
            if last and kind == "response" and told not in (None, so_far):
                raise ValueError(f"{known[0]} does not have the digest it states")
            # A revisit's payload is described by its headers alone.
            full = int(http.get("content-length", 0)) if kind == "revisit" else done
            yield (*known, number, piece, done, so_far, last, full if last else None, (told if kind == "revisit" else so_far) if last else None)
            if last:
                break
            number += 1
        if stream.fill(4) != b"\r\n\r\n":
            raise ValueError("a record has no end mark")


def read_chunks(spark: SparkSession, files: DataFrame, folder: str) -> DataFrame:
    """The chunk table of the archives named in ``files``, a staged table, which may
    tell their ``longest_header``.

    Names are tiny and the work lies in the archives, so they are dealt to as many
    tasks as there are archives, which no one merges by their size. ``payload_bytes`` and ``payload_digest`` are set in the last chunk's row; a
    record without a payload has one empty chunk. A broken archive, or a payload
    that differs from its stated digest, fails the read.
    """
    names = CHUNKS.replace(",", "").split()[0::2]
    kinds = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary(), "boolean": pa.bool_()}
    types = [kinds[k] for k in CHUNKS.replace(",", "").split()[1::2]]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, base = file_system(folder)
        rows, size = [], 0

        def packed():
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

        for batch in batches:
            for name, longest in zip(*(c.to_pylist() for c in batch.columns)):
                with store.open_input_stream(f"{base}/{name}", compression=None) as source:
                    for row in chunks(source, max(MOST_HEADER_BYTES, longest)):
                        rows.append(row)
                        size += len(row[5]) + 200
                        if size > BATCH_BYTES:
                            yield packed()
                            rows, size = [], 0
        if rows:
            yield packed()

    longest = F.col("longest_header") if "longest_header" in files.columns else F.lit(0).cast("long")
    return files.select("file", longest).repartition(max(files.count(), 1), "file").mapInArrow(read, CHUNKS)


def write_and_read(
    spark: SparkSession, pages: DataFrame, key: str = "page_id", url: str = "url", payload: str = "html"
) -> DataFrame:
    """Write every page to archives and read them back as one row per record:
    ``key, payload_bytes, payload_digest, record_type, refers_to``, keys as text.

    A null payload is empty. Null keys have an empty name in the archive and come
    back as null. Repeated rows are records of their own. No pages: no archives
    and no rows. The archives stay in a folder below ``spark.checkpoint.dir``.
    """
    folder = run_folder(spark, "warc")
    files = write_archives(plan_records(pages, key, url, payload), folder)
    last = read_chunks(spark, files, folder).where("is_last")
    name = lambda c: F.nullif(F.substring(c, len(RECORD_ID) + 1, 1 << 20), F.lit(""))
    return last.select(
        name(F.col("record_id")).alias(key),
        "payload_bytes",
        "payload_digest",
        "record_type",
        name(F.col("refers_to")).alias("refers_to"),
    )

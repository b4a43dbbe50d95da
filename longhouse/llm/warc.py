"""WARC archives whose records are compressed one by one with a dictionary made from them."""

from __future__ import annotations

import base64
import hashlib
import struct
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from longhouse.llm.common import lookup

#: Fixed values of the formats: frames that zstd decoders skip; the first one carries the dictionary.
DICTIONARY_FRAME = 0x184D2A5D
#: Spark ends every line it writes with this, an empty skippable frame, which is valid between records.
EMPTY_FRAME = "\x50\x2a\x4d\x18\x00\x00\x00\x00"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: A dictionary has at most this size and is built from the first records of an archive, up to
#: SAMPLE_BYTES of them, of which each gives RECORD_SAMPLE at most.
DICTIONARY_BYTES = 64 << 10
SAMPLE_BYTES = 4 << 20
RECORD_SAMPLE = 128 << 10
LEVEL = 3


def digest_text(hexadecimal: str) -> str:
    return base64.b32encode(bytes.fromhex(hexadecimal)).decode()


def record(page_id, url, kind: str, refers_to, digest: str, payload: bytes, date: str) -> bytes:
    """A response or revisit record; its block is an HTTP answer, for a revisit the head alone."""
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = head.encode() + (payload if kind == "response" else b"")
    lines = [
        VERSION,
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {date}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if url is not None:
        lines.append(f"WARC-Target-URI: {quote(url, safe=''.join(map(chr, range(33, 127))))}")
    if kind == "revisit":
        lines += [f"WARC-Refers-To: <urn:page:{refers_to}>", f"WARC-Profile: {REVISIT_PROFILE}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def train(samples: list[bytes]) -> zstandard.ZstdCompressionDict | None:
    """A dictionary of the samples; none if they are too few or too alike to make one."""
    size = min(DICTIONARY_BYTES, sum(map(len, samples)) // 10)
    if len(samples) < 8 or size < 256:
        return None
    try:
        return zstandard.train_dictionary(size, samples)
    except zstandard.ZstdError:
        return None


def frames(records: Iterator[bytes]) -> Iterator[bytes]:
    """The frames of one archive: the dictionary, then a frame for each record."""
    first, held = [], 0
    for r in records:
        first.append(r)
        held += len(r)
        if held >= SAMPLE_BYTES:
            break
    if not first:
        return
    dictionary = train([r[:RECORD_SAMPLE] for r in first])
    if dictionary is not None:
        content = dictionary.as_bytes()
        yield struct.pack("<II", DICTIONARY_FRAME, len(content)) + content
        dictionary.precompute_compress(level=LEVEL)
    compressor = zstandard.ZstdCompressor(level=LEVEL, dict_data=dictionary, write_checksum=True)
    while first:
        yield compressor.compress(first.pop(0))
    for r in records:
        yield compressor.compress(r)


def records_to_write(pages: DataFrame, min_payload: int = 0) -> DataFrame:
    """A row for each record: page_id, url, payload, sha1, record_type, refers_to.

    Of the records with equal payloads of at least ``min_payload`` bytes the one with the smallest
    page_id is the response, the others revisit it. Rows that share the smallest page_id are all
    responses. A null page_id never is the smallest; if no page of a payload has an id, all are
    responses. A null html is an empty payload.
    """
    payload = F.coalesce("html", F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("payload"))
    rows = rows.withColumn("sha1", F.sha1("payload"))
    long_enough = rows.where(F.length("payload") >= min_payload)
    firsts = long_enough.groupBy("sha1").agg(F.min("page_id").alias("first"), F.count(F.lit(1)).alias("n"))
    firsts = firsts.where("n > 1 AND first IS NOT NULL").select("sha1", "first")
    spread = F.xxhash64("page_id", "url")
    known = lookup(rows, firsts, "sha1", spread)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first"))
    if min_payload > 0:
        revisit = revisit & (F.length("payload") >= min_payload)
    return known.select(
        "page_id", "url", "payload", "sha1",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, path: str, min_payload: int = 0, date: str = "2020-01-01T00:00:00Z") -> None:
    """Write ``pages`` (page_id, url, html) as archives into ``path``, one for each task.

    Spark's text writer puts the frames into files, so its committer settles retried and lost tasks
    and any store that Spark writes to will do. Nothing is gathered: a task holds SAMPLE_BYTES of
    records and the record it compresses. No rows write no record. ``date`` is the WARC-Date.
    """

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[bytes]:
            for batch in batches:
                for row in zip(*[batch.column(i) for i in range(batch.num_columns)]):
                    page_id, url, payload, sha1, kind, refers_to = [v.as_py() for v in row]
                    yield record(page_id, url, kind, refers_to, digest_text(sha1), payload, date)

        out, held = [], 0
        for frame in frames(records()):
            out.append(frame)
            held += len(frame)
            if held >= 1 << 20:
                yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frame"])

    rows = records_to_write(pages, min_payload).mapInArrow(compress, "frame binary")
    rows.select(F.col("frame").cast("string").alias("value")).write.option("lineSep", EMPTY_FRAME).text(path)


def read_records(source) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a decompressed archive, a stream with ``read``."""
    held = b""

    def more(n: int) -> bool:
        nonlocal held
        parts = [held]
        have = len(held)
        while have < n:
            got = source.read(max(1 << 16, n - have))
            if not got:
                break
            parts.append(got)
            have += len(got)
        held = b"".join(parts)
        return have >= n

    while True:
        end = held.find(b"\r\n\r\n")
        while end < 0:
            before = len(held)
            more(before + 1)
            if len(held) == before:
                if held:
                    raise ValueError("an archive ends within a record")
                return
            end = held.find(b"\r\n\r\n")
        lines = held[:end].decode().split("\r\n")
        if not lines[0].startswith("WARC/"):
            raise ValueError("not a WARC record")
        headers = dict(line.split(": ", 1) for line in lines[1:])
        length = int(headers["Content-Length"])
        if not more(end + 4 + length + 4):
            raise ValueError("an archive ends within a record")
        yield headers, held[end + 4 : end + 4 + length]
        held = held[end + 4 + length + 4 :]


def open_archive(content: bytes):
    """A stream of the records of an archive, read with the dictionary in its leading frame."""
    dictionary = None
    if len(content) >= 8:
        magic, size = struct.unpack_from("<II", content)
        if magic == DICTIONARY_FRAME:
            dictionary = zstandard.ZstdCompressionDict(content[8 : 8 + size])
    return zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(content, read_across_frames=True)


READ_SCHEMA = (
    "page_id long, url string, record_type string, refers_to long, payload_bytes long, "
    "payload_digest string, archive string"
)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """A row for each record of the archives in ``path``.

    Digest and size of a response are taken from its payload again, and a record whose digest is
    not what its head says is an error. A revisit has its payload's size in the HTTP head that it
    keeps and the digest in its WARC head. A row of the file scan is one archive.
    """

    def number(urn: str | None) -> int | None:
        text = (urn or "").removeprefix("<urn:page:").removesuffix(">")
        return int(text) if text else None

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema(
            [("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64()),
             ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("archive", pa.string())]
        )
        for batch in batches:
            for name, content in zip(batch.column(0), batch.column(1)):
                out = []
                for headers, block in read_records(open_archive(content.as_py())):
                    kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
                    head, _, payload = block.partition(b"\r\n\r\n")
                    size = len(payload)
                    if kind == "revisit":
                        size = int(head.rpartition(b"Content-Length: ")[2])
                    elif digest_text(hashlib.sha1(payload).hexdigest()) != digest:
                        raise ValueError(f"payload of {headers['WARC-Record-ID']} is not what its digest says")
                    out.append(
                        (number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), kind,
                         number(headers.get("WARC-Refers-To")), size, digest, name.as_py().rpartition("/")[2])
                    )
                    if len(out) >= 10_000:
                        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                        out = []
                if out:
                    yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path)
    return files.select("path", "content").mapInArrow(decode, READ_SCHEMA)

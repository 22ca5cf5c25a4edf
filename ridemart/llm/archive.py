"""WARC archives compressed with an embedded dictionary.

Each file starts with a Zstandard skippable frame that holds a dictionary
built from the file's own records; every record follows as a frame of its own,
compressed with it.  A reader needs nothing but the file.

Records with equal payloads (``min_revisit_bytes`` at least) are written once:
the smallest page id as a response, the others as revisits of it.

Edge cases: a null html is an empty payload; a null page id is never the one
referred to; rows repeated with the smallest id are all responses; a file with
too little to train on has an empty dictionary frame; an empty table writes no
file; a null url is left out of its record; other columns are not read; rows
that repeat both id and url share a salt.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.llm import store
from ridemart.llm.cluster import shared_folder

#: Fixed values of the format.
_DICTIONARY_MAGIC = 0x184D2A5D
_ZSTD_DICTIONARY = b"\x37\xa4\x30\xec"
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

MANIFEST_SCHEMA = "uri string, n_records long, n_bytes long"
RECORD_SCHEMA = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, uri string, place long"


@dataclass(frozen=True)
class ArchiveConfig:
    min_revisit_bytes: int = 100
    #: One salt for so many rows of the table: pages with one payload meet under that many keys.
    salt_rows: int = 50_000
    file_payload_bytes: int = 32 << 20
    level: int = 3
    dictionary_bytes: int = 64 << 10
    #: Training sample of a file: so many records, so many leading bytes of each (sizes the dictionary only).
    sample_records: int = 400
    sample_bytes: int = 8 << 10
    date: str = "2024-01-01T00:00:00Z"


def with_references(pages: DataFrame, cfg: ArchiveConfig) -> DataFrame:
    """Adds digest and, for revisits, ``refers_to``.

    Payload bytes move under (digest, salt of id and url), so a payload that a
    third of the pages share is spread over as many keys as the table has
    salts.  Each payload's first page is found from one row per (digest, salt),
    combined before its shuffle and without the bytes.
    """
    salts = max(1, -(-pages.count() // cfg.salt_rows))
    rows = pages.select(F.col("page_id").cast("long"), F.col("url").cast("string"), F.coalesce("html", F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("digest", F.sha2("payload", 256)).withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(salts)))
    cells = (rows.where(F.length("payload") >= cfg.min_revisit_bytes).groupBy("digest", "salt")
             .agg(F.min("page_id").alias("least"), F.count("*").alias("n")))
    firsts = (cells.groupBy(F.col("digest").alias("_digest")).agg(F.min("least").alias("first"), F.sum("n").alias("_n"))
              .where("_n > 1").select("_digest", "first"))
    cells = (cells.join(firsts, F.col("digest") == F.col("_digest"))
             .select("_digest", F.col("salt").alias("_salt"), "first"))
    return (rows.join(cells, (F.col("digest") == F.col("_digest")) & (F.col("salt") == F.col("_salt")), "left")
            .withColumn("refers_to", F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))).drop("_digest", "_salt", "salt", "first"))


def _record_id(page_id: int | None) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def record_bytes(page_id, url, payload: bytes, digest: str, refers_to, date: str) -> bytes:
    """One WARC/1.1 record; a revisit has the payload's length and digest, not the payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers_to is not None else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: {_record_id(page_id)}", f"WARC-Date: {date}"]
    if url is not None:
        head.append("WARC-Target-URI: " + "".join(c if c > " " else "%{:02X}".format(ord(c)) for c in url))
    if refers_to is not None:
        head += [f"WARC-Refers-To: {_record_id(refers_to)}", f"WARC-Profile: {_PROFILE}"]
    head += [f"WARC-Payload-Digest: sha256:{digest}", "Content-Type: application/http;msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def parse_record(data: bytes) -> tuple[dict[str, str], bytes]:
    """(header fields, block)."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    size = int(fields["Content-Length"])
    if lines[0] != "WARC/1.1" or rest[size:] != b"\r\n\r\n":
        raise ValueError("not a whole WARC record")
    return fields, rest[:size]


def train(records: list[bytes], cfg: ArchiveConfig) -> bytes:
    """A dictionary from evenly spaced records, or nothing when they are too few or too small."""
    step = max(1, len(records) // cfg.sample_records)
    samples = [r[:cfg.sample_bytes] for r in records[::step]]
    if len(samples) < 8 or sum(map(len, samples)) < 2 * cfg.dictionary_bytes:
        return b""
    try:
        return zstandard.train_dictionary(cfg.dictionary_bytes, samples, k=1024, d=8).as_bytes()
    except zstandard.ZstdError:
        return b""


def file_parts(records: list[bytes], cfg: ArchiveConfig) -> list[bytes]:
    """Skippable dictionary frame (itself compressed), then one frame per record."""
    raw = train(records, cfg)
    frame = zstandard.ZstdCompressor(level=cfg.level).compress(raw) if raw else b""
    head = _DICTIONARY_MAGIC.to_bytes(4, "little") + len(frame).to_bytes(4, "little") + frame
    known = {}
    if raw:
        known["dict_data"] = zstandard.ZstdCompressionDict(raw)
        known["dict_data"].precompute_compress(level=cfg.level)
    codec = zstandard.ZstdCompressor(level=cfg.level, write_checksum=True, **known)
    return [head, *(codec.compress(r) for r in records)]


def read_records(data: bytes) -> Iterator[tuple[int, bytes]]:
    """(place, record) of a file, frame by frame."""
    if int.from_bytes(data[:4], "little") != _DICTIONARY_MAGIC:
        raise ValueError("no dictionary frame")
    at = 8 + int.from_bytes(data[4:8], "little")
    frame = data[8:at]
    raw = frame if frame[:4] == _ZSTD_DICTIONARY else zstandard.ZstdDecompressor().decompress(frame) if frame else b""
    codec = zstandard.ZstdDecompressor(**({"dict_data": zstandard.ZstdCompressionDict(raw)} if raw else {}))
    view = memoryview(data)
    while at < len(data):
        one, out, place = codec.decompressobj(), [], at
        while not one.eof:
            if at >= len(data):
                raise ValueError("cut off record")
            step = view[at:at + (1 << 16)]
            out.append(one.decompress(step))
            at += len(step)
        at -= len(one.unused_data)
        yield place, b"".join(out)


def write_archives(pages: DataFrame, folder: str, cfg: ArchiveConfig | None = None) -> DataFrame:
    """Write all pages as ``.warc.zst`` files below ``folder``; the manifest of files, written as a table there."""
    cfg = cfg or ArchiveConfig()

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, records, size = TaskContext.get().partitionId(), 0, [], 0

        def flush():
            nonlocal seq, records, size
            parts = file_parts(records, cfg)
            uri = store.write_file(folder, f"pages-{part:06d}-{seq:06d}", parts, ".warc.zst")
            row = {"uri": [uri], "n_records": [len(records)], "n_bytes": [sum(map(len, parts))]}
            seq, records, size = seq + 1, [], 0
            return pa.RecordBatch.from_pydict(row)

        for batch in batches:
            for row in zip(*(batch.column(c).to_pylist() for c in ("page_id", "url", "payload", "digest", "refers_to"))):
                records.append(record_bytes(*row, cfg.date))
                size += len(records[-1])
                if size >= cfg.file_payload_bytes:
                    yield flush()
        if records:
            yield flush()

    with_references(pages, cfg).mapInArrow(write, MANIFEST_SCHEMA).write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(MANIFEST_SCHEMA).parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record, from the files alone (``RECORD_SCHEMA``); a response's digest is computed again."""

    def page_of(record_id: str) -> int | None:
        number = record_id[len("<urn:x-page:"):-1]
        return int(number) if number else None

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [c.split()[0] for c in RECORD_SCHEMA.split(", ")]
        types = [pa.string() if c.endswith("string") else pa.int64() for c in RECORD_SCHEMA.split(", ")]
        for batch in batches:
            for uri in batch.column("uri").to_pylist():
                rows = []
                for place, record in read_records(store.read_file(uri)):
                    fields, block = parse_record(record)
                    http, _, payload = block.partition(b"\r\n\r\n")
                    length = int(http.rsplit(b": ", 1)[1])
                    digest = fields["WARC-Payload-Digest"].removeprefix("sha256:")
                    if fields["WARC-Type"] == "response" and (len(payload) != length or hashlib.sha256(payload).hexdigest() != digest):
                        raise ValueError(f"damaged payload at {place} of {uri}")
                    refers = fields.get("WARC-Refers-To")
                    rows.append((page_of(fields["WARC-Record-ID"]), length, digest, fields["WARC-Type"], refers and page_of(refers), uri, place))
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(zip(*rows), types)], names=names)

    files = max(1, min(manifest.count(), 10_000))
    return manifest.select("uri").repartition(files, "uri").mapInArrow(read, RECORD_SCHEMA)


def archive_pages(spark: SparkSession, pages: DataFrame, cfg: ArchiveConfig | None = None) -> DataFrame:
    """Write to a new shared folder and read back."""
    return read_archives(write_archives(pages, shared_folder(spark, "archives"), cfg))

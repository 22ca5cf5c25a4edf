"""Chunked key exchange: ask about every key of a corpus with one small row per chunk and bucket.

Documents are gathered into chunks; a chunk's texts are kept as one compressed
file in the shared folder and its keys (64-bit hashes) are sent, sorted and
delta-coded, to key buckets.  A bucket sees all chunks that have a key, answers
each in the order it asked, and the chunk's next step reads its texts again
beside the answers.  Equal keys of a chunk are sent once with a count, so a hot
key costs one entry per chunk.  Requests and answers are tables or shuffles of
Spark; a lost executor only repeats its own chunks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import store
from ridemart.llm.cluster import per_worker, release_memory

REQUEST_SCHEMA = "bucket int, chunk string, payload binary"
#: Bucket of the rows that only announce a chunk.
CHUNK_ROW = -1
KEY_BITS = 40


def squeeze(values: np.ndarray) -> bytes:
    """Any integer array, its byte planes apart, compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T if len(values) else np.zeros((0, 0), np.uint8)
    return per_worker("squeeze", lambda: zstandard.ZstdCompressor(level=1)).compress(np.ascontiguousarray(planes))


def unsqueeze(data: bytes, kind) -> np.ndarray:
    raw = np.frombuffer(per_worker("unsqueeze", zstandard.ZstdDecompressor).decompress(data), np.uint8)
    width = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(width, -1).T).view(kind).ravel() if len(raw) else np.zeros(0, kind)


def squeeze_sorted(keys: np.ndarray) -> bytes:
    return squeeze(np.diff(keys, prepend=np.zeros(1, keys.dtype)))


def unsqueeze_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(unsqueeze(data, np.uint64), dtype=np.uint64)


def join_parts(parts: list[bytes]) -> bytes:
    return np.array([len(parts), *map(len, parts)], "<u8").tobytes() + b"".join(parts)


def split_parts(data: bytes) -> list[bytes]:
    n = int.from_bytes(data[:8], "little")
    sizes = np.frombuffer(data[8:8 + 8 * n], "<u8").astype(np.int64)
    cuts = np.concatenate([[0], np.cumsum(sizes)]) + 8 + 8 * n
    return [data[a:b] for a, b in zip(cuts, cuts[1:])]


def short_keys(hashes: np.ndarray) -> np.ndarray:
    """The upper 40 bits: enough to find shared keys; the few false ones are settled by exact checks."""
    return hashes >> np.uint64(64 - KEY_BITS)


def bucket_cuts(keys: np.ndarray, n_buckets: int, bits: int = KEY_BITS) -> np.ndarray:
    """Bounds of each bucket's range in sorted keys."""
    edges = [-(-(k << bits) // n_buckets) for k in range(1, n_buckets)]
    return np.concatenate([[0], np.searchsorted(keys, np.array(edges, np.uint64)), [len(keys)]]).astype(np.int64)


def bucket_requests(keys: np.ndarray, columns: list[np.ndarray], chunk: str, n_buckets: int, bits: int = KEY_BITS) -> Iterator[tuple]:
    """Request rows of one chunk: sorted unique keys with further columns in the same order."""
    cuts = bucket_cuts(keys, n_buckets, bits)
    for k, (a, b) in enumerate(zip(cuts, cuts[1:])):
        if b > a:
            yield k, chunk, join_parts([squeeze_sorted(keys[a:b]), *(squeeze(c[a:b]) for c in columns)])


def rows_batch(rows: list[tuple]) -> pa.RecordBatch:
    buckets, chunks, payloads = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(buckets, pa.int32()), pa.array(chunks, pa.string()), pa.array(payloads, pa.binary())],
                                      names=["bucket", "chunk", "payload"])


def save_texts(folder: str, batch: pa.Table) -> str:
    """A chunk's rows as one compressed Arrow file; its URI names the chunk."""
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(batch)
    return store.write_file(folder, "chunk", [sink.getvalue().to_pybytes()])


def load_texts(chunk: str) -> pa.Table:
    return pa.ipc.open_stream(store.read_file(chunk)).read_all()


def text_chunks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    """Rows gathered into tables of about ``size`` bytes (one row at least)."""
    waiting, total = [], 0
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(False)
        first = 0
        for k, n in enumerate(sizes.tolist()):
            if total and total + n > size:
                waiting.append(batch.slice(first, k - first))
                yield pa.Table.from_batches(waiting).combine_chunks()
                waiting, total, first = [], 0, k
            total += n + 16
        waiting.append(batch.slice(first))
    if sum(b.num_rows for b in waiting):
        yield pa.Table.from_batches(waiting).combine_chunks()


def text_bytes(docs: DataFrame) -> int:
    return docs.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0


def write_requests(docs: DataFrame, folder: str, requests: Callable, chunk_bytes: int, save: Callable = save_texts) -> DataFrame:
    """Chunk the rows (``doc_id``, ``text``), keep them, and write what ``requests(table, chunk)`` asks.

    ``save`` returns the chunk's URI, or that and what ``requests`` gets instead of the rows.
    """

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in text_chunks(batches, chunk_bytes):
            saved = save(folder, table)
            chunk, what = saved if isinstance(saved, tuple) else (saved, table)
            rows = rows_batch([(CHUNK_ROW, chunk, b""), *requests(what, chunk)])
            del table, saved, what
            release_memory()
            yield rows

    path = f"{folder}/requests"
    (docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(ask, REQUEST_SCHEMA)
     .write.option("compression", "uncompressed").parquet(path))
    return docs.sparkSession.read.schema(REQUEST_SCHEMA).parquet(path)


def answer(requests: DataFrame, reduce: Callable, n_buckets: int, pass_chunks: bool = False) -> DataFrame:
    """Each bucket's requests through ``reduce(list of part lists) -> list of payloads``; answers keep bucket and chunk.

    Requests come in chunk order.  With ``pass_chunks`` the chunk rows go along,
    so that requests that are not a table need to be made only once.
    """

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        if table.column("bucket")[0].as_py() == CHUNK_ROW:
            return table
        payloads = reduce([split_parts(p.as_py()) for p in table.column("payload")])
        release_memory()
        return pa.table({"bucket": table.column("bucket"), "chunk": table.column("chunk"), "payload": pa.array(payloads, pa.binary())})

    asked = requests if pass_chunks else requests.where(F.col("bucket") != CHUNK_ROW)
    return asked.repartition(n_buckets, "bucket").groupBy("bucket").applyInArrow(one, REQUEST_SCHEMA)


def chunk_rows(requests: DataFrame) -> DataFrame:
    return requests.where(F.col("bucket") == CHUNK_ROW)


def finish(rows: DataFrame, chunks: int, last: Callable, schema: str, with_buckets: bool = False) -> DataFrame:
    """Run ``last(chunk, [payload by bucket]) -> Arrow table`` for every chunk; what a chunk row carries comes first.

    ``with_buckets``: (bucket, payload) pairs instead.
    """

    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("bucket")
        pairs = [(b, p) for b, p in zip(table.column("bucket").to_pylist(), table.column("payload").to_pylist()) if p]
        out = last(table.column("chunk")[0].as_py(), pairs if with_buckets else [p for _, p in pairs])
        del pairs
        release_memory()
        return out

    return rows.repartition(max(1, chunks), "chunk").groupBy("chunk").applyInArrow(one, schema)

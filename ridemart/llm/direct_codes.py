"""Token-id files of directly addressable codes.

Ids are split into chunks of ``chunk_bits``.  Level 0 holds the lowest chunk of
every id; a continuation bitmap marks the ids that go on, and the next level
holds their next chunk, in order.  A rank directory (set bits before every 512)
finds an id's place on the next level, so any id is read in constant time and
nothing around it is decoded.

File (little-endian): magic, crc32 of the rest, header, document ids, document
starts, then per level chunks, bitmap words, directory, each padded to 8 bytes.
Several files make one corpus: ``write_corpus`` returns a manifest with one row
per file, in ascending document order.

Edge cases: a null text is an empty document (its end id only); null ids are
stored as a flag and sort first; repeated rows and ids are kept, in any order
among equals; an empty table writes no file and has an empty manifest.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ridemart.llm import store
from ridemart.llm.cluster import shared_folder
from ridemart.llm.tokens import encoded

_MAGIC = b"DACTOK01"
_BLOCK = 8  # bitmap words per directory entry

MANIFEST_SCHEMA = "part int, seq int, n_docs long, n_tokens long, n_bytes long, uri string"
TOKEN_SCHEMA = "doc_id long, start long, n_tokens long, ids_crc32 long, uri string, place long"


def _popcounts(words: np.ndarray) -> np.ndarray:
    return np.bitwise_count(words).astype(np.uint32)


def split_levels(ids: np.ndarray, chunk_bits: int) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(chunks, bitmap words, directory) of every level."""
    kind = {8: np.uint8, 16: np.uint16}[chunk_bits]
    rest, levels = ids.astype(np.uint32, copy=False), []
    while True:
        on = rest > (1 << chunk_bits) - 1
        bits = np.packbits(on, bitorder="little")
        words = np.zeros(-(-len(rest) // 64), np.uint64)
        words.view(np.uint8)[:len(bits)] = bits
        counts = np.add.reduceat(_popcounts(words), np.arange(0, len(words), _BLOCK)) if len(words) else np.zeros(0, np.int64)
        directory = np.concatenate([[0], np.cumsum(counts, dtype=np.uint64)]).astype(np.uint64)
        levels.append((rest.astype(kind), words, directory))
        if not on.any():
            return levels
        rest = rest[on] >> np.uint32(chunk_bits)


def pack(doc_ids: np.ndarray, known: np.ndarray, starts: np.ndarray, ids: np.ndarray, chunk_bits: int = 8) -> bytes:
    """One file's bytes.  ``known``: False where the document id is null."""
    levels = split_levels(ids, chunk_bits)
    body = [np.array([len(doc_ids), len(ids), chunk_bits, len(levels)] + [len(x[0]) for x in levels], "<u8").tobytes(),
            doc_ids.astype("<i8").tobytes(), np.asarray(starts).astype("<u8").tobytes(), known.astype(np.uint8).tobytes()]
    for level in levels:
        body[-1] += b"\0" * (-len(body[-1]) % 8)
        body += [a.astype(a.dtype.newbyteorder("<"), copy=False).tobytes() for a in (level[1], level[2], level[0])]
    packed = b"".join(body)
    return _MAGIC + np.array([zlib.crc32(packed)], "<u8").tobytes() + packed


class TokenFile:
    """A packed file in memory (or memory-mapped): documents and single ids by position."""

    def __init__(self, data, verify: bool = True):
        raw = np.frombuffer(data, np.uint8)
        if raw[:8].tobytes() != _MAGIC:
            raise ValueError("not a token file")
        if verify and zlib.crc32(raw[16:]) != int(raw[8:16].view("<u8")[0]):
            raise ValueError("damaged token file")
        self._raw, self._at = raw, 16
        n_docs, self.n_tokens, self.bits, n_levels = map(int, self._take("<u8", 4))
        sizes = [int(x) for x in self._take("<u8", n_levels)]
        self.doc_ids = self._take("<i8", n_docs)
        self.starts = self._take("<u8", n_docs + 1).astype(np.int64)
        self.known = self._take(np.uint8, n_docs).astype(bool)
        self.levels = []
        for size in sizes:
            self._at += -self._at % 8
            words = -(-size // 64)
            bitmap, directory = self._take("<u8", words), self._take("<u8", -(-words // _BLOCK) + 1)
            self.levels.append((self._take({8: "u1", 16: "<u2"}[self.bits], size), bitmap, directory))

    def _take(self, kind, n: int) -> np.ndarray:
        end = self._at + n * np.dtype(kind).itemsize
        part = self._raw[self._at:end].view(kind)
        self._at = end
        return part

    def ids(self, places: np.ndarray) -> np.ndarray:
        """The ids at any places, by bitmap and rank alone."""
        at = np.asarray(places, np.int64)
        out, rows = np.zeros(len(at), np.uint32), np.arange(len(at))
        for k, (chunks, bitmap, directory) in enumerate(self.levels):
            out[rows] |= chunks[at].astype(np.uint32) << np.uint32(k * self.bits)
            word, bit = at >> 6, (at & 63).astype(np.uint64)
            on = (bitmap[word] >> bit & np.uint64(1)).astype(bool)
            rows, at, word, bit = rows[on], at[on], word[on], bit[on]
            if not len(rows):
                break
            block = word // _BLOCK
            rank = directory[block].astype(np.int64) + np.bitwise_count(bitmap[word] & ((np.uint64(1) << bit) - np.uint64(1)))
            for step in range(_BLOCK - 1):
                w = block * _BLOCK + step
                rank += np.where(w < word, np.bitwise_count(bitmap[np.minimum(w, len(bitmap) - 1)]), 0)
            at = rank
        return out

    def all_ids(self) -> np.ndarray:
        """Every id in order (levels merged from the top down)."""
        upper = None
        for chunks, bitmap, _ in reversed(self.levels):
            here = chunks.astype(np.uint32)
            if upper is not None:
                on = np.unpackbits(bitmap.view(np.uint8), bitorder="little", count=len(chunks)).astype(bool)
                here[on] |= upper << np.uint32(self.bits)
            upper = here
        return upper

    def document(self, row: int) -> np.ndarray:
        return self.ids(np.arange(self.starts[row], self.starts[row + 1]))


def write_corpus(docs: DataFrame, vocabulary: str, end_id: int, folder: str, chunk_bits: int = 8, tokens_per_file: int = 1 << 23) -> DataFrame:
    """Encode all texts in ascending id order into files below ``folder``; the manifest, written as a table there."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        end = np.array([end_id], "<u4").tobytes()
        seq, doc_ids, known, pieces, total = 0, [], [], [], 0

        def flush():
            nonlocal seq, doc_ids, known, pieces, total
            sizes = np.array([len(p) // 4 for p in pieces], np.int64)
            packed = pack(np.array(doc_ids, np.int64), np.array(known, bool), np.concatenate([[0], np.cumsum(sizes)]),
                          np.frombuffer(b"".join(pieces), "<u4"), chunk_bits)
            uri = store.write_file(folder, f"tokens-{part:06d}-{seq:06d}", [packed])
            row = {"part": [part], "seq": [seq], "n_docs": [len(sizes)], "n_tokens": [int(sizes.sum())], "n_bytes": [len(packed)], "uri": [uri]}
            seq, doc_ids, known, pieces, total = seq + 1, [], [], [], 0
            return pa.RecordBatch.from_pydict(row, schema=pa.schema([("part", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()),
                                                                     ("n_tokens", pa.int64()), ("n_bytes", pa.int64()), ("uri", pa.string())]))

        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for a, some in encoded(batch.column("text"), vocabulary):
                for i, tokens in zip(ids[a:], some):
                    doc_ids.append(i or 0)
                    known.append(i is not None)
                    pieces.append(tokens + end)
                    total += len(tokens) // 4 + 1
                    if total >= tokens_per_file:
                        yield flush()
        if pieces:
            yield flush()

    table = f"{folder}/manifest"
    (docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
     .mapInArrow(encode, MANIFEST_SCHEMA).write.parquet(table))
    return docs.sparkSession.read.schema(MANIFEST_SCHEMA).parquet(table)


def read_corpus(manifest: DataFrame) -> DataFrame:
    """One row per document from the files: its first place in the corpus, ids counted and summed (``TOKEN_SCHEMA``)."""
    first = F.sum("n_tokens").over(Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1))
    files = manifest.withColumn("first", F.coalesce(first, F.lit(0))).select("uri", "first")  # a row per file

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri, begin in zip(batch.column("uri").to_pylist(), batch.column("first").to_pylist()):
                tokens = TokenFile(store.read_file(uri))
                raw = memoryview(tokens.all_ids().astype("<u4", copy=False)).cast("B")
                cuts = (tokens.starts * 4).tolist()
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(tokens.doc_ids, mask=~tokens.known), "start": tokens.starts[:-1] + begin,
                    "n_tokens": np.diff(tokens.starts), "ids_crc32": np.array([zlib.crc32(raw[a:b]) for a, b in zip(cuts, cuts[1:])], np.int64),
                    "uri": pa.array([uri] * len(tokens.doc_ids), pa.string()), "place": tokens.starts[:-1]})

    spread = max(1, min(manifest.count(), 10_000))
    return files.repartition(spread, "uri").mapInArrow(decode, TOKEN_SCHEMA)


def encode_corpus(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int) -> DataFrame:
    """Write the files to a new shared folder and read them back."""
    return read_corpus(write_corpus(docs, vocabulary, end_id, shared_folder(spark, "token-files")))

"""Bounded-space online best-fit packing.

Pieces arrive one by one; a fixed number of bins is open, kept in a bitset by
free space.  A piece goes to the open bin with the least space that still holds
it (the lowest set bit at or above its length); if none does, a new bin opens,
and when all are in use the fullest closes first.  Pieces arrive through a
fixed lookahead buffer, longest first, which lets the bins close nearly full.

Pieces are dealt to packing tasks by hash, ``pieces_per_task`` each on average,
so a task's memory is bounded and every sequence is made by one task.

Edge cases: a null or empty text is one piece with the end id; null ids stay
null; repeated rows are packed separately (``row`` tells them apart); an empty
table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm.cluster import release_memory
from ridemart.llm.tokens import encoded
from ridemart.session import ensure_checkpoint_dir


@dataclass(frozen=True)
class PackingConfig:
    capacity: int = 1024
    open_bins: int = 8192
    lookahead: int = 8192
    pieces_per_task: int = 1 << 17


PIECE_SCHEMA = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
_PACKED = "row long, doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


class BestFit:
    """Open bins by free space; ``place`` returns (bin, offset)."""

    def __init__(self, capacity: int, open_bins: int):
        self.capacity, self.open_bins = capacity, open_bins
        self.by_space: list[list[int]] = [[] for _ in range(capacity + 1)]
        self.bits = self.open = self.made = 0

    def _take(self, space: int) -> int:
        bins = self.by_space[space]
        chosen = bins.pop()
        if not bins:
            self.bits ^= 1 << space
        self.open -= 1
        return chosen

    def place(self, length: int) -> tuple[int, int]:
        fitting = self.bits >> length
        if fitting:
            space = length + (fitting & -fitting).bit_length() - 1
            chosen = self._take(space)
        else:
            if self.open >= self.open_bins:
                self._take((self.bits & -self.bits).bit_length() - 1)  # the fullest closes
            space, chosen = self.capacity, self.made
            self.made += 1
        left = space - length
        if left:
            self.by_space[left].append(chosen)
            self.bits |= 1 << left
            self.open += 1
        return chosen, self.capacity - space


def cut_pieces(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces: whole ones at the end, a shorter one first."""
    first = n_tokens % capacity or min(n_tokens, capacity)
    edges = [0, *range(first, n_tokens + 1, capacity)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def pieces(docs: DataFrame, vocabulary: str, end_id: int, capacity: int) -> DataFrame:
    """Every document's pieces (``PIECE_SCHEMA``); ``row`` numbers the documents."""

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids, rows = batch.column("doc_id").to_pylist(), batch.column("row").to_pylist()
            for a, some in encoded(batch.column("text"), vocabulary):
                out: list[list] = [[], [], [], [], [], []]
                for row, i, tokens in zip(rows[a:], ids[a:], some):
                    tokens += end
                    for k, (start, length) in enumerate(cut_pieces(len(tokens) // 4, capacity)):
                        for column, value in zip(out, (row, i, k, start, length, zlib.crc32(tokens[start * 4:(start + length) * 4]))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int32() if k == 2 else pa.int64()) for k, v in enumerate(out)],
                                                 names=[c.split()[0] for c in PIECE_SCHEMA.split(", ")])
        release_memory()

    return (docs.select(F.monotonically_increasing_id().alias("row"), F.col("doc_id").cast("long"), "text")
            .mapInArrow(encode, PIECE_SCHEMA))


def pack(items: DataFrame, cfg: PackingConfig | None = None) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows of ``PIECE_SCHEMA`` (lengths 1 to ``capacity``)."""
    cfg = cfg or PackingConfig()

    def best_fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins, base = BestFit(cfg.capacity, cfg.open_bins), TaskContext.get().partitionId() << 40
        buffer: list[pa.RecordBatch] = []

        def place(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            rows = rows.sort_by([("length", "descending"), ("row", "ascending"), ("piece", "ascending")])
            placed = [bins.place(n) for n in rows.column("length").to_pylist()]
            rows = rows.append_column("sequence_id", pa.array([base + b for b, _ in placed], pa.int64()))
            yield from rows.append_column("offset", pa.array([o for _, o in placed], pa.int64())).combine_chunks().to_batches()

        waiting = 0
        for batch in batches:
            for a in range(0, batch.num_rows, cfg.lookahead):
                buffer.append(batch.slice(a, cfg.lookahead))
                waiting += buffer[-1].num_rows
                if waiting >= cfg.lookahead:
                    table = pa.Table.from_batches(buffer)
                    yield from place(table.slice(0, cfg.lookahead))
                    buffer = table.slice(cfg.lookahead).to_batches()
                    waiting -= cfg.lookahead
        if waiting:
            yield from place(pa.Table.from_batches(buffer))

    tasks = max(1, -(-items.count() // cfg.pieces_per_task))
    return items.repartition(tasks, F.xxhash64("row", "piece")).mapInArrow(best_fit, _PACKED)


def pack_documents(docs: DataFrame, vocabulary: str, end_id: int, cfg: PackingConfig | None = None) -> DataFrame:
    """Pieces of all documents with their sequence and place in it."""
    cfg = cfg or PackingConfig()
    ensure_checkpoint_dir(docs.sparkSession)
    return pack(pieces(docs, vocabulary, end_id, cfg.capacity).checkpoint(), cfg)  # a slim row per piece


def sequences(docs: DataFrame, packed: DataFrame, vocabulary: str, end_id: int, capacity: int = 1024) -> DataFrame:
    """The packed ids: one row per sequence, ``ids`` as little-endian uint32 (at most ``capacity``).

    ``doc_id`` must be unique here, as it links the pieces to their texts.
    """
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        end = np.array([end_id], "<u4").tobytes()
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for a, some in encoded(batch.column("text"), vocabulary):
                out: tuple[list, list, list] = ([], [], [])
                for i, tokens in zip(ids[a:], some):
                    tokens += end
                    for k, (start, length) in enumerate(cut_pieces(len(tokens) // 4, capacity)):
                        for column, value in zip(out, (i, k, tokens[start * 4:(start + length) * 4])):
                            column.append(value)
                yield pa.RecordBatch.from_arrays([pa.array(out[0], pa.int64()), pa.array(out[1], pa.int32()), pa.array(out[2], pa.binary())], names=["doc_id", "piece", "ids"])

    parts = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, "doc_id long, piece int, ids binary")
    listed = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return (packed.join(parts, ["doc_id", "piece"]).groupBy("sequence_id").agg(listed.alias("parts"))
            .select("sequence_id", F.aggregate("parts", F.lit(b""), lambda all_, p: F.concat(all_, p["ids"])).alias("ids")))

"""Removal of byte strings that also stand in an earlier document, by suffix sorting of shards.

Which strings can repeat at all is found first: the smallest k-gram hash of
every window (a function of the window's bytes) is looked up among all chunks
(``exchange.py``), and only windows whose hash occurs in two documents go on.
Neighbouring ones with the same hash make a segment, and the hash decides the
segment's shard, so all copies of a window meet in one shard.  A hash whose
segments alone are more than a shard's bytes (a phrase between ever other
neighbours) is split: its windows go one by one, by their own hashes.

A shard joins its distinct segments, sorts their suffixes by external induced
sorting with common-prefix values (``induced_sort.py``), and takes the smallest
document of every run of suffixes that agree in ``length`` bytes.  Each segment
learns which of its windows also start in a smaller document.

Equal documents of a chunk, and equal segments of a chunk and of a shard, are
collapsed to the smallest document first, so groups of copies of any size cost
one entry per chunk.

Edge cases: a null text is empty; texts shorter than ``length`` are kept whole;
repeated rows of one id do not remove each other; null ids come after all
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import exchange as X
from ridemart.llm import store
from ridemart.llm import text as T
from ridemart.llm.cluster import drop_folder, shared_folder
from ridemart.llm.induced_sort import sorted_suffixes


@dataclass(frozen=True)
class SuffixConfig:
    length: int = 50
    gram: int = 20
    chunk_bytes: int = 8 << 20
    slice_bytes: int = 1 << 18
    bucket_keys: int = 2_000_000
    shard_text_bytes: int = 8 << 20
    #: Windows of one segment at most; longer ones are cut (each window stays in one piece).
    segment_windows: int = 2048
    sort_memory: int = 64 << 20


#: Bytes of a key's segments are told in these units.
WEIGHT_UNIT = 128
RESULT_SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans binary"


def _sliding_minima(values: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        values = np.minimum(values[:-have], values[have:])
        have *= 2
    return np.minimum(values[:len(values) - (width - have)], values[width - have:]) if width > have else values


def window_keys(data: np.ndarray, off: np.ndarray, cfg: SuffixConfig) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For every slice of rows: (window starts, keys, rows)."""
    codes = T._BYTE_CODES
    for a, b in T.slices(off, cfg.slice_bytes):
        low, high = int(off[a]), int(off[b])
        if high - low < cfg.length:
            continue
        part = data[low:high]
        sums = np.empty(len(part) + 1, np.uint64)
        sums[0] = 0
        np.cumsum(codes[part] * T.powers(len(part)), out=sums[1:])
        grams = (sums[cfg.gram:] - sums[:-cfg.gram]) * T.powers(len(part) - cfg.gram + 1, inverse=True)
        grams ^= grams >> np.uint64(29)
        grams *= np.uint64(0xBF58476D1CE4E5B9)
        grams ^= grams >> np.uint64(32)
        keys = _sliding_minima(grams, cfg.length - cfg.gram + 1)
        cut = off[a:b + 1] - low
        size = np.maximum(np.diff(cut) - cfg.length + 1, 0)
        stop = np.cumsum(size)
        starts = np.repeat(cut[:-1] - (stop - size), size) + np.arange(stop[-1])
        yield starts + low, keys[starts], np.repeat(np.arange(a, b), size)


def _runs(starts: np.ndarray, keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Places where a new run of neighbouring windows with one key begins."""
    head = np.ones(len(starts), bool)
    head[1:] = (keys[1:] != keys[:-1]) | (rows[1:] != rows[:-1])
    return np.flatnonzero(head)


def key_runs(data: np.ndarray, off: np.ndarray, cfg: SuffixConfig) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(first window, windows, short key, row) of all runs."""
    out: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]]
    for starts, keys, rows in window_keys(data, off, cfg):
        at = _runs(starts, keys, rows)
        for column, values in zip(out, (starts[at], np.diff(np.append(at, len(starts))), X.short_keys(T.mix(keys[at])), rows[at])):
            column.append(values)
    return tuple(np.concatenate(c) for c in out)


def _ids(table: pa.Table) -> np.ndarray:
    return table.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(False)


def _first_of_equals(keys: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every entry the entry with the same key and the smallest id (the first of ties)."""
    order = np.lexsort((ids, keys))
    head = np.ones(len(order), bool)
    head[1:] = keys[order][1:] != keys[order][:-1]
    out = np.empty(len(order), np.int64)
    if len(order):
        out[order] = order[head][np.cumsum(head) - 1]
    return out


def _hash_spans(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Fingerprints of byte spans in ascending order, a few megabytes of text at a time."""
    out, first = np.empty(len(starts), np.uint64), 0
    while first < len(starts):
        low = int(starts[first])
        last = max(first + 1, int(np.searchsorted(starts, low + (1 << 20))))
        mine = slice(first, last)
        part = data[low:int((starts[mine] + sizes[mine]).max())]
        out[mine] = T.mix(T.span_hashes(part, starts[mine] - low, starts[mine] + sizes[mine] - low) + sizes[mine].astype(np.uint64))
        first = last
    return out


def _prepared(table: pa.Table):
    data, off = T.flat(table.column("text"))
    ids = _ids(table)
    same = _first_of_equals(_hash_spans(data, off[:-1], np.diff(off)) if len(data) else np.zeros(len(ids), np.uint64), ids)
    for k in np.flatnonzero(same != np.arange(len(same))).tolist():
        if not np.array_equal(data[off[k]:off[k + 1]], data[off[same[k]]:off[same[k] + 1]]):
            same[k] = k  # equal hashes of different texts: it stands for itself
    return data, off, ids, same


def _ask_keys(cfg: SuffixConfig, n_buckets: int):
    def ask(table: pa.Table, chunk: str):
        data, off, ids, same = _prepared(table)
        starts, windows, keys, rows = key_runs(data, off, cfg)
        own = same[rows] == rows
        keys, rows = keys[own], rows[own]
        weight = _distinct_units(data, starts[own], windows[own] + cfg.length - 1, keys)
        order = np.lexsort((ids[rows], keys))
        keys, owner = keys[order], ids[rows][order]
        fresh = np.ones(len(keys), bool)
        fresh[1:] = (keys[1:] != keys[:-1]) | (owner[1:] != owner[:-1])
        unique, counts = np.unique(keys[fresh], return_counts=True)
        yield from X.bucket_requests(unique, [np.minimum(counts, 2).astype(np.uint8), weight], chunk, n_buckets)
    return ask


def _distinct_units(data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Bytes of the distinct segments of every key (in the keys' order), in units rounded up."""
    unique, back, runs = np.unique(keys, return_inverse=True, return_counts=True)
    counted = np.ones(len(keys), bool)
    several = np.flatnonzero(runs[back] > 1)
    prints = _hash_spans(data, starts[several], sizes[several])
    counted[several] = False
    counted[several[np.unique(prints, return_index=True)[1]]] = True
    total = np.bincount(back[counted], weights=sizes[counted], minlength=len(unique)).astype(np.int64)
    return np.minimum(-(-total // WEIGHT_UNIT), 0xFFFF).astype(np.uint16)


def _key_classes(cfg: SuffixConfig, join_bits):
    """Bits of every asked key: is it in two documents, and are its segments more than a shard's bytes?"""
    def reduce(requests: list[list[bytes]]) -> list[bytes]:
        keys = [X.unsqueeze_sorted(r[0]) for r in requests]
        counts = np.concatenate([X.unsqueeze(r[1], np.uint8) for r in requests])
        weights = np.concatenate([X.unsqueeze(r[2], np.uint16) for r in requests])
        _, back = np.unique(np.concatenate(keys), return_inverse=True)
        shared = np.bincount(back, weights=counts)[back] > 1
        hot = np.bincount(back, weights=weights)[back] * WEIGHT_UNIT > cfg.shard_text_bytes
        cuts = np.cumsum([len(k) for k in keys])[:-1]
        return [X.join_parts([join_bits(a), join_bits(b)]) for a, b in zip(np.split(shared, cuts), np.split(hot, cuts))]
    return reduce


def _ask_shards(cfg: SuffixConfig, n_shards: int, folder: str, find_bits):
    """A chunk's distinct segments, by shard, each with its smallest document."""
    def ask(chunk: str, payloads: list[bytes]) -> pa.Table:
        data, off, ids, same = _prepared(X.load_texts(chunk))
        starts, windows, keys, rows = key_runs(data, off, cfg)
        own = same[rows] == rows
        asked, back = np.unique(keys[own], return_inverse=True)
        answers = [X.split_parts(p) for p in payloads]
        shared, hot = (find_bits([a[k] for a in answers])[back] if len(asked) else np.zeros(0, bool) for k in range(2))
        starts, windows, keys, rows = (c[own][shared] for c in (starts, windows, keys, rows))
        # Long runs (one gram over and over) in pieces, those of a hot key window by window.
        most = np.where(hot[shared], 1, cfg.segment_windows)
        pieces = -(-windows // most)
        piece = np.arange(pieces.sum()) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        starts, rest, keys, rows, most, hot = (np.repeat(c, pieces) for c in (starts, windows, keys, rows, most, hot[shared]))
        starts, windows = starts + piece * most, np.minimum(rest - piece * most, most)
        sizes = windows + cfg.length - 1
        prints = _hash_spans(data, starts, sizes)
        first = _first_of_equals(prints, ids[rows])
        order = np.flatnonzero(first == np.arange(len(first)))  # the distinct ones
        shard = (np.where(hot, prints, keys)[order] % np.uint64(n_shards)).astype(np.int64)
        order = order[np.argsort(shard, kind="stable")]
        bounds = np.searchsorted(np.sort(shard), np.arange(n_shards + 1))
        place = np.empty(len(first), np.int64)
        place[order] = np.arange(len(order))
        side = store.write_file(folder, "segments", [X.join_parts([X.squeeze(c) for c in (np.diff(starts, prepend=0), windows.astype(np.uint16), rows.astype(np.uint32), place[first])])])
        out = [(X.CHUNK_ROW, chunk, side.encode())]
        for s in range(n_shards):
            mine = order[bounds[s]:bounds[s + 1]]
            if len(mine):
                stop = np.cumsum(sizes[mine])
                at = np.repeat(starts[mine] - (stop - sizes[mine]), sizes[mine]) + np.arange(stop[-1])
                out.append((s, chunk, X.join_parts([X.squeeze(windows[mine].astype(np.uint16)), X.squeeze(ids[rows[mine]]), X.squeeze(data[at])])))
        return pa.Table.from_batches([X.rows_batch(out)])
    return ask


def smallest_owners(text: np.ndarray, owner: np.ndarray, cfg: SuffixConfig) -> np.ndarray:
    """For every position the smallest owner among the suffixes that agree with it in ``length`` bytes.

    Positions whose ``length`` bytes hold a separator agree only among themselves.
    """
    out, top = owner.copy(), np.iinfo(owner.dtype).max
    open_positions: list[np.ndarray] = []
    open_least = top
    for positions, common in sorted_suffixes(text, cfg.length, cfg.sort_memory):
        head = np.flatnonzero(common < cfg.length)
        until = head[0] if len(head) else len(positions)
        if until:  # the block goes on with the open run
            open_positions.append(positions[:until].astype(np.uint32))
            open_least = min(open_least, int(owner[positions[:until]].min()))
        if not len(head):
            continue
        for p in open_positions:
            out[p] = open_least
        least = np.minimum.reduceat(owner[positions], head)
        out[positions[head[0]:]] = np.repeat(least, np.diff(np.append(head, len(positions))))
        open_positions, open_least = [positions[head[-1]:].astype(np.uint32)], int(least[-1])
    for p in open_positions:
        out[p] = open_least
    return out


def _sort_shard(cfg: SuffixConfig, join_bits):
    def reduce(requests: list[list[bytes]]) -> list[bytes]:
        windows = [X.unsqueeze(r[0], np.uint16).astype(np.int64) for r in requests]
        ids = np.concatenate([X.unsqueeze(r[1], np.int64) for r in requests])
        rank = np.unique(ids, return_inverse=True)[1].astype(np.int32)
        data = np.concatenate([X.unsqueeze(r[2], np.uint8) for r in requests])
        requests.clear()
        sizes = np.concatenate(windows) + cfg.length - 1
        starts = np.cumsum(sizes) - sizes
        first = _first_of_equals(_hash_spans(data, starts, sizes), rank)
        distinct = np.flatnonzero(first == np.arange(len(first)))
        # Distinct segments in a row, each byte raised by one, each followed by a separator.
        size = sizes[distinct] + 1
        stop = np.cumsum(size)
        begin = stop - size
        text = np.zeros(stop[-1], np.uint8)
        for a in range(0, len(distinct), 4096):
            mine = slice(a, a + 4096)
            body = size[mine] - 1
            ends = np.cumsum(body)
            within = np.arange(ends[-1]) - np.repeat(ends - body, body)
            text[np.repeat(begin[mine], body) + within] = data[np.repeat(starts[distinct[mine]], body) + within] + np.uint8(1)
        del data
        least = smallest_owners(text, np.repeat(rank[distinct], size), cfg)
        place = np.empty(len(first), np.int64)
        place[distinct] = begin
        out, at = [], 0
        for count in windows:
            mine = slice(at, at + len(count))
            ends = np.cumsum(count)
            within = np.arange(ends[-1]) - np.repeat(ends - count, count)
            out.append(join_bits(least[np.repeat(place[first[mine]], count) + within] < np.repeat(rank[mine], count)))
            at += len(count)
        return out
    return reduce


def _remove(cfg: SuffixConfig, find_bits, with_key: bool):
    def last(chunk: str, payloads: list[bytes]) -> pa.Table:
        table = X.load_texts(chunk)
        data, off, ids, same = _prepared(table)
        parts = X.split_parts(store.read_file(payloads[0].decode()))
        starts = np.cumsum(X.unsqueeze(parts[0], np.int64))
        windows, rows, place = X.unsqueeze(parts[1], np.uint16).astype(np.int64), X.unsqueeze(parts[2], np.uint32).astype(np.int64), X.unsqueeze(parts[3], np.int64)
        bits = find_bits(payloads[1:])
        covered = np.zeros(len(data) + 1, np.int32)
        if len(starts):
            # Bits come for the distinct segments in their order; every segment looks at its own or is later as a whole.
            distinct, at = np.unique(place, return_index=True)
            least = np.full(len(distinct), np.iinfo(np.int64).max)
            np.minimum.at(least, place, ids[rows])
            stop = np.cumsum(windows[at])
            begin = (stop - windows[at])[place]
            ends = np.cumsum(windows)
            within = np.arange(ends[-1]) - np.repeat(ends - windows, windows)
            gone = bits[np.repeat(begin, windows) + within] | np.repeat(ids[rows] > least[place], windows)
            first = (np.repeat(starts, windows) + within)[gone]
            np.add.at(covered, first, 1)
            np.add.at(covered, first + cfg.length, -1)
        covered = np.cumsum(covered[:-1], dtype=np.int32) > 0
        size = np.diff(off)
        for k in np.flatnonzero(same != np.arange(len(same))).tolist():
            mine = slice(off[k], off[k + 1])
            # An equal document with a smaller id has it all; rows of one id share their result.
            covered[mine] = size[k] >= cfg.length if ids[k] > ids[same[k]] else covered[off[same[k]]:off[same[k] + 1]]
        removed = np.concatenate([np.zeros(1, np.int32), np.cumsum(covered, dtype=np.int32)])
        digests, spans, keys = [], [], []
        for k in range(len(size)):
            mine = covered[off[k]:off[k + 1]]
            raw = data[off[k]:off[k + 1]]
            edges = np.flatnonzero(np.diff(np.concatenate([[0], mine.view(np.int8), [0]]))) if removed[off[k + 1]] > removed[off[k]] else np.zeros(0, np.int64)
            spans.append(edges.astype("<i8").tobytes())
            keys.append(hashlib.sha256(raw.tobytes()).hexdigest() if with_key and len(edges) else None)
            digests.append(hashlib.sha256((raw[~mine] if len(edges) else raw).tobytes()).hexdigest())
        out = pa.table({"doc_id": table.column("doc_id").combine_chunks(), "n_bytes": pa.array(size, pa.int64()),
                        "n_removed": pa.array((removed[off[1:]] - removed[off[:-1]]).astype(np.int64)), "n_spans": pa.array([len(s) // 16 for s in spans], pa.int64()),
                        "kept_sha256": pa.array(digests, pa.string()), "spans": pa.array(spans, pa.binary())})
        return out.append_column("text_sha256", pa.array(keys, pa.string())) if with_key else out
    return last


def remove_repeats(docs: DataFrame, cfg: SuffixConfig | None = None, with_key: bool = False) -> DataFrame:
    """One row per document (``RESULT_SCHEMA``); ``spans`` has the removed byte ranges, (begin, end) as int64.

    ``with_key``: also ``text_sha256``, the digest of the whole text where something is removed.
    """
    from ridemart.llm.recompression import join_bits, split_bits

    cfg = cfg or SuffixConfig()
    spark = docs.sparkSession
    folder = shared_folder(spark, "suffix-dedup")
    size = X.text_bytes(docs)
    n_buckets = max(1, -(-size // (16 * cfg.bucket_keys)))
    n_shards = max(1, -(-size // cfg.shard_text_bytes))
    first = X.write_requests(docs, folder, _ask_keys(cfg, n_buckets), cfg.chunk_bytes)
    known = X.chunk_rows(first)
    chunks = known.count()
    segments = X.finish(known.unionAll(X.answer(first, _key_classes(cfg, join_bits), n_buckets)), chunks, _ask_shards(cfg, n_shards, folder, split_bits), X.REQUEST_SCHEMA)
    answers = X.answer(segments, _sort_shard(cfg, join_bits), n_shards, pass_chunks=True)
    out = X.finish(answers, chunks, _remove(cfg, split_bits, with_key), RESULT_SCHEMA + (", text_sha256 string" if with_key else "")).checkpoint()
    drop_folder(spark, folder)
    return out


def cut_documents(docs: DataFrame, cfg: SuffixConfig | None = None) -> DataFrame:
    """The documents with the repeated ranges cut out of ``text`` (a character cut in two goes as a whole).

    All columns and rows stay; documents without any repeat are unchanged.  What
    is cut follows from a row's id and text, so these are the key.
    """
    found = (remove_repeats(docs, cfg, with_key=True).where("n_removed > 0").dropDuplicates(["doc_id", "text_sha256"])
             .select(F.col("doc_id").alias("_cut_id"), F.col("text_sha256").alias("_cut_text"), F.col("spans").alias("_cut_spans")))
    joined = (docs.join(found, docs["doc_id"].eqNullSafe(F.col("_cut_id")) & (F.sha2(docs["text"].cast("binary"), 256) == F.col("_cut_text")), "left")
              .drop("_cut_id", "_cut_text"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column("text").to_pylist()
            for k, spans in enumerate(batch.column("_cut_spans").to_pylist()):
                if spans:
                    raw, at, kept = texts[k].encode(), 0, []
                    for a, b in np.frombuffer(spans, "<i8").reshape(-1, 2).tolist():
                        kept.append(raw[at:a])
                        at = b
                    texts[k] = b"".join([*kept, raw[at:]]).decode(errors="ignore")
            columns = [pa.array(texts, pa.string()) if name == "text" else batch.column(name) for name in batch.schema.names if name != "_cut_spans"]
            yield pa.RecordBatch.from_arrays(columns, names=[n for n in batch.schema.names if n != "_cut_spans"])

    return joined.mapInArrow(cut, docs.schema)

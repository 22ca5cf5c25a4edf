"""Quality rules: hashed n-gram log-likelihood ratio, trusted target against raw corpus.

Two multinomials over hashed byte n-grams are counted: one over the whole
corpus, one over trusted documents.  A document's verdict is its mean
log-likelihood ratio per n-gram (length-normalised) against a fixed threshold,
for every document alike; a few plain measures come before it.

Edge cases: a null text counts as empty; an empty or very short text has no
n-gram and a ratio of 0; repeated rows get equal results; a null id is carried
through; no trusted document makes both models equal, so every ratio is 0;
an empty table gives an empty result.  Other columns are ignored (scores) or
passed on unchanged (filter), whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import text as T
from ridemart.llm.cluster import release_memory

_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True

SCORE_SCHEMA = ("doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, "
                "n_repeat_words long, base_failed boolean, llr double, kept boolean")


@dataclass(frozen=True)
class QualityConfig:
    """Parameters of the two models and of the verdict.

    ``trusted_sample`` bounds the trusted documents the target model is fitted
    on (smallest hashed ids first); corpus counts always cover every document.
    """

    gram: int = 4
    buckets: int = 1 << 16
    smoothing: float = 0.5
    threshold: float = -0.7
    trusted_sample: int = 50_000
    min_words: int = 50
    max_repeat_percent: int = 50
    slice_bytes: int = 1 << 21


def gram_buckets(data: np.ndarray, cfg: QualityConfig) -> np.ndarray:
    """Bucket of the byte n-gram at every start."""
    n = len(data) - cfg.gram + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    x = np.zeros(n, np.uint32)
    for k in range(cfg.gram):
        x *= np.uint32(2654435761)
        x += data[k:k + n]
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x85EBCA6B)
    x ^= x >> np.uint32(13)
    return (x % np.uint32(cfg.buckets)).astype(np.int64)


def _gram_ends(off: np.ndarray, cfg: QualityConfig) -> np.ndarray:
    return np.maximum(off[1:] - (cfg.gram - 1), off[:-1])


def _add_counts(total: np.ndarray, data: np.ndarray, off: np.ndarray, cfg: QualityConfig) -> None:
    """Count the n-grams that lie within one row."""
    grams = gram_buckets(data, cfg)
    inside = np.zeros(len(data) + 1, np.int32)
    np.add.at(inside, off[:-1], 1)
    np.add.at(inside, _gram_ends(off, cfg), -1)
    total += np.bincount(grams[np.cumsum(inside[:len(grams)]) > 0], minlength=cfg.buckets)


def count_grams(docs: DataFrame, trusted: np.ndarray, cfg: QualityConfig) -> np.ndarray:
    """(2, buckets) counts: all documents, trusted documents.

    Each task sums into one fixed-size row; two further sums bring the rows
    together, so nothing in flight exceeds tasks x buckets.
    """
    ids = np.sort(trusted)

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((2, cfg.buckets), np.int64)
        for batch in batches:
            data, off = T.flat(batch.column("text"))
            has_id = batch.column("doc_id").is_valid().to_numpy(False)
            wanted = batch.column("doc_id").fill_null(0).to_numpy(False)
            at = np.searchsorted(ids, wanted).clip(max=max(0, len(ids) - 1))
            good = (ids[at] == wanted) & has_id if len(ids) else np.zeros(len(wanted), bool)
            for a, b in T.slices(off, cfg.slice_bytes):
                part, cut = data[off[a]:off[b]], off[a:b + 1] - off[a]
                _add_counts(counts[0], part, cut, cfg)
                if good[a:b].any():
                    keep = np.repeat(good[a:b], np.diff(cut))
                    sizes = np.diff(cut)[good[a:b]]
                    _add_counts(counts[1], part[keep], np.concatenate([[0], np.cumsum(sizes)]), cfg)
        release_memory()
        yield pa.RecordBatch.from_pydict({"counts": pa.array([counts.tobytes()], pa.binary())})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(2 * cfg.buckets, np.int64)
        for batch in batches:
            for blob in batch.column("counts"):
                counts += np.frombuffer(blob.as_py(), np.int64)
        yield pa.RecordBatch.from_pydict({"counts": pa.array([counts.tobytes()], pa.binary())})

    parts = docs.select("doc_id", "text").mapInArrow(local, "counts binary")
    width = max(1, round(parts.rdd.getNumPartitions() ** 0.5))
    sums = parts.repartition(width).mapInArrow(add, "counts binary").coalesce(1).mapInArrow(add, "counts binary")
    rows = sums.collect()  # one row of fixed size
    total = np.zeros(2 * cfg.buckets, np.int64)
    for row in rows:
        total += np.frombuffer(row[0], np.int64)
    return total.reshape(2, cfg.buckets)


def fit(docs: DataFrame, labels: DataFrame, cfg: QualityConfig | None = None) -> np.ndarray:
    """Log-likelihood ratio of every bucket (``buckets`` doubles: a fixed size).

    Trusted: labelled of good quality and not toxic.
    """
    cfg = cfg or QualityConfig()
    chosen = (labels.where("quality = 1 and toxic = 0 and doc_id is not null").select("doc_id").distinct()
              .orderBy(F.xxhash64("doc_id"), "doc_id").limit(cfg.trusted_sample).toPandas())
    raw, target = count_grams(docs, chosen["doc_id"].to_numpy(np.int64), cfg) + cfg.smoothing
    if not len(chosen):
        return np.zeros(cfg.buckets)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def measure(data: np.ndarray, off: np.ndarray, ratios: np.ndarray, cfg: QualityConfig) -> dict[str, np.ndarray]:
    """Counts, ratio and verdict of every row of one slice."""
    n = len(off) - 1
    starts, ends, first = T.word_bounds(data, off)
    words = np.diff(first)

    def per_row(flags: np.ndarray) -> np.ndarray:
        sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
        return sums[off[1:]] - sums[off[:-1]]

    out = {"n_words": words,
           "word_chars": per_row(~T.SPACES[data] & ((data & 0xC0) != 0x80)),
           "n_symbols": per_row(_SYMBOLS[data])}

    # Lines: bounds at every newline and row edge, kept when a word begins in them.
    breaks = np.flatnonzero(data == 10)
    heads = np.concatenate([off[:-1], breaks + 1])
    row = np.concatenate([np.arange(n), np.searchsorted(off, breaks, "right") - 1])
    order = np.lexsort((heads, row))
    heads, row = heads[order], row[order]
    tails = np.empty(len(heads), np.int64)
    tails[:-1] = heads[1:] - 1
    tails[np.concatenate([np.flatnonzero(np.diff(row)), [len(row) - 1]]).astype(int)] = off[1:]
    filled = np.searchsorted(starts, tails) > np.searchsorted(starts, heads)
    heads, tails, row = heads[filled], tails[filled], row[filled]
    keys = T.mix(T.span_hashes(data, heads, tails) + T.mix((row * (1 << 32) + tails - heads).astype(np.uint64)))
    _, at = np.unique(keys, return_index=True)
    out["n_dup_lines"] = np.bincount(row, minlength=n) - np.bincount(row[at], minlength=n)

    # Words inside three-word windows that occur twice or more in their row.
    hashes = T.span_hashes(data, starts, ends)
    word_row = T.row_of(first)
    windows = T.gram_hashes(hashes, 3)
    inside = np.flatnonzero(word_row[:len(windows)] == word_row[2:]) if len(windows) else np.zeros(0, np.int64)
    keys = T.mix(windows[inside] + T.mix(word_row[inside].astype(np.uint64)))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    covered = np.zeros(len(hashes), bool)
    for k in range(3):
        covered[inside[twice] + k] = True
    out["n_repeat_words"] = np.bincount(word_row[covered], minlength=n)

    grams = gram_buckets(data, cfg)
    sums = np.concatenate([[0.0], np.cumsum(ratios[grams])])
    stop = _gram_ends(off, cfg).clip(max=len(grams))
    begin = np.minimum(off[:-1], stop)
    count = stop - begin
    out["llr"] = (sums[stop] - sums[begin]) / np.maximum(count, 1)
    out["base_failed"] = (words < cfg.min_words) | (100 * out["n_repeat_words"] > cfg.max_repeat_percent * words)
    out["kept"] = ~out["base_failed"] & (out["llr"] >= cfg.threshold)
    return out


def _measured(batch: pa.RecordBatch, ratios: np.ndarray, cfg: QualityConfig) -> dict[str, np.ndarray]:
    data, off = T.flat(batch.column("text"))
    parts = [measure(data[off[a]:off[b]], off[a:b + 1] - off[a], ratios, cfg)
             for a, b in T.slices(off, cfg.slice_bytes)]
    return {k: np.concatenate([p[k] for p in parts]) for k in parts[0]} if parts else {}


def score_documents(docs: DataFrame, ratios: np.ndarray, cfg: QualityConfig | None = None) -> DataFrame:
    """One row of measures and the verdict per document (``SCORE_SCHEMA``)."""
    cfg = cfg or QualityConfig()
    names = [c.split()[0] for c in SCORE_SCHEMA.split(", ")][1:]

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                got = _measured(batch, ratios, cfg)
                yield pa.RecordBatch.from_pydict({"doc_id": batch.column("doc_id")} | {k: pa.array(got[k]) for k in names})
        release_memory()

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(score, SCORE_SCHEMA)


def keep_documents(docs: DataFrame, ratios: np.ndarray, cfg: QualityConfig | None = None) -> DataFrame:
    """The rows that pass, all columns unchanged."""
    cfg = cfg or QualityConfig()

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield batch.filter(pa.array(_measured(batch, ratios, cfg)["kept"]))
        release_memory()

    return docs.mapInArrow(keep, docs.schema)

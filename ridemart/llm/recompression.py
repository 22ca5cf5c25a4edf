"""Removal of repeated word sequences by recompression.

Words get global names first, then rounds of run and pair naming shorten every
text.  A round splits all symbols at random into left and right; a maximal run
of one symbol, alone or as a left run with the right run after it, is a phrase,
and equal phrases get equal names.  Names are given by Spark: every chunk of
documents sends its distinct words (round 0) or phrases to buckets by hash, a
bucket compares them whole, numbers those that occur at more than one place in
the corpus and answers with number and count class (``exchange.py``).  So a
name stands for one sequence of words and for no other, everywhere.  What
occurs once gets no name, and what contains it is not asked about again.

Which symbols of a window are interior follows from the window's words alone:
at either end the first run is dropped (it may be longer outside) and then a
symbol that could pair with an outside one.  Equal windows therefore have the
same interior symbols, and a window with an unnamed interior symbol is unique:
the names reveal what can repeat.  Each window left is anchored at the rarest
of its interior symbols at the highest round that leaves it any.  The windows
of one anchor travel as one segment of words to the bucket of the anchor's
name, where windows are compared word name by word name and each one's first
occurrence is found.  Windows without interior symbols, or with an anchor that
is frequent in the whole corpus, travel one by one under a hash of their own.

Equal documents of a chunk are collapsed before, equal windows of a chunk are
sent once, so a passage in a third of all documents costs one entry per chunk.
Each round's requests are a written table; the one before goes then.

Edge cases: a null text has no words; texts shorter than a window keep all
words; repeated rows of one id count as later ones; null ids come after all
others; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from ridemart.llm import exchange as X
from ridemart.llm import store
from ridemart.llm import text as T
from ridemart.llm.cluster import drop_folder, shared_folder, written


@dataclass(frozen=True)
class RecompressionConfig:
    window: int = 20
    rounds: int = 3
    chunk_bytes: int = 8 << 20
    slice_bytes: int = 2 << 20
    slice_words: int = 1 << 17
    bucket_keys: int = 2_000_000
    #: Anchors that occur more than ``2**hot_class`` times do not gather their windows in one bucket.
    hot_class: int = 13


RESULT_SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string"


# --- rounds ----------------------------------------------------------------

def hash_columns(columns: list[np.ndarray]) -> np.ndarray:
    out = np.zeros(len(columns[0]), np.uint64)
    for c in columns:
        out = T.mix(out * np.uint64(0x9E3779B97F4A7C15) + c.astype(np.uint64) + np.uint64(1))
    return out


def distinct_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hashes in rising order, first place, index of every row) of the distinct rows; hashes only sort, values decide."""
    hashes = hash_columns(columns)
    unique, back = T.unique_hashes(hashes)
    first = np.empty(len(unique), np.int64)
    first[back[::-1]] = np.arange(len(hashes))[::-1]
    if all((c == c[first[back]]).all() for c in columns):
        return unique, first, back
    _, first, back = np.unique(np.column_stack(columns), axis=0, return_index=True, return_inverse=True)
    order = np.argsort(hashes[first], kind="stable")
    place = np.empty(len(order), np.int64)
    place[order] = np.arange(len(order))
    return hashes[first[order]], first[order], place[back.ravel()]


@dataclass
class Phrases:
    """One round's parse of a sequence of symbols (0: without a name)."""
    run_at: np.ndarray       # first symbol of every run
    right: np.ndarray        # side of every run
    at: np.ndarray           # first run of every phrase
    parts: list[np.ndarray]  # symbol and length of the phrase's first and second run
    plain: np.ndarray        # a single symbol, which keeps its name
    dead: np.ndarray         # a phrase around a symbol without a name

    @property
    def asked(self) -> np.ndarray:
        return ~self.plain & ~self.dead


def parse(symbols: np.ndarray, row: np.ndarray, round_: int) -> Phrases:
    head = np.ones(len(symbols), bool)
    head[1:] = (symbols[1:] != symbols[:-1]) | (row[1:] != row[:-1]) | (symbols[1:] == 0)
    run_at = np.flatnonzero(head)
    size = np.diff(np.append(run_at, len(symbols))).astype(np.uint64)
    runs, run_row = symbols[run_at], row[run_at]
    right = (T.mix(runs ^ T.mix(size + np.uint64(round_ << 32))) & np.uint64(1)).astype(bool)
    joins = np.zeros(len(runs), bool)
    joins[:-1] = ~right[:-1] & right[1:] & (run_row[:-1] == run_row[1:])
    second = np.zeros(len(runs), bool)
    second[1:] = joins[:-1]
    at = np.flatnonzero(~second)
    pair = joins[at]
    other = np.minimum(at + 1, len(runs) - 1)
    parts = [runs[at], size[at], np.where(pair, runs[other], np.uint64(0)), np.where(pair, size[other], np.uint64(0))]
    return Phrases(run_at, right, at, parts, ~pair & (size[at] == 1), (parts[0] == 0) | (pair & (parts[2] == 0)))


def local_names(round_: int, phrases: Phrases, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Names of a sequence on its own: fingerprints of the parts, all of one count class."""
    names = np.where(phrases.plain, phrases.parts[0], hash_columns(phrases.parts) | np.uint64(1))
    return names, np.zeros(len(names), np.uint8)


def _range_minima(values: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Place of the smallest value in every non-empty range (the first of equals)."""
    levels = [np.arange(len(values))]
    width = int((high - low).max())
    while 1 << len(levels) <= width:
        half = 1 << (len(levels) - 1)
        last = levels[-1]
        a, b = last[:-half], last[half:]
        levels.append(np.where(values[a] <= values[b], a, b))
    power = np.floor(np.log2(high - low)).astype(np.int64)
    out = np.empty(len(low), np.int64)
    for k, level in enumerate(levels):
        mine = np.flatnonzero(power == k)
        a, b = level[low[mine]], level[high[mine] - (1 << k)]
        out[mine] = np.where(values[a] <= values[b], a, b)
    return out


def _without_unnamed(symbols: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    unnamed = np.concatenate([[0], np.cumsum(symbols == 0)])
    return unnamed[high] == unnamed[low]


def window_keys(words: np.ndarray, first: np.ndarray, cfg: RecompressionConfig, names=local_names,
                classes: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, keys, anchors) of the windows that can repeat; equal windows have equal keys.

    ``names(round, phrases, classes before it)`` gives the symbols of a round and their count classes;
    it is asked for every round, also when no window is left.
    """
    row = T.row_of(first)
    count = len(words) - cfg.window + 1
    starts = np.flatnonzero(row[:count] == row[cfg.window - 1:]) if count > 0 else np.zeros(0, np.int64)
    starts = starts[_without_unnamed(words, starts, starts + cfg.window)]
    # Windows that their ends eat up at once (few distinct words), or with frequent anchors only, are keyed by their words.
    own = T.gram_hashes(words, cfg.window)[starts] if len(starts) else np.zeros(0, np.uint64)
    keys, anchors, possible = own.copy(), starts.copy(), np.ones(len(starts), bool)
    low, high, alive = starts, starts + cfg.window, np.arange(len(starts))
    symbols, origin = words, np.arange(len(words))
    classes = np.zeros(len(words), np.uint8) if classes is None else classes
    for round_ in range(cfg.rounds):
        phrases = parse(symbols, row, round_)
        run_of = np.repeat(np.arange(len(phrases.run_at)), np.diff(np.append(phrases.run_at, len(symbols))))
        low, high = run_of[low] + 1, run_of[high - 1]
        good = low < high
        low, high, alive = low[good], high[good], alive[good]
        low = low + phrases.right[low]
        high = high - ~phrases.right[high - 1]
        phrase_of = np.cumsum(np.bincount(phrases.at, minlength=len(phrases.run_at))) - 1
        good = low < high
        low, high, alive = phrase_of[low[good]], phrase_of[high[good] - 1] + 1, alive[good]
        symbols, classes = names(round_, phrases, classes)
        place = phrases.run_at[phrases.at]
        row, origin = row[place], origin[place]
        good = _without_unnamed(symbols, low, high)
        possible[alive[~good]] = False
        low, high, alive = low[good], high[good], alive[good]
        if not len(alive):
            continue
        best = _range_minima((classes.astype(np.uint64) << np.uint64(56)) | (T.mix(symbols) >> np.uint64(8)), low, high)
        hot = classes[best] > cfg.hot_class
        keys[alive] = np.where(hot, own[alive], T.mix(symbols[best]))
        anchors[alive] = np.where(hot, starts[alive], origin[best] + len(words) * (round_ + 1))
    return starts[possible], keys[possible], anchors[possible]


def distinct_windows(words: np.ndarray, starts: np.ndarray, window: int, precedence: tuple) -> tuple[np.ndarray, np.ndarray]:
    """(first of the equal windows by ``precedence``, last key foremost; index of every window), compared word by word."""
    prints = T.gram_hashes(words, window)[starts] if len(starts) else np.zeros(0, np.uint64)
    for exact in (False, True):
        order = np.lexsort((*precedence, prints))
        ordered = prints[order]
        head = np.ones(len(order), bool)
        head[1:] = ordered[1:] != ordered[:-1]
        index = np.empty(len(order), np.int64)
        index[order] = np.cumsum(head) - 1
        same = starts[order[head]][index]
        if exact or all((words[starts + j] == words[same + j]).all() for j in range(window)):
            break
        rows = np.column_stack([words[starts + j] for j in range(window)])
        prints = np.unique(rows, axis=0, return_inverse=True)[1].ravel().astype(np.uint64)
    return order[head], index


# --- chunks ----------------------------------------------------------------

def _document_order(table: pa.Table) -> np.ndarray:
    """Rank of every row by (doc_id, row), null ids last."""
    ids = table.column("doc_id").combine_chunks()
    known = ids.is_valid().to_numpy(False)
    by = np.lexsort((np.arange(len(ids)), ids.fill_null(0).to_numpy(False), ~known))
    rank = np.empty(len(by), np.int64)
    rank[by] = np.arange(len(by))
    return rank


def dictionary(table: pa.Table, cfg: RecompressionConfig) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """(index of every word in the dictionary, the distinct words, first word of every row) of a chunk."""
    data, off = T.flat(table.column("text"))
    bounds, firsts = [(np.zeros(0, np.int64), np.zeros(0, np.int64))], [np.zeros(1, np.int64)]
    for a, b in T.slices(off, cfg.slice_bytes):
        starts, ends, first = T.word_bounds(data[off[a]:off[b]], off[a:b + 1] - off[a])
        bounds.append((starts + off[a], ends + off[a]))
        firsts.append(first[1:] + firsts[-1][-1])
    (starts, ends), first = map(np.concatenate, zip(*bounds)), np.concatenate(firsts)
    bounds = np.full(2 * len(starts) + 1, len(data), np.int64)  # words and the gaps behind them
    bounds[:-1:2], bounds[1::2] = starts, ends
    both = pa.LargeBinaryArray.from_buffers(pa.large_binary(), 2 * len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(np.ascontiguousarray(data))])
    coded = both.take(pa.array(np.arange(0, 2 * len(starts), 2))).dictionary_encode()
    return coded.indices.to_numpy(False).astype(np.int64), coded.dictionary, first


def representatives(words: np.ndarray, first: np.ndarray, order: np.ndarray) -> np.ndarray:
    """For every row, the earliest row (by ``order``) with the same words; rows whose words only hash alike stay apart."""
    n = np.diff(first)
    within = np.arange(len(words)) - np.repeat(first[:-1], n)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(hash_columns([words, within]))])
    key = T.mix(sums[first[1:]] - sums[first[:-1]] + T.mix(n.astype(np.uint64)))
    by = np.lexsort((order, key))
    head = np.ones(len(by), bool)
    head[1:] = key[by][1:] != key[by][:-1]
    out = np.empty(len(by), np.int64)
    out[by] = by[head][np.cumsum(head) - 1] if len(by) else by
    for k in np.flatnonzero(out != np.arange(len(out))).tolist():
        if not np.array_equal(words[first[k]:first[k + 1]], words[first[out[k]]:first[out[k] + 1]]):
            out[k] = k
    return out


def _flat_words(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, lengths) of a binary array."""
    _, offsets, data = words.buffers()
    off = np.frombuffer(offsets, np.int64)[words.offset:words.offset + len(words) + 1]
    return (np.frombuffer(data, np.uint8)[off[0]:off[-1]] if data is not None and len(words) else np.zeros(0, np.uint8)), np.diff(off)


def _keep_chunk(cfg: RecompressionConfig):
    """Keep a chunk's texts and its words as places in its dictionary; documents equal to an earlier one, and short ones, are left out."""
    def save(folder: str, table: pa.Table):
        index, words, first = dictionary(table, cfg)
        n = np.diff(first)
        same = representatives(index, first, _document_order(table))
        own = (same == np.arange(len(same))) & (n >= cfg.window)
        index = index[np.repeat(own, n)]
        counts = np.bincount(index, minlength=len(words))
        used = np.flatnonzero(counts)
        data, lengths = _flat_words(words.take(pa.array(used)))
        ends = np.cumsum(lengths)
        hashes = T.span_hashes(data, ends - lengths, ends)
        order = np.argsort(hashes, kind="stable")
        place = np.zeros(len(words), np.int64)
        place[used[order]] = np.arange(len(order))
        state = store.write_file(folder, "words", [X.join_parts([X.squeeze(place[index].astype(np.uint32)), X.squeeze(n), X.squeeze(same)])])
        return f"{X.save_texts(folder, table)}|{state}", (hashes[order], counts[used[order]], words.take(pa.array(used[order])))
    return save


def _sections(hashes: np.ndarray, n_buckets: int) -> Iterator[tuple[int, int, int]]:
    """(bucket, first, last) of sorted hashes."""
    cuts = X.bucket_cuts(hashes, n_buckets, bits=64)
    yield from ((k, int(a), int(b)) for k, (a, b) in enumerate(zip(cuts, cuts[1:])) if b > a)


def _ask_words(n_buckets: int):
    def ask(what, chunk: str):
        hashes, counts, words = what
        for k, a, b in _sections(hashes, n_buckets):
            data, lengths = _flat_words(words.slice(a, b - a))
            yield k, chunk, X.join_parts([X.squeeze(counts[a:b].astype(np.uint32)), X.squeeze(lengths.astype(np.uint32)), X.squeeze(data)])
    return ask


def _ask_phrases(symbols: np.ndarray, row: np.ndarray, round_: int, chunk: str, n_buckets: int) -> Iterator[tuple]:
    phrases = parse(symbols, row, round_)
    columns = [p[phrases.asked] for p in phrases.parts]
    hashes, first, back = distinct_rows(columns)
    counts = np.bincount(back, minlength=len(first)).astype(np.uint32)
    columns = [c[first] for c in columns]
    for k, a, b in _sections(hashes, n_buckets):
        yield k, chunk, X.join_parts([X.squeeze(counts[a:b]), *(X.squeeze(c[a:b]) for c in columns)])


# --- buckets ---------------------------------------------------------------

def _number(back: np.ndarray, counts: list[np.ndarray]) -> list[bytes]:
    """Per request (number, count class) of everything asked, 0 for what occurs once; frequent ones get small numbers."""
    total = np.bincount(back, weights=np.concatenate(counts)).astype(np.int64)
    number = np.empty(len(total), np.uint32)
    number[np.argsort(-total, kind="stable")] = np.arange(1, len(total) + 1, dtype=np.uint32)
    number[total < 2] = 0
    classes = np.ceil(np.log2(np.maximum(total, 1))).astype(np.uint8)
    cuts = np.cumsum([len(c) for c in counts])[:-1]
    return [X.join_parts([X.squeeze(a), X.squeeze(b)]) for a, b in zip(np.split(number[back], cuts), np.split(classes[back], cuts))]


def _name_words(requests: list[list[bytes]]) -> list[bytes]:
    lengths = np.concatenate([X.unsqueeze(r[1], np.uint32) for r in requests]).astype(np.int64)
    data = np.concatenate([X.unsqueeze(r[2], np.uint8) for r in requests])
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(lengths), [None, pa.py_buffer(offsets), pa.py_buffer(data)])
    return _number(words.dictionary_encode().indices.to_numpy(False), [X.unsqueeze(r[0], np.uint32) for r in requests])


def _name_phrases(requests: list[list[bytes]]) -> list[bytes]:
    columns = [np.concatenate([X.unsqueeze(r[k], np.uint64) for r in requests]) for k in range(1, 5)]
    return _number(distinct_rows(columns)[2], [X.unsqueeze(r[0], np.uint32) for r in requests])


def _not_first(cfg: RecompressionConfig):
    """Bits: does the window start earlier in another chunk?  Requests come in chunk order, which breaks ties of repeated ids."""
    def reduce(requests: list[list[bytes]]) -> list[bytes]:
        sizes = [X.unsqueeze(r[0], np.uint32).astype(np.int64) for r in requests]
        size = np.concatenate(sizes)
        ids = np.repeat(np.concatenate([X.unsqueeze(r[1], np.int64) for r in requests]), size)
        words = np.concatenate([X.unsqueeze(r[2], np.uint64) for r in requests])
        starts = _expand(np.cumsum(size + cfg.window - 1) - (size + cfg.window - 1), size)
        firsts, _ = distinct_windows(words, starts, cfg.window, (np.arange(len(starts)), ids))
        later = np.ones(len(starts), bool)
        later[firsts] = False
        return [join_bits(b) for b in np.split(later, np.cumsum([s.sum() for s in sizes])[:-1])]
    return reduce


def _expand(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for every (start, size)."""
    return np.repeat(starts, sizes) + np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def join_bits(bits: np.ndarray) -> bytes:
    return X.join_parts([np.array([len(bits)], "<u8").tobytes(), X.squeeze(np.packbits(bits))])


def split_bits(payloads: list[bytes]) -> np.ndarray:
    out = [np.zeros(0, bool)]
    for p in payloads:
        n, packed = X.split_parts(p)
        out.append(np.unpackbits(X.unsqueeze(packed, np.uint8), count=int.from_bytes(n, "little")).astype(bool))
    return np.concatenate(out)


# --- steps of a chunk ------------------------------------------------------

def _state(chunk: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(place of every kept word in the chunk's dictionary, words per row, representative rows)."""
    index, n, same = X.split_parts(store.read_file(chunk.split("|")[1]))
    return X.unsqueeze(index, np.uint32), X.unsqueeze(n, np.int64), X.unsqueeze(same, np.int64)


def _own_rows(n: np.ndarray, same: np.ndarray, cfg: RecompressionConfig) -> np.ndarray:
    return np.flatnonzero((same == np.arange(len(same))) & (n >= cfg.window))


def _answers(pairs: list[tuple[int, bytes]], level: int, cfg: RecompressionConfig, n_buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(global names, count classes) in the order asked; names of different rounds differ."""
    names, classes = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint8)]
    for bucket, payload in pairs:
        number, count_class = X.split_parts(payload)
        number = X.unsqueeze(number, np.uint32).astype(np.uint64)
        name = (number * np.uint64(n_buckets) + np.uint64(bucket)) * np.uint64(cfg.rounds + 1) + np.uint64(level)
        names.append(np.where(number > 0, name, np.uint64(0)))
        classes.append(X.unsqueeze(count_class, np.uint8))
    return np.concatenate(names), np.concatenate(classes)


def _write_names(folder: str, names: np.ndarray, classes: np.ndarray) -> str:
    return store.write_file(folder, "names", [X.join_parts([X.squeeze(names), X.squeeze(classes)])])


def _read_names(uri: str) -> tuple[np.ndarray, np.ndarray]:
    names, classes = X.split_parts(store.read_file(uri))
    return X.unsqueeze(names, np.uint64), X.unsqueeze(classes, np.uint8)


def _named(phrases: Phrases, before: np.ndarray, names: np.ndarray, classes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Symbols and count classes of a round from the classes before it and what was answered for each phrase asked about."""
    symbols = np.where(phrases.plain, phrases.parts[0], np.uint64(0))
    out = np.where(phrases.plain, before[phrases.run_at[phrases.at]], np.uint8(0))
    asked = phrases.asked
    symbols[asked], out[asked] = names, classes
    return symbols, out


def _symbols(index: np.ndarray, sizes: np.ndarray, files: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(symbols, count classes, row of each) after the rounds whose answers are kept in ``files``."""
    names, classes = _read_names(files[0])
    symbols, classes, row = names[index], classes[index], np.repeat(np.arange(len(sizes)), sizes)
    for round_, file in enumerate(files[1:]):
        phrases = parse(symbols, row, round_)
        symbols, classes = _named(phrases, classes, *_read_names(file))
        row = row[phrases.run_at[phrases.at]]
    return symbols, classes, row


def _step(cfg: RecompressionConfig, folder: str, n_buckets: int, level: int):
    """Keep the answers of a round and ask for the next round's names, or, after the last, for the windows.

    Only the answers are kept; a chunk's symbols follow from them and its words.
    """
    def step(chunk: str, pairs: list[tuple[int, bytes]]) -> pa.Table:
        files = pairs.pop(0)[1].decode().split("\n") if pairs and pairs[0][0] == X.CHUNK_ROW else []
        names, classes = _answers(pairs, level, cfg, n_buckets)
        index, n, same = _state(chunk)
        sizes = n[_own_rows(n, same, cfg)]
        if level:
            symbols, old, row = _symbols(index, sizes, files)
            phrases = parse(symbols, row, level - 1)
            back = distinct_rows([p[phrases.asked] for p in phrases.parts])[2]
            names, classes = names[back], classes[back]
            symbols, row = _named(phrases, old, names, classes)[0], row[phrases.run_at[phrases.at]]
        else:
            symbols, row = names[index], np.repeat(np.arange(len(sizes)), sizes)
        files.append(_write_names(folder, names, classes))
        if level < cfg.rounds:
            rows = [(X.CHUNK_ROW, chunk, "\n".join(files).encode()), *_ask_phrases(symbols, row, level, chunk, n_buckets)]
        else:
            del symbols, row, index, names, classes
            rows = _ask_windows(cfg, folder, chunk, files, n_buckets)
        return pa.Table.from_batches([X.rows_batch(rows)])
    return step


def _candidates(index: np.ndarray, first: np.ndarray, files: list[str], cfg: RecompressionConfig) -> tuple[np.ndarray, ...]:
    """(words, and ``window_keys`` of them) of a chunk, found for a slice of its documents at a time.

    A document's symbols do not depend on its neighbours, so a slice takes the
    next of each round's answers.
    """
    named, classes = _read_names(files[0])
    words, classes = named[index], classes[index]
    rounds, at = [_read_names(f) for f in files[1:]], [0] * (len(files) - 1)

    def names(round_: int, phrases: Phrases, before: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        mine = slice(at[round_], at[round_] + int(phrases.asked.sum()))
        at[round_] = mine.stop
        return _named(phrases, before, *(c[mine] for c in rounds[round_]))

    found = [(np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64))]
    for a, b in T.slices(first, cfg.slice_words):
        low, high = int(first[a]), int(first[b])
        starts, keys, anchors = window_keys(words[low:high], first[a:b + 1] - low, cfg, names, classes[low:high])
        found.append((starts + low, keys, anchors % (high - low) + low + anchors // (high - low) * len(words)))
    return words, *map(np.concatenate, zip(*found))


def _ask_windows(cfg: RecompressionConfig, folder: str, chunk: str, files: list[str], n_buckets: int) -> list[tuple]:
    """A chunk's distinct candidate windows as segments of words, with their first document, by the anchor's name."""
    index, n, same = _state(chunk)
    own = _own_rows(n, same, cfg)
    first = np.concatenate([[0], np.cumsum(n[own])])
    words, starts, keys, anchors = _candidates(index, first, files, cfg)
    del index
    table = X.load_texts(chunk.split("|")[0]).select(["doc_id"])
    rank = _document_order(table)[own[np.searchsorted(first, starts, "right") - 1] if len(starts) else starts]
    firsts = [np.zeros(0, np.int64)]
    for part in range(4):  # equal windows have equal keys
        mine = np.flatnonzero(keys >> np.uint64(62) == part)
        firsts.append(mine[distinct_windows(words, starts[mine], cfg.window, (starts[mine], rank[mine]))[0]])
    del rank
    firsts = np.concatenate(firsts)
    gone = np.ones(len(starts), bool)
    gone[firsts] = False
    firsts.sort()
    at, anchors = starts[firsts], anchors[firsts]
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (anchors[1:] != anchors[:-1])
    begin = np.flatnonzero(head)
    size = np.diff(np.append(begin, len(at)))
    hashes = keys[firsts][begin]
    order = np.argsort(hashes, kind="stable")
    hashes, begin, size = hashes[order], at[begin[order]], size[order]
    ids = table.column("doc_id").combine_chunks().fill_null(np.iinfo(np.int64).max).to_numpy(False)
    ids = ids[own[np.searchsorted(first, begin, "right") - 1]] if len(begin) else begin
    side = store.write_file(folder, "windows", [X.join_parts([X.squeeze(c) for c in (begin, size, np.diff(starts[gone], prepend=0))])])
    rows = [(X.CHUNK_ROW, chunk, side.encode())]
    for k, a, b in _sections(hashes, n_buckets):
        segment = words[_expand(begin[a:b], size[a:b] + cfg.window - 1)]
        rows.append((k, chunk, X.join_parts([X.squeeze(size[a:b].astype(np.uint32)), X.squeeze(ids[a:b]), X.squeeze(segment)])))
    return rows


def _remove(cfg: RecompressionConfig, with_text: bool):
    def last(chunk: str, payloads: list[bytes]) -> pa.Table:
        begin, size, gone = (X.unsqueeze(p, np.int64) for p in X.split_parts(store.read_file(payloads[0].decode())))
        _, n, same = _state(chunk)
        own = _own_rows(n, same, cfg)
        table = X.load_texts(chunk.split("|")[0])
        first = np.concatenate([[0], np.cumsum(n)])
        edge = np.zeros(int(n[own].sum()) + 1, np.int32)
        for starts in (np.cumsum(gone), _expand(begin, size)[split_bits(payloads[1:])]):
            np.add.at(edge, starts, 1)
            np.add.at(edge, starts + cfg.window, -1)
        covered = np.zeros(int(n.sum()), bool)
        covered[_expand(first[own], n[own])] = np.cumsum(edge[:-1]) > 0
        for k in np.flatnonzero((same != np.arange(len(same))) & (n >= cfg.window)).tolist():
            covered[first[k]:first[k + 1]] = True  # all of it stands in the earlier equal document
        removed = np.concatenate([[0], np.cumsum(covered)])
        kept, digests = [], []
        for k, text in enumerate(table.column("text").to_pylist()):
            mine = (text or "").encode().split()
            if removed[first[k + 1]] > removed[first[k]]:
                mine = compress(mine, (~covered[first[k]:first[k + 1]]).tolist())
            raw = b" ".join(mine)
            digests.append(hashlib.sha256(raw).hexdigest())
            if with_text:
                kept.append(raw.decode())
        out = {"doc_id": table.column("doc_id").combine_chunks(), "n_words": pa.array(n, pa.int64()),
               "n_removed": pa.array(removed[first[1:]] - removed[first[:-1]], pa.int64()), "kept_sha256": pa.array(digests, pa.string())}
        return pa.table(out | ({"kept": pa.array(kept, pa.string())} if with_text else {}))
    return last


def remove_repeats(docs: DataFrame, cfg: RecompressionConfig | None = None, with_text: bool = False) -> DataFrame:
    """One row per document (``RESULT_SCHEMA``; ``kept`` holds the remaining words if ``with_text``)."""
    cfg = cfg or RecompressionConfig()
    spark = docs.sparkSession
    folder = shared_folder(spark, "recompression")
    n_buckets = max(1, -(-X.text_bytes(docs) // (12 * cfg.bucket_keys)))
    asked, table = X.write_requests(docs, folder, _ask_words(n_buckets), cfg.chunk_bytes, _keep_chunk(cfg)), "requests"
    chunks = X.chunk_rows(asked).count()
    for level in range(cfg.rounds + 1):
        rows = X.chunk_rows(asked).unionAll(X.answer(asked, _name_phrases if level else _name_words, n_buckets))
        step = X.finish(rows, chunks, _step(cfg, folder, n_buckets, level), X.REQUEST_SCHEMA, with_buckets=True)
        asked, before, table = written(step, folder, f"round{level}"), table, f"round{level}"
        drop_folder(spark, f"{folder}/{before}")
    rows = X.chunk_rows(asked).unionAll(X.answer(asked, _not_first(cfg), n_buckets))
    schema = RESULT_SCHEMA + (", kept string" if with_text else "")
    out = X.finish(rows, chunks, _remove(cfg, with_text), schema).checkpoint()
    drop_folder(spark, folder)
    return out

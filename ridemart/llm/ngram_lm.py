"""N-gram language model: a sharded Elias-Fano trie with quantised, smoothed probabilities.

Model: interpolated absolute discounting; order 1 is add-0.1 over all training
tokens with one extra unknown type.  For a context h,

    p(w | h) = alpha(h w) + lambda(h) * p(w | shorter h),   alpha = (c(h w) - D) / c(h),

where lambda takes what the (quantised) alphas leave, so that no context gives
out more than one; an unseen context passes everything on.

D is one number per order, from the counts of counts over the whole corpus, so a
score does not depend on how the corpus is cut into chunks and buckets.

Training and scoring are two key exchanges (``exchange.py``).  In the first,
words get dense ids and training counts.  In the second, each chunk sends its
distinct n-grams with training counts, routed by their context; a bucket adds
them up, builds its trie, writes it to the model folder, maps it into memory
and answers every n-gram by walking the trie, level by level, with a successor
search relative to the context.  All of a context is in one bucket, and an
n-gram is sent once per chunk however often it occurs.  No table of words or
n-grams is ever held whole by one process; the model grows with the corpus.

``train`` keeps a model (words and trie shards by bucket, with tables that name
them) and ``score`` scores any other table with it: the table's words and
n-grams go to the buckets of the model, which only look them up.

Edge cases: a null text is empty and scores its end token alone; a null id
counts as the empty text for the split; repeated rows count each; an empty
training set makes every word unknown; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import tempfile
import zlib
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import exchange as X
from ridemart.llm import store
from ridemart.llm import text as T
from ridemart.llm.cluster import drop_folder, shared_folder, written
from ridemart.llm.elias_fano import Level, from_buffer, to_bytes


@dataclass(frozen=True)
class LmConfig:
    order: int = 3
    add: float = 0.1
    code_bits: int = 12
    log2_range: float = 40.0
    folds: int = 10
    chunk_bytes: int = 8 << 20
    slice_bytes: int = 2 << 20
    bucket_grams: int = 2_000_000


RESULT_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
#: Hash of the end token; no word has it but by a 64-bit coincidence.
END = np.uint64(0xE5D0C0DE5EED0001)


# --- quantised codes -------------------------------------------------------

def encode_probability(p: np.ndarray, cfg: LmConfig) -> np.ndarray:
    """Codes on a logarithmic scale, rounded down; 0 stands for nothing."""
    top = (1 << cfg.code_bits) - 1
    with np.errstate(divide="ignore"):
        code = np.floor((np.log2(np.minimum(p, 1.0)) + cfg.log2_range) * (top / cfg.log2_range) + 1e-9)
    return np.maximum(code, 0).astype(np.uint16)


def decode_table(cfg: LmConfig) -> np.ndarray:
    top = (1 << cfg.code_bits) - 1
    table = np.exp2(np.arange(top + 1) * (cfg.log2_range / top) - cfg.log2_range)
    table[0] = 0.0
    return table


# --- chunks ----------------------------------------------------------------

def held_out(ids: list, folds: int) -> np.ndarray:
    return np.array([zlib.crc32(b"" if i is None else str(i).encode()) % folds == 0 for i in ids], bool)


def _tokens(table: pa.Table, cfg: LmConfig) -> tuple[np.ndarray, np.ndarray]:
    """(token hashes with an end after every row, first token of every row)."""
    data, off = T.flat(table.column("text"))
    hashes, firsts = [np.zeros(0, np.uint64)], [np.zeros(1, np.int64)]
    for a, b in T.slices(off, cfg.slice_bytes):
        part = data[off[a]:off[b]]
        starts, ends, first = T.word_bounds(part, off[a:b + 1] - off[a])
        hashes.append(np.insert(T.span_hashes(part, starts, ends, lower=True), first[1:], END))
        firsts.append(first[1:] + np.arange(1, b - a + 1) + firsts[-1][-1])
    return np.concatenate(hashes), np.concatenate(firsts)


def _save(cfg: LmConfig):
    """A chunk's file: word numbers (by hash order) of all tokens, row bounds, ids and folds; its words go along once."""
    def save(folder: str, table: pa.Table) -> tuple[str, np.ndarray]:
        hashes, first = _tokens(table, cfg)
        words, number = T.unique_hashes(hashes)
        ids = table.column("doc_id").combine_chunks()
        out = held_out(ids.to_pylist(), cfg.folds)
        known = ids.is_valid().to_numpy(False)
        parts = [np.array([len(words)], "<u8").tobytes(), X.squeeze(number.astype(np.uint32)), X.squeeze(first), X.squeeze(ids.fill_null(0).to_numpy(False)),
                 X.squeeze(known.astype(np.uint8)), X.squeeze(out.astype(np.uint8))]
        return store.write_file(folder, "chunk", [X.join_parts(parts)]), words
    return save


class Chunk:
    def __init__(self, uri: str):
        parts = X.split_parts(store.read_file(uri))
        self.n_words = int.from_bytes(parts[0], "little")
        self.number = X.unsqueeze(parts[1], np.uint32).astype(np.int64)
        self.first = X.unsqueeze(parts[2], np.int64)
        self.ids, self.known = X.unsqueeze(parts[3], np.int64), X.unsqueeze(parts[4], np.uint8).astype(bool)
        self.out = X.unsqueeze(parts[5], np.uint8).astype(bool)
        self.trains = np.repeat(~self.out, np.diff(self.first))

    def renumber(self, ids: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number the words by their ids from here on, which puts the n-grams in the ids' order."""
        order = np.argsort(ids)
        place = np.empty(len(ids), np.int64)
        place[order] = np.arange(len(ids))
        self.number = place[self.number]
        return ids[order], counts[order]

    def grams(self, order: int):
        """Distinct k-grams for k = 1 .. order: context, last word, index at every start, first start, suffix."""
        n = len(self.number)
        row_end = np.repeat(self.first[1:], np.diff(self.first))
        out = [{"index": self.number, "last": np.arange(self.n_words), "starts": np.arange(n)}]
        for k in range(2, order + 1):
            shorter = out[-1]
            starts = np.flatnonzero(np.arange(n) + k <= row_end)
            at = np.full(n, -1, np.int64)
            at[shorter["starts"]] = shorter["index"]
            width = max(1, self.n_words.bit_length())
            keys, where, index = T.unique_places((at[starts] << width) | self.number[starts + k - 1], len(shorter["last"]).bit_length() + width)
            out.append({"index": index, "context": keys >> width, "last": keys & ((1 << width) - 1), "starts": starts, "suffix": at[starts[where] + 1]})
        return out


def _ask_words(cfg: LmConfig, n_buckets: int):
    def ask(words: np.ndarray, uri: str):
        chunk = Chunk(uri)
        counts = np.bincount(chunk.number[chunk.trains], minlength=len(words))
        yield from X.bucket_requests(words, [counts.astype(np.uint32)], uri, n_buckets, bits=64)
    return ask


def _counted(requests: list[list[bytes]]):
    """(words of every request, the distinct words, index, training counts, places by falling count)."""
    words = [X.unsqueeze_sorted(r[0]) for r in requests]
    counts = np.concatenate([X.unsqueeze(r[1], np.uint32) for r in requests]).astype(np.float64)
    distinct, back = np.unique(np.concatenate(words), return_inverse=True)
    total = np.bincount(back, weights=counts).astype(np.uint64)
    rank = np.empty(len(distinct), np.uint32)
    rank[np.argsort(-total.astype(np.int64), kind="stable")] = np.arange(len(distinct), dtype=np.uint32)
    return words, distinct, back, total, rank


def _number_words(requests: list[list[bytes]]) -> list[bytes]:
    """(place in the bucket's dictionary by falling count, training count) of every asked word.

    Frequent words get small numbers, which the n-grams' columns compress by.
    The bucket's number and totals come with every answer.
    """
    words, _, back, total, rank = _counted(requests)
    out, at = [], 0
    totals = np.array([int(total.sum()), int((total > 0).sum())], "<u8").tobytes()
    for w in words:
        mine = back[at:at + len(w)]
        out.append(X.join_parts([X.squeeze(rank[mine]), X.squeeze(total[mine]), totals]))
        at += len(w)
    return out


def _keep_words(table: pa.Table) -> pa.Table:
    """A bucket's words with training counts, numbered as ``_number_words`` does (trained words come first)."""
    _, distinct, _, total, rank = _counted([X.split_parts(p.as_py()) for p in table.column("payload")])
    trained = total > 0
    payload = X.join_parts([X.squeeze_sorted(distinct[trained]), X.squeeze(rank[trained]), X.squeeze(total[trained])])
    return pa.table({"bucket": pa.array([table.column("bucket")[0].as_py()], pa.int32()), "words": pa.array([payload], pa.binary())})


def _look_up_words(asked: pa.Table, kept: pa.Table) -> pa.Table:
    """Answers as ``_number_words`` gives, from a kept model; words it does not have get numbers beyond its own."""
    asked = asked.select(["bucket", "chunk", "payload"])
    if not asked.num_rows or asked.column("bucket")[0].as_py() == X.CHUNK_ROW:
        return asked
    parts = X.split_parts(kept.column("words")[0].as_py()) if kept.num_rows else [X.squeeze(np.zeros(0, np.uint64))] * 3
    words, rank, total = X.unsqueeze_sorted(parts[0]), X.unsqueeze(parts[1], np.uint32), X.unsqueeze(parts[2], np.uint64)
    requests = [X.unsqueeze_sorted(X.split_parts(p.as_py())[0]) for p in asked.column("payload")]
    new = np.setdiff1d(np.concatenate(requests), words)
    both = np.concatenate([words, new])
    order = np.argsort(both)
    both, rank = both[order], np.concatenate([rank, len(words) + np.arange(len(new), dtype=np.uint32)]).astype(np.uint32)[order]
    total = np.concatenate([total, np.zeros(len(new), np.uint64)])[order]
    at = [np.searchsorted(both, r) for r in requests]
    return asked.set_column(2, "payload", pa.array([X.join_parts([X.squeeze(rank[a]), X.squeeze(total[a]), b"\0" * 16]) for a in at], pa.binary()))


def _buckets(context_hash: np.ndarray, n_buckets: int) -> np.ndarray:
    return (context_hash >> np.uint64(20)) % np.uint64(n_buckets)


def _routed(grams: list[dict], ids: np.ndarray, n_buckets: int):
    """For k >= 2: (k, order of the k-grams by bucket, bounds of the buckets)."""
    context_hash = T.mix(ids + np.uint64(1))
    for k, level in enumerate(grams[1:], 2):
        bucket = _buckets(context_hash, n_buckets)[level["context"]].astype(np.int64)
        order = np.argsort(bucket.astype(np.uint16 if n_buckets < 1 << 16 else np.int64), kind="stable")
        yield k, order, np.searchsorted(bucket[order], np.arange(n_buckets + 1))
        context_hash = T.mix(context_hash[level["context"]] * np.uint64(0x9E3779B97F4A7C15) + ids[level["last"]])


def _ask_grams(cfg: LmConfig, n_buckets: int, folder: str):
    def ask(uri: str, answers: list[tuple[int, bytes]]) -> pa.Table:
        chunk = Chunk(uri)
        ids, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)]
        for bucket, payload in answers:  # in the order of the words' hashes
            places, count, _ = X.split_parts(payload)
            ids.append(X.unsqueeze(places, np.uint32).astype(np.uint64) * np.uint64(n_buckets) + np.uint64(bucket))
            counts.append(X.unsqueeze(count, np.uint64))
        ids, counts = np.concatenate(ids), np.concatenate(counts)
        if len(ids) and ids.max() >> np.uint64(32):
            raise ValueError("word numbers beyond 32 bits; take fewer buckets (a larger bucket_grams)")
        own_order = ids.astype(np.uint32), counts
        ids, counts = chunk.renumber(ids, counts)
        side = store.write_file(folder, "words", [X.join_parts([X.squeeze(c) for c in own_order])])
        grams = chunk.grams(cfg.order)
        sections: list[list[list[bytes]]] = [[] for _ in range(n_buckets)]
        columns = ids[:, None]  # the ids of every (k-1)-gram, word by word
        for k, order, bounds in _routed(grams, ids, n_buckets):
            level = grams[k - 1]
            trained = np.bincount(level["index"][chunk.trains[level["starts"]]], minlength=len(level["last"])).astype(np.uint32)
            columns = np.column_stack([columns[level["context"]], ids[level["last"]]])
            rows = columns.astype(np.uint32)
            for b in range(n_buckets):
                mine = order[bounds[b]:bounds[b + 1]]
                sections[b].append([X.squeeze(np.diff(rows[mine, 0], prepend=np.uint32(0))), *(X.squeeze(np.ascontiguousarray(rows[mine, j])) for j in range(1, k)), X.squeeze(trained[mine])])
        out = [(X.CHUNK_ROW, uri, side.encode())]
        out += [(b, uri, X.join_parts([X.join_parts(s) for s in parts])) for b, parts in enumerate(sections)]
        return pa.Table.from_batches([X.rows_batch(out)])
    return ask


# --- trie shards -----------------------------------------------------------

def _gram_columns(section: bytes, k: int) -> tuple[list[np.ndarray], np.ndarray]:
    parts = X.split_parts(section)
    ids = [np.cumsum(X.unsqueeze(parts[0], np.uint32), dtype=np.uint32), *(X.unsqueeze(p, np.uint32) for p in parts[1:k])]
    return ids, X.unsqueeze(parts[k], np.uint32)


class Grams:
    """The distinct n-grams of some rows as a tree: per level (parent, id, number of parents); ``node``: each row's leaf."""

    def __init__(self, ids: list[np.ndarray], counts: np.ndarray):
        self.node, self.levels, n = np.zeros(len(counts), np.int64), [], 1
        for column in ids:
            values, _, column = T.unique_places(column, 32)
            width = max(1, len(values).bit_length())
            keys, _, self.node = T.unique_places((self.node << width) | column, n.bit_length() + width)
            self.levels.append((keys >> width, values[keys & ((1 << width) - 1)].astype(np.int64) if len(keys) else keys, n))
            n = len(keys)
        self.total = np.bincount(self.node, weights=counts, minlength=n)

    def trained(self) -> tuple[list[tuple[np.ndarray, np.ndarray, int]], np.ndarray]:
        """(the levels, counts of the leaves) of the n-grams with a count."""
        keep, out = self.total > 0, []
        counts = self.total[keep]
        for parent, ids, n_parents in reversed(self.levels):
            up = np.zeros(n_parents, bool)
            up[parent[keep]] = True
            out.append(((np.cumsum(up) - 1)[parent[keep]], ids[keep], max(1, int(up.sum()))))
            keep = up
        return out[::-1], counts


def count_of_counts(section_columns: list[tuple[list[np.ndarray], np.ndarray]], k: int) -> tuple[int, int]:
    """(k-grams seen once in training, seen twice) among the rows of a bucket."""
    key = np.zeros(sum(len(c) for _, c in section_columns), np.uint64)
    for j in range(k):
        key = T.mix(key * np.uint64(0x9E3779B97F4A7C15) + np.concatenate([ids[j] for ids, _ in section_columns]).astype(np.uint64) + np.uint64(1))
    _, back = T.unique_hashes(key)
    total = np.bincount(back, weights=np.concatenate([c for _, c in section_columns]))
    return int((total == 1).sum()), int((total == 2).sum())


def discount(ones: int, twos: int) -> float:
    """D of an order, from all its n-grams seen once and twice in training, wherever they are kept."""
    return float(np.clip(ones / max(1, ones + 2 * twos), 0.1, 0.95))


def build_trie(grams: Grams, cfg: LmConfig, discount: float) -> list[np.ndarray]:
    """Arrays of one trie of k levels: alphas on the leaves, lambdas on their contexts."""
    levels, total = grams.trained()
    context, _, n_contexts = levels[-1]
    of_context = np.bincount(context, weights=total, minlength=n_contexts)
    alpha = encode_probability((total - discount) / of_context[context], cfg) if len(total) else np.zeros(0, np.uint16)
    given = np.bincount(context, weights=decode_table(cfg)[alpha], minlength=n_contexts)
    rest = np.maximum(encode_probability(np.maximum(1.0 - given, 0.0), cfg), 1)  # never nothing: no text is impossible
    arrays = []
    for depth, (parent, ids, n_parents) in enumerate(levels):
        codes = alpha if depth == len(levels) - 1 else rest[:len(ids)] if depth == len(levels) - 2 else np.zeros(len(ids), np.uint16)
        arrays += Level.build(parent, ids, n_parents, [codes], cfg.code_bits)
    return arrays


class Trie:
    """A shard's k-gram trie over its mapped arrays."""

    def __init__(self, arrays: list[np.ndarray], k: int, code_bits: int):
        self.levels = [Level(arrays[9 * d:9 * d + 9], code_bits) for d in range(k)]

    def query(self, levels: list[tuple[np.ndarray, np.ndarray, int]]) -> tuple[np.ndarray, np.ndarray]:
        """(alpha code of every leaf, lambda code of every context) of a tree of n-grams: one walk down, level by level."""
        node, rest = np.zeros(1, np.int64), np.zeros(0, np.uint16)
        for depth, (level, (parent, ids, _)) in enumerate(zip(self.levels, levels)):
            node = level.find(node[parent], ids)
            if depth == len(levels) - 2:
                rest = level.code(0, node).astype(np.uint16)
        return self.levels[-1].code(0, node).astype(np.uint16), rest


def mapped(data: bytes) -> np.ndarray:
    """A shard as a memory map of a scratch file that is gone when the map is."""
    with tempfile.NamedTemporaryFile() as scratch:
        scratch.write(data)
        scratch.flush()
        return np.memmap(scratch.name, np.uint8, "r")


def _tally(cfg: LmConfig):
    """(order, seen once, seen twice) of a bucket's n-grams."""
    def tally(table: pa.Table) -> pa.Table:
        requests = [X.split_parts(p.as_py()) for p in table.column("payload")] if table.column("bucket")[0].as_py() != X.CHUNK_ROW else []
        rows = [(k, *count_of_counts([_gram_columns(r[k - 2], k) for r in requests], k)) for k in range(2, cfg.order + 1)] if requests else []
        return pa.table([pa.array(c, pa.int64()) for c in zip(*rows)] if rows else [pa.array([], pa.int64())] * 3, ["k", "ones", "twos"])
    return tally


def _request_grams(requests: list[list[bytes]], k: int) -> tuple[Grams, list[int]]:
    """(the distinct k-grams of a bucket's requests, how many each request has)."""
    columns = [_gram_columns(r[k - 2], k) for r in requests]
    return Grams([np.concatenate([c[0][j] for c in columns]) for j in range(k)], np.concatenate([c[1] for c in columns])), [len(c[1]) for c in columns]


def _shard_answers(shard: bytes, k: int, grams: Grams, sizes: list[int], cfg: LmConfig) -> list[list[bytes]]:
    """(alpha codes, lambda codes of the contexts) of every request's k-grams, from a mapped shard."""
    alpha, rest = Trie(from_buffer(mapped(shard)), k, cfg.code_bits).query(grams.levels)
    context, at, out = grams.levels[-1][0], 0, []
    for size in sizes:
        mine = grams.node[at:at + size]
        own = context[mine]
        head = np.ones(size, bool)
        head[1:] = own[1:] != own[:-1]
        out.append([X.squeeze(alpha[mine]), X.squeeze(rest[own[head]])])
        at += size
    return out


def _bucket_discounts(table: pa.Table, cfg: LmConfig) -> dict[int, float]:
    return {k: discount(*(table.column(f"{c}{k}")[0].as_py() or 0 for c in ("ones", "twos"))) for k in range(2, cfg.order + 1)}


def _tries_and_answers(cfg: LmConfig):
    def one(table: pa.Table) -> pa.Table:
        table = table.sort_by("chunk")
        out = table.select(["bucket", "chunk", "payload"])
        if table.column("bucket")[0].as_py() == X.CHUNK_ROW:
            return out
        discounts = _bucket_discounts(table, cfg)
        requests = [X.split_parts(p.as_py()) for p in table.column("payload")]
        answers: list[list[bytes]] = [[] for _ in requests]
        for k in range(2, cfg.order + 1):
            grams, sizes = _request_grams(requests, k)
            for answer, more in zip(answers, _shard_answers(to_bytes(build_trie(grams, cfg, discounts[k])), k, grams, sizes, cfg)):
                answer += more
        return out.set_column(2, "payload", pa.array([X.join_parts(a) for a in answers], pa.binary()))
    return one


def _keep_tries(cfg: LmConfig, folder: str):
    """A bucket's shards as files, one a level of n-grams; rows that name them."""
    def one(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket")[0].as_py()
        uris = {}
        if bucket != X.CHUNK_ROW:
            discounts = _bucket_discounts(table, cfg)
            requests = [X.split_parts(p.as_py()) for p in table.column("payload")]
            for k in range(2, cfg.order + 1):
                uris[k] = store.write_file(folder, f"trie-{k}", [to_bytes(build_trie(_request_grams(requests, k)[0], cfg, discounts[k]))])
        return pa.table({"bucket": pa.array([bucket] * len(uris), pa.int32()), "k": pa.array(list(uris), pa.int32()), "uri": pa.array(list(uris.values()), pa.string())})
    return one


def _look_up_grams(cfg: LmConfig):
    """Answers as ``_tries_and_answers`` gives, from the shards of a kept model."""
    def one(asked: pa.Table, kept: pa.Table) -> pa.Table:
        if not asked.num_rows or asked.column("bucket")[0].as_py() == X.CHUNK_ROW:
            return asked
        uris = dict(zip(kept.column("k").to_pylist(), kept.column("uri").to_pylist()))
        requests = [X.split_parts(p.as_py()) for p in asked.column("payload")]
        answers: list[list[bytes]] = [[] for _ in requests]
        for k in range(2, cfg.order + 1):
            grams, sizes = _request_grams(requests, k)
            nothing = Grams([np.zeros(0, np.int64)] * k, np.zeros(0))
            shard = store.read_file(uris[k]) if k in uris else to_bytes(build_trie(nothing, cfg, 0.5))
            for answer, more in zip(answers, _shard_answers(shard, k, grams, sizes, cfg)):
                answer += more
        return asked.set_column(asked.column_names.index("payload"), "payload", pa.array([X.join_parts(a) for a in answers], pa.binary()))
    return one


def _with_tallies(grams: DataFrame, cfg: LmConfig, n_buckets: int) -> DataFrame:
    """Every bucket's requests with the counts of counts summed over all buckets.

    Both steps read one shuffle: the sums are a single row, joined to the
    buckets' rows where they lie.
    """
    asked = grams.repartition(n_buckets, "bucket")
    tallies = asked.groupBy("bucket").applyInArrow(_tally(cfg), "k long, ones long, twos long").agg(
        F.lit(0).alias("_one"), *[F.sum(F.when(F.col("k") == k, F.col(c))).alias(f"{c}{k}") for k in range(2, cfg.order + 1) for c in ("ones", "twos")])
    return asked.withColumn("_one", F.lit(0)).join(F.broadcast(tallies), "_one").drop("_one")


# --- scores ----------------------------------------------------------------

def _score(cfg: LmConfig, n_buckets: int, n_train: int, n_types: int):
    def last(uri: str, payloads: list[bytes]) -> pa.Table:
        chunk = Chunk(uri)
        ids, counts = X.split_parts(store.read_file(payloads[0].decode()))
        ids, counts = chunk.renumber(X.unsqueeze(ids, np.uint32).astype(np.uint64), X.unsqueeze(counts, np.uint64).astype(np.float64))
        answers = [X.split_parts(p) for p in payloads[1:]]
        value, grams = decode_table(cfg), chunk.grams(cfg.order)
        shorter = (counts + cfg.add) / (n_train + cfg.add * (n_types + 1))
        log_p = np.log10(shorter)[chunk.number]
        base, known = log_p.copy(), counts[chunk.number] > 0
        for k, order, bounds in _routed(grams, ids, n_buckets):
            level = grams[k - 1]
            alpha, rest = np.zeros(len(order)), np.ones(len(order))
            for b in range(n_buckets):
                mine = order[bounds[b]:bounds[b + 1]]
                if len(mine):
                    context = level["context"][mine]
                    code = X.unsqueeze(answers[b][2 * (k - 2) + 1], np.uint16)
                    of = np.cumsum(np.diff(context, prepend=context[0]) != 0)
                    # a context never seen in training (no code) passes everything on
                    alpha[mine] = value[X.unsqueeze(answers[b][2 * (k - 2)], np.uint16)]
                    rest[mine] = value[code[of]]
            seen = np.bincount(level["context"], weights=alpha + rest, minlength=len(shorter)) > 0
            rest[~seen[level["context"]]] = 1.0
            shorter = alpha + rest * shorter[level["suffix"]]
            log_p[level["starts"] + k - 1] = np.log10(shorter)[level["index"]]

        def per_row(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, chunk.first[:-1])  # every row has its end token

        return pa.table({"doc_id": pa.array(chunk.ids, mask=~chunk.known), "held_out": pa.array(chunk.out), "n_tokens": pa.array(np.diff(chunk.first), pa.int64()),
                         "n_known": pa.array(per_row(known.astype(np.int64))), "train_tokens": pa.array(np.full(len(chunk.ids), n_train), pa.int64()),
                         "base_score": pa.array(per_row(base)), "score": pa.array(per_row(log_p))})
    return last


def _numbered(docs: DataFrame, folder: str, cfg: LmConfig, n_buckets: int, model: str | None = None) -> tuple[DataFrame, int, int, int]:
    """(every chunk's words with ids and counts, number of chunks, training tokens, distinct ones); the words also go to ``model``."""
    spark = docs.sparkSession
    first = X.write_requests(docs, folder, _ask_words(cfg, n_buckets), cfg.chunk_bytes, _save(cfg))
    chunks = X.chunk_rows(first).count()
    words = written(X.answer(first, _number_words, n_buckets, pass_chunks=True), folder, "words-numbered")
    if model:
        asked = first.where(F.col("bucket") != X.CHUNK_ROW).repartition(n_buckets, "bucket")
        asked.groupBy("bucket").applyInArrow(_keep_words, "bucket int, words binary").write.parquet(f"{model}/words")
    drop_folder(spark, f"{folder}/requests")
    # One small row per bucket: its totals are the last 16 bytes of any of its answers.
    totals = (words.where(F.col("bucket") != X.CHUNK_ROW).groupBy("bucket").agg(F.first(F.substring("payload", -16, 16)).alias("t")).collect())
    n_train, n_types = (sum(int.from_bytes(bytes(r["t"])[a:a + 8], "little") for r in totals) for a in (0, 8))
    return words, chunks, n_train, n_types


def _bucket_number(docs: DataFrame, cfg: LmConfig) -> int:
    return max(1, -(-X.text_bytes(docs) * cfg.order // (12 * cfg.bucket_grams)))


def train(docs: DataFrame, model: str, cfg: LmConfig | None = None) -> None:
    """Train on the documents that are not held out and keep the model below the new folder ``model`` (shared, by URI).

    The table ``about`` is written last: a folder without it is no model.
    """
    cfg = cfg or LmConfig()
    spark = docs.sparkSession
    folder, n_buckets = shared_folder(spark, "ngram-lm"), _bucket_number(docs, cfg)
    words, chunks, n_train, n_types = _numbered(docs, folder, cfg, n_buckets, model)
    grams = X.finish(words, chunks, _ask_grams(cfg, n_buckets, folder), X.REQUEST_SCHEMA, with_buckets=True)
    tries = _with_tallies(grams, cfg, n_buckets).groupBy("bucket").applyInArrow(_keep_tries(cfg, f"{model}/shards"), "bucket int, k int, uri string")
    tries.write.parquet(f"{model}/tries")
    spark.createDataFrame([(cfg.order, cfg.add, cfg.code_bits, cfg.log2_range, n_buckets, n_train, n_types)],
                          "order int, add double, code_bits int, log2_range double, n_buckets int, n_train long, n_types long").coalesce(1).write.parquet(f"{model}/about")
    drop_folder(spark, folder)


def score(model: str, docs: DataFrame, cfg: LmConfig | None = None) -> DataFrame:
    """Score all documents with a kept model (``RESULT_SCHEMA``); ``cfg`` gives the sizes of chunks, the model the rest.

    ``held_out`` only tells the fold of the id; words the model does not have are unknown.
    """
    spark = docs.sparkSession
    about = spark.read.parquet(f"{model}/about").first()
    cfg = replace(cfg or LmConfig(), order=about["order"], add=about["add"], code_bits=about["code_bits"], log2_range=about["log2_range"])
    folder, n_buckets = shared_folder(spark, "ngram-lm"), about["n_buckets"]
    first = X.write_requests(docs, folder, _ask_words(cfg, n_buckets), cfg.chunk_bytes, _save(cfg))
    chunks = X.chunk_rows(first).count()
    kept = spark.read.schema("bucket int, words binary").parquet(f"{model}/words")
    words = first.groupBy("bucket").cogroup(kept.groupBy("bucket")).applyInArrow(_look_up_words, X.REQUEST_SCHEMA)
    words = written(words, folder, "words-numbered")
    grams = X.finish(words, chunks, _ask_grams(cfg, n_buckets, folder), X.REQUEST_SCHEMA, with_buckets=True)
    tries = spark.read.schema("bucket int, k int, uri string").parquet(f"{model}/tries")
    answers = grams.groupBy("bucket").cogroup(tries.groupBy("bucket")).applyInArrow(_look_up_grams(cfg), X.REQUEST_SCHEMA)
    out = X.finish(answers, chunks, _score(cfg, n_buckets, about["n_train"], about["n_types"]), RESULT_SCHEMA).checkpoint()
    drop_folder(spark, folder)
    return out


def train_and_score(docs: DataFrame, cfg: LmConfig | None = None) -> DataFrame:
    """Train on the documents that are not held out and score all (``RESULT_SCHEMA``); each shard lives as long as its answers take."""
    cfg = cfg or LmConfig()
    spark = docs.sparkSession
    folder, n_buckets = shared_folder(spark, "ngram-lm"), _bucket_number(docs, cfg)
    words, chunks, n_train, n_types = _numbered(docs, folder, cfg, n_buckets)
    grams = X.finish(words, chunks, _ask_grams(cfg, n_buckets, folder), X.REQUEST_SCHEMA, with_buckets=True)
    answers = _with_tallies(grams, cfg, n_buckets).groupBy("bucket").applyInArrow(_tries_and_answers(cfg), X.REQUEST_SCHEMA)
    out = X.finish(answers, chunks, _score(cfg, n_buckets, n_train, n_types), RESULT_SCHEMA).checkpoint()
    drop_folder(spark, folder)
    return out

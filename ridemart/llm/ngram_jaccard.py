"""Near-duplicate documents by Jaccard similarity of word n-gram sets: multiple-global-order filtering.

Sets at or above the threshold must share a token within their prefixes under
*any* global order of tokens.  Several orders are used (rare document
frequencies first, ties by a different hash each): pairs are found by the first
order's prefixes, must also meet in the others', and only then are compared
exactly.

1. Every chunk of documents asks for the frequency of its tokens.  A set needs
   most of its tokens to occur elsewhere, so sets with too many tokens of
   frequency one are out; equal sets become one.
2. Each remaining set is paired with the most central set among those sharing
   a prefix token (one pair per set).  Verified pairs form components, which
   makes a large group of near copies one component without its pairs.
3. Pairs across components are then all examined: within a prefix token's
   group, in blocks, by bounds on their intersection, then by the other
   orders, then exactly.  No group is capped and no link between components is lost.

Edge cases: null, empty and blank texts have the empty set and are linked with
nothing; a text of fewer words than ``n`` is one token; repeated rows are equal
sets; a null id takes part, and a component without any id has a null id; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm import exchange as X
from ridemart.llm import text as T
from ridemart.llm.cluster import drop_folder, shared_folder, written
from ridemart.llm.graph import components


@dataclass(frozen=True)
class JaccardConfig:
    n: int = 5
    percent: int = 80
    orders: int = 3
    chunk_bytes: int = 8 << 20
    slice_bytes: int = 2 << 20
    bucket_tokens: int = 2_000_000
    block: int = 1024


DOC_SCHEMA = "doc_id long, n long, sig1 long, sig2 long, m int, centre double, tokens array<long>, first array<long>, others array<array<int>>"


def shingles(data: np.ndarray, off: np.ndarray, cfg: JaccardConfig) -> tuple[np.ndarray, np.ndarray]:
    """(tokens sorted within rows, row offsets): distinct n-grams of each row."""
    hashes, firsts, rows = [], [np.zeros(1, np.int64)], len(off) - 1
    for a, b in T.slices(off, cfg.slice_bytes):
        part = data[off[a]:off[b]]
        starts, ends, first = T.word_bounds(part, off[a:b + 1] - off[a])
        hashes.append(T.span_hashes(part, starts, ends, lower=True))
        firsts.append(first[1:] + firsts[-1][-1])
    words, first = np.concatenate([np.zeros(0, np.uint64), *hashes]), np.concatenate(firsts)
    grams, row = T.gram_hashes(words, cfg.n), T.row_of(first)
    inside = row[:len(grams)] == row[cfg.n - 1:] if len(grams) else np.zeros(0, bool)
    parts, owners = [grams[inside]], [row[:len(grams)][inside]]
    for size in range(1, cfg.n):
        short = np.flatnonzero(np.diff(first) == size)
        if len(short):
            total = np.zeros(len(short), np.uint64)
            for k in range(size):
                total = T.mix(total + words[first[short] + k] + np.uint64(size))
            parts.append(total)
            owners.append(short)
    tokens, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(tokens, kind="stable")
    order = order[np.argsort(owner[order].astype(np.uint16 if rows < 1 << 16 else np.int64), kind="stable")]
    tokens, owner = tokens[order], owner[order]
    fresh = np.ones(len(tokens), bool)
    fresh[1:] = (tokens[1:] != tokens[:-1]) | (owner[1:] != owner[:-1])
    return tokens[fresh], np.searchsorted(owner[fresh], np.arange(rows + 1))


def _sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    sums = np.concatenate([np.zeros(1, values.dtype), np.cumsum(values, dtype=values.dtype)])
    return sums[cuts[1:]] - sums[cuts[:-1]]


def _signed(tokens: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(set size, two 64-bit signatures, first row of each distinct set)."""
    n = np.diff(cuts)
    sig1, sig2 = (_sums(T.mix(tokens ^ np.uint64(seed)), cuts) for seed in (0x51ED270B, 0xB5297A4D))
    table = np.rec.fromarrays([sig1, sig2, n])
    _, at = np.unique(table, return_index=True)
    return n, sig1, sig2, at[n[at] > 0]


def _chosen(tokens: np.ndarray, cuts: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The tokens of some rows, with their offsets."""
    size = cuts[rows + 1] - cuts[rows]
    stop = np.cumsum(size)
    at = np.repeat(cuts[rows] - (stop - size), size) + np.arange(stop[-1] if len(stop) else 0)
    return tokens[at], np.concatenate([[0], stop])


def prefix_size(n: np.ndarray, percent: int) -> np.ndarray:
    return n - -(-percent * n // 100) + 1


def _requests(cfg: JaccardConfig, n_buckets: int):
    def ask(table: pa.Table, chunk: str):
        tokens, cuts = shingles(*T.flat(table.column("text")), cfg)
        _, _, _, rows = _signed(tokens, cuts)
        keys, counts = np.unique(X.short_keys(_chosen(tokens, cuts, rows)[0]), return_counts=True)
        yield from X.bucket_requests(keys, [counts.astype(np.uint32)], chunk, n_buckets)
    return ask


def _frequency_classes(requests: list[list[bytes]]) -> list[bytes]:
    """floor(log2(document frequency)) of every asked key."""
    keys = [X.unsqueeze_sorted(r[0]) for r in requests]
    counts = np.concatenate([X.unsqueeze(r[1], np.uint32) for r in requests]).astype(np.int64)
    _, back = np.unique(np.concatenate(keys), return_inverse=True)
    total = np.bincount(back, weights=counts)[back].astype(np.int64)
    classes = np.log2(total).astype(np.uint8)
    stops = np.cumsum([len(k) for k in keys])
    return [X.squeeze(c) for c in np.split(classes, stops[:-1])]


def _set_rows(cfg: JaccardConfig):
    def last(chunk: str, payloads: list[bytes]) -> pa.Table:
        table = X.load_texts(chunk)
        tokens, cuts = shingles(*T.flat(table.column("text")), cfg)
        n, sig1, sig2, rows = _signed(tokens, cuts)
        classes = np.concatenate([np.zeros(0, np.uint8), *(X.unsqueeze(p, np.uint8) for p in payloads)])
        own, own_cuts = _chosen(tokens, cuts, rows)
        _, back = np.unique(X.short_keys(own), return_inverse=True)
        rank = classes[back].astype(np.int64)
        shared = _sums((rank > 0).astype(np.int64), own_cuts)
        lists: dict[int, tuple] = {}
        for k in np.flatnonzero(100 * shared >= cfg.percent * n[rows]).tolist():
            a, b = own_cuts[k], own_cuts[k + 1]
            mine, r = own[a:b], rank[a:b]
            size = int(prefix_size(np.int64(b - a), cfg.percent))
            prefixes = []
            for order in range(cfg.orders):
                tie = T.mix(mine ^ np.uint64(0x9E3779B97F4A7C15 * (order + 1) & (2**64 - 1)))
                at = np.lexsort((tie, r))[:size]
                prefixes.append(mine[at[r[at] > 0]])  # tokens of frequency one meet nothing
            lists[int(rows[k])] = (int(shared[k]), float(r.mean()), mine.view(np.int64), prefixes[0].view(np.int64),
                                   [(p & np.uint64(0xFFFFFFFF)).astype(np.uint32).view(np.int32) for p in prefixes[1:]])
        found = [lists.get(k) for k in range(table.num_rows)]
        kinds = (pa.int32(), pa.float64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.list_(pa.int32())))
        more = [pa.array([None if f is None else f[k] for f in found], kind) for k, kind in enumerate(kinds)]
        return pa.table([table.column("doc_id").combine_chunks(), pa.array(n, pa.int64()), pa.array(sig1.view(np.int64)), pa.array(sig2.view(np.int64)), *more],
                        names=["doc_id", "n", "sig1", "sig2", "m", "centre", "tokens", "first", "others"])
    return last


def _least_overlap(n: str, m: str, percent: int):
    """Smallest intersection of two sets of these sizes at the threshold."""
    return F.ceil(F.lit(percent) * (F.col(n) + F.col(m)) / (100 + percent) - 1e-9)


def verified(pairs: DataFrame, sets: DataFrame, cfg: JaccardConfig) -> DataFrame:
    """The pairs (a, b) that meet under the other orders too and reach the threshold."""
    slim = sets.select("id", "n", "m", "others")
    side = [slim.select(*[F.col(c).alias(c + s) for c in slim.columns]) for s in ("_a", "_b")]
    near = pairs.join(side[0], F.col("a") == F.col("id_a")).join(side[1], F.col("b") == F.col("id_b"))
    near = near.where(F.least("m_a", "m_b") >= _least_overlap("n_a", "n_b", cfg.percent))
    for k in range(cfg.orders - 1):
        near = near.where(F.arrays_overlap(F.get("others_a", F.lit(k)), F.get("others_b", F.lit(k))))
    near = near.select("a", "b", "n_a", "n_b")
    both = (near.join(sets.select(F.col("id").alias("a"), F.col("tokens").alias("t_a")), "a")
            .join(sets.select(F.col("id").alias("b"), F.col("tokens").alias("t_b")), "b"))
    inter = F.size(F.array_intersect("t_a", "t_b"))
    return both.withColumn("i", inter).where(100 * F.col("i") >= cfg.percent * (F.col("n_a") + F.col("n_b") - F.col("i"))).select("a", "b")


def pivots(sets: DataFrame) -> DataFrame:
    """For every set, the most central set among those that share one of its prefix tokens, and what both have in common."""
    posts = sets.select("id", "centre", F.explode("first").alias("token"))
    hubs = posts.groupBy("token").agg(F.max(F.struct("centre", "id")).alias("hub"))
    chosen = (posts.join(hubs, "token").where(F.col("hub.id") != F.col("id")).groupBy("id").agg(F.max("hub").alias("hub"))
              .select("id", F.col("hub.id").alias("pivot")))
    return (sets.select("id", "tokens").join(chosen, "id").join(sets.select(F.col("id").alias("pivot"), F.col("tokens").alias("t")), "pivot")
            .select("id", "pivot", F.size(F.array_intersect("tokens", "t")).alias("with_pivot")))


def cross_pairs(sets: DataFrame, near: DataFrame, labels: DataFrame, cfg: JaccardConfig) -> DataFrame:
    """Every pair of different components that shares a prefix token and passes the bounds, once.

    Bounds on the intersection of x and y: neither has more shared tokens than
    ``m``; and with the same pivot they have at most the smaller intersection
    with it in common inside it, and the smaller rest outside.
    """
    posts = (sets.join(labels, "id", "left").join(near, "id", "left")
             .select("id", "n", "m", F.coalesce("component", "id").alias("component"), F.coalesce("pivot", "id").alias("pivot"),
                     F.coalesce("with_pivot", "m").alias("with_pivot"), F.explode("first").alias("token")))
    open_ = (posts.groupBy("token").agg(F.count("*").alias("k"), F.min("component").alias("low"), F.max("component").alias("high"))
             .where("low < high").select("token", "k"))
    posts = posts.join(open_, "token")
    # Blocks of a large group meet pairwise, so that no task holds more than two blocks.
    blocks = F.ceil(F.col("k") / cfg.block).cast("int")
    mine = F.pmod(F.xxhash64("id"), blocks).cast("int")
    met = (posts.withColumn("blocks", blocks).withColumn("mine", mine)
           .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
           .select("id", "n", "m", "component", "pivot", "with_pivot", "token", "mine", F.least("mine", "other").alias("x"), F.greatest("mine", "other").alias("y")))
    percent = cfg.percent

    def meet(table: pa.Table) -> pa.Table:
        col = {c: table.column(c).to_numpy() for c in ("id", "n", "m", "component", "pivot", "with_pivot", "mine")}
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        left, right = np.flatnonzero(col["mine"] == x), np.flatnonzero(col["mine"] == y)
        out_a, out_b = [], []
        for i in left.tolist():
            least = -(-percent * (col["n"][i] + col["n"][right]) // (100 + percent))
            ok = (col["component"][right] != col["component"][i]) & (np.minimum(col["m"][right], col["m"][i]) >= least)
            inside, outside = col["with_pivot"], col["m"] - col["with_pivot"]
            ok &= (col["pivot"][right] != col["pivot"][i]) | (np.minimum(inside[right], inside[i]) + np.minimum(outside[right], outside[i]) >= least)
            if x == y:
                ok &= col["id"][right] > col["id"][i]
            if ok.any():
                out_a.append(int(col["id"][i]))
                out_b.append(np.sort(col["id"][right[ok]]).astype("<i8").tobytes())
        return pa.table({"a": pa.array(out_a, pa.int64()), "others": pa.array(out_b, pa.binary())})

    def once(table: pa.Table) -> pa.Table:
        ids = np.unique(np.concatenate([np.frombuffer(b.as_py(), "<i8") for b in table.column("others")]))
        a = np.full(len(ids), table.column("a")[0].as_py())
        return pa.table({"a": np.minimum(a, ids), "b": np.maximum(a, ids)})

    listed = met.groupBy("token", "x", "y").applyInArrow(meet, "a long, others binary")
    return listed.groupBy("a").applyInArrow(once, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, cfg: JaccardConfig | None = None) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (smallest id reachable by links)."""
    cfg = cfg or JaccardConfig()
    spark = docs.sparkSession
    folder = shared_folder(spark, "ngram-jaccard")  # also sets the checkpoint folder
    n_buckets = max(1, -(-X.text_bytes(docs) // (6 * cfg.bucket_tokens)))
    requests = X.write_requests(docs, folder, _requests(cfg, n_buckets), cfg.chunk_bytes)
    known = X.chunk_rows(requests)
    rows = X.finish(known.unionAll(X.answer(requests, _frequency_classes, n_buckets)), known.count(), _set_rows(cfg), DOC_SCHEMA)
    rows = written(rows, folder, "rows")
    # Equal sets become one, named by its smallest document.
    key = ["sig1", "sig2", "n"]
    filled = rows.where("n > 0")
    named = written(filled.groupBy(key).agg(F.min("doc_id").alias("least")).withColumn("id", F.monotonically_increasing_id()), folder, "named")
    kept = (filled.where(F.col("tokens").isNotNull()).groupBy(key)
            .agg(F.first(F.struct("m", "centre", "tokens", "first", "others")).alias("set")))
    sets = written(kept.join(named, key).select("id", "n", "set.*"), folder, "sets")
    near = written(pivots(sets), folder, "pivots")
    stars = near.select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b")).distinct()
    links = written(verified(stars, sets, cfg), folder, "links")
    more = written(verified(cross_pairs(sets, near, components(links, folder), cfg), sets, cfg), folder, "more-links")
    labels = components(links.union(more), folder).withColumnRenamed("component", "label")
    groups = named.join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    least = groups.groupBy("label").agg(F.min("least").alias("component_id"))
    groups = groups.join(least, "label").select(F.col("sig1").alias("s1"), F.col("sig2").alias("s2"), F.col("n").alias("sn"), "component_id")
    slim = rows.select("doc_id", F.col("n").alias("n_shingles"), "sig1", "sig2")
    out = (slim.join(groups, (F.col("n_shingles") == F.col("sn")) & (F.col("sig1") == F.col("s1")) & (F.col("sig2") == F.col("s2")), "left")
           .select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
           .checkpoint())  # a slim row per document, so that the folder can go
    drop_folder(spark, folder)
    return out


def keep_one_of_each(docs: DataFrame, cfg: JaccardConfig | None = None) -> DataFrame:
    """One row of each group, all columns unchanged: one with the smallest id (null ids last).

    Rows are known by a hash of id and text; of equal rows one stays.  Texts
    without a word are linked with nothing and all stay.
    """
    key = F.xxhash64("doc_id", "text")
    found = near_duplicates(docs.select(key.alias("doc_id"), "text"), cfg)
    rows = found.groupBy(F.col("doc_id").alias("_key"), "component_id", (F.col("n_shingles") == 0).alias("bare")).agg(F.count("*").alias("rows"))
    ids = docs.select(key.alias("_key"), F.col("doc_id").alias("id")).distinct()
    best = (rows.where("not bare").join(ids, "_key").groupBy("component_id")
            .agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "_key", "rows")).alias("best")).select("best._key", "best.rows"))
    single = best.where("rows = 1").select("_key").unionAll(rows.where("bare").select("_key"))
    keyed = docs.withColumn("_key", key)
    several = (keyed.join(best.where("rows > 1"), "_key", "left_semi").groupBy("_key")
               .agg(F.first(F.struct(*[F.col(c) for c in docs.columns])).alias("row")).select("row.*"))
    return keyed.join(single, "_key", "left_semi").select(docs.columns).unionAll(several)

"""Benchmark decontamination by winnowing, in DataFrame operations only.

The minimum k-gram hash of every sliding window is a document's fingerprint:
two texts that share a window of ``window`` words share its fingerprint, so no
shared span of that length is missed.  Fingerprints of documents and benchmark
are joined; in the documents hit, every window around a shared fingerprint is
compared with the benchmark's windows by its whole words, and neighbouring
windows extend the hit.  Items of fewer words than a window count as one window
of their own length.

Words are lower-cased for A-Z only.  Fingerprints hash fully lower-cased words
(cheaper, and equal whenever the exact words are equal); the comparison uses
the exact ones.

Edge cases: a null or empty text has no words and is never hit; a null id is a
value like any other; repeated rows each get the result; equal items count as
one until the very end, so copies in the benchmark multiply nothing; empty
tables give no hits; other columns are not read, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.session import ensure_checkpoint_dir

#: What separates words: every ASCII character but digits and letters.
_SEPARATORS = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@dataclass(frozen=True)
class DecontaminationConfig:
    window: int = 10
    gram: int = 4
    #: Benchmark fingerprints up to this many (16 bytes each) are broadcast; more are joined by shuffle.
    broadcast_fingerprints: int = 1_000_000


def raw_words(text: Column) -> Column:
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), _SEPARATORS), "")


def exact_words(text: Column) -> Column:
    return raw_words(F.translate(F.coalesce(text, F.lit("")), _UPPER, _UPPER.lower()))


def _starts(words: Column, length: int) -> Column:
    """0 .. n - length, or nothing for a shorter array."""
    return F.when(F.size(words) >= length, F.sequence(F.lit(0), F.size(words) - length)).otherwise(F.array().cast("array<int>"))


def gram_hashes(words: Column, length: int) -> Column:
    """Hash of every run of ``length`` words."""
    return F.transform(_starts(words, length), lambda i: F.xxhash64(F.lit(length), *[F.get(words, i + k) for k in range(length)]))


def window_minima(grams: Column, width: int) -> Column:
    """Minimum of every ``width`` consecutive hashes."""
    return F.transform(_starts(grams, width), lambda i: F.array_min(F.slice(grams, i + 1, F.lit(width))))


def _fingerprints(hashes: str, grams: str, lengths: list[int], cfg: DecontaminationConfig) -> Column:
    """Distinct fingerprints: winnowed for whole windows, all runs of a shorter item length."""
    parts = [window_minima(F.col(grams), cfg.window - cfg.gram + 1)] if cfg.window in lengths else []
    parts += [gram_hashes(F.col(hashes), n) for n in lengths if n != cfg.window]
    return F.array_distinct(F.concat(F.array().cast("array<bigint>"), *parts))


def _hashed(rows: DataFrame, words: Column, cfg: DecontaminationConfig) -> DataFrame:
    """Adds word hashes and k-gram hashes (each computed once, as columns)."""
    return (rows.withColumn("_w", F.transform(words, lambda w: F.xxhash64(F.lower(w))))
            .withColumn("_g", gram_hashes(F.col("_w"), cfg.gram)))


def benchmark_items(benchmark: DataFrame, cfg: DecontaminationConfig) -> DataFrame:
    """Distinct word sequences of the benchmark with their window length; ``item`` is the sequence as one string."""
    words = exact_words(F.col("text"))
    return (benchmark.select(F.col("item_id").cast("string").alias("item_id"), words.alias("words")).where(F.size("words") > 0)
            .withColumn("length", F.least(F.size("words"), F.lit(cfg.window)))
            .withColumn("item", F.array_join("words", " ")))


def _windows(length: Column) -> Column:
    return F.transform(F.sequence(F.lit(0), F.size("words") - length), lambda s: F.struct(s.alias("start"), F.array_join(F.slice("words", s + 1, length), " ").alias("window")))


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, cfg: DecontaminationConfig | None = None) -> DataFrame:
    """One row per document window that occurs in the benchmark: key columns, start, length, window."""
    cfg = cfg or DecontaminationConfig()
    ensure_checkpoint_dir(docs.sparkSession)
    items = benchmark_items(benchmark, cfg).select("item", "words", "length").distinct()
    lengths = sorted(r[0] for r in items.select("length").distinct().collect())  # at most `window` numbers
    prints = (_hashed(items, F.col("words"), cfg).select(F.explode(_fingerprints("_w", "_g", lengths or [cfg.window], cfg)).alias("print")).distinct())
    if prints.count() <= cfg.broadcast_fingerprints:
        prints = F.broadcast(prints)
    keyed = docs.select(F.col("doc_id").alias("k1"), F.xxhash64("text").alias("k2"), "text")
    hit = (_hashed(keyed, raw_words(F.col("text")), cfg)
           .select("k1", "k2", F.explode(_fingerprints("_w", "_g", lengths or [cfg.window], cfg)).alias("print"))
           .join(prints, "print", "left_semi").select("k1", "k2", "print").distinct())
    # The documents that share a fingerprint, once each, with the fingerprints that they share.
    hit = hit.groupBy("k1", "k2").agg(F.collect_set("print").alias("shared"))
    again = (keyed.join(hit.withColumnRenamed("k1", "h1").withColumnRenamed("k2", "h2"),
                        F.col("k1").eqNullSafe(F.col("h1")) & (F.col("k2") == F.col("h2"))).drop("h1", "h2")
             .withColumn("words", exact_words(F.col("text"))))
    again = _hashed(again, F.col("words"), cfg)
    found = []
    for n in lengths:
        mark = window_minima(F.col("_g"), cfg.window - cfg.gram + 1) if n == cfg.window else gram_hashes(F.col("_w"), n)
        marks = F.transform(mark, lambda m, i: F.struct(i.alias("start"), m.alias("mark")))
        around = (again.withColumn("_s", F.filter(marks, lambda m: F.array_contains("shared", m["mark"])))
                  .select("k1", "k2", F.explode(F.transform("_s", lambda m: F.struct(
                      m["start"].alias("start"), F.array_join(F.slice("words", m["start"] + 1, F.lit(n)), " ").alias("window")))).alias("at"))
                  .select("k1", "k2", "at.*", F.lit(n).alias("length")).distinct())
        own = (items.where(F.col("length") == n).select(F.explode(_windows(F.col("length"))).alias("at")).select("at.window").distinct())
        found.append(around.join(own, "window", "left_semi"))
    if not found:
        return keyed.where("false").selectExpr("k1", "k2", "0 as start", "'' as window", "0 as length")
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out.checkpoint()  # read several times; as large as the hits


def decontaminate(docs: DataFrame, benchmark: DataFrame, cfg: DecontaminationConfig | None = None) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items (sorted ids), contaminated.

    The columns ``k1`` and ``k2`` identify a row by its id and its text.
    """
    cfg = cfg or DecontaminationConfig()
    windows = contaminated_windows(docs, benchmark, cfg)
    items = benchmark_items(benchmark, cfg)
    hits = (windows.select("k1", "k2", F.explode(F.sequence("start", F.col("start") + F.col("length") - 1)).alias("at")).distinct()
            .groupBy("k1", "k2").agg(F.count("*").alias("n_hit")))
    of_window = (items.select("item", "words", "length").distinct()
                 .select("item", F.explode(_windows(F.col("length"))).alias("at")).select("item", "at.window").distinct())
    named = (windows.select("k1", "k2", "window").distinct().join(of_window, "window").select("k1", "k2", "item").distinct()
             .join(items.select("item", "item_id"), "item").groupBy("k1", "k2")
             .agg(F.array_sort(F.collect_set("item_id")).alias("items")))
    found = (hits.join(named, hits.k1.eqNullSafe(named.k1) & (hits.k2 == named.k2))
             .select(hits.k1.alias("h1"), hits.k2.alias("h2"), "n_hit", "items"))
    base = docs.select(F.col("doc_id").alias("k1"), F.xxhash64("text").alias("k2"), F.size(raw_words(F.col("text"))).cast("long").alias("n_words"))
    return (base.join(found, F.col("k1").eqNullSafe(F.col("h1")) & (F.col("k2") == F.col("h2")), "left")
            .select(F.col("k1").alias("doc_id"), "k2", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
                    F.coalesce("items", F.array().cast("array<string>")).alias("items"), F.col("n_hit").isNotNull().alias("contaminated")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, cfg: DecontaminationConfig | None = None) -> DataFrame:
    """The documents without a benchmark window, all columns unchanged."""
    windows = contaminated_windows(docs, benchmark, cfg).select(F.col("k1").alias("_k1"), F.col("k2").alias("_k2")).distinct()
    return docs.join(windows, docs["doc_id"].eqNullSafe(F.col("_k1")) & (F.xxhash64(docs["text"]) == F.col("_k2")), "left_anti")

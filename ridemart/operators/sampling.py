"""O8 exact-size seeded sample, exact quantiles and a top-k whose final merge stays small."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Hashes are below this.
HASH_SPAN = 2 ** 60


def hash_text(text: Column) -> Column:
    """A 60-bit hash that SQL engines reproduce exactly: the first 15 hex digits of the text's md5 as BIGINT."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def seeded_hash(cols: list, seed: int) -> Column:
    """The hash of ``seed|k1|k2|...``.  NULL keys are skipped, as ``concat_ws`` does."""
    return hash_text(F.concat_ws("|", F.lit(str(seed)), *[F.col(c).cast("string") for c in cols]))


def sample_rows(df: DataFrame, n: int, seed: int = 7, key_cols: list[str] | None = None,
                oversample: float = 1.5, total: int | None = None) -> DataFrame:
    """Exactly ``min(n, count)`` rows: those with the smallest seeded hash.

    The hash of ``key_cols`` is uniform over its range, so the n smallest
    hashes lie below the threshold that keeps about ``oversample * n`` rows.
    Rows under it are filtered in the scan stage; only that candidate set
    reaches the final ordered take, so the merge task sees about 1.5n rows
    whatever the table size.  If the threshold kept fewer than n rows it is
    raised, so the result is exact.  Ties on the hash are broken by the key
    columns, then by every other column, so the same seed always picks the
    same rows.  ``key_cols`` defaults to all columns; ``total`` is the row
    count when the caller already has it.
    """
    keys = list(key_cols or df.columns)
    order = keys + [c for c in df.columns if c not in keys]
    hashed = df.withColumn("_h", seeded_hash(keys, seed))
    total = df.count() if total is None else total
    if total <= n:
        return df
    frac = min(1.0, oversample * n / total)
    while frac < 1.0 and hashed.where(F.col("_h") < F.lit(int(frac * HASH_SPAN))).count() < n:
        frac = min(1.0, 2 * frac)
    candidates = hashed if frac >= 1.0 else hashed.where(F.col("_h") < F.lit(int(frac * HASH_SPAN)))
    return candidates.orderBy("_h", *order).limit(int(n)).drop("_h")


def order_statistics(df: DataFrame, col: str, ranks: list[int], bins: int = 4096) -> list[float]:
    """The values at 0-based ranks of a DOUBLE column, exactly, at any size.

    Rows are counted per bin of the value range; the bin holding a rank is
    split into bins again until it holds one value.  Each round is one
    aggregation of at most ``bins`` rows; nothing is sorted.
    """
    out = []
    base = df.select(F.col(col).cast("double").alias("v")).where("v is not null")
    for rank in ranks:
        rows, before = base, 0
        while True:
            low, high = rows.agg(F.min("v"), F.max("v")).first()
            if low == high:
                out.append(low)
                break
            step = (high - low) / bins
            which = F.least(F.floor((F.col("v") - low) / step), F.lit(bins - 1)) if step > 0 else (F.col("v") > low).cast("int")
            counted = rows.groupBy(which.alias("bin")).agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi")).collect()
            for r in sorted(counted, key=lambda r: r["lo"]):
                if before + r["n"] > rank:
                    break
                before += r["n"]
            rows = base.where((F.col("v") >= r["lo"]) & (F.col("v") <= r["hi"]))
    return out


def exact_quantile(df: DataFrame, col: str, q: float) -> float | None:
    """The q-quantile with linear interpolation between neighbouring ranks (NULL for no rows)."""
    n = df.where(F.col(col).isNotNull()).count()
    if not n:
        return None
    place = q * (n - 1)
    low = math.floor(place)
    values = order_statistics(df, col, sorted({low, min(low + 1, n - 1)}))
    return values[0] + (values[-1] - values[0]) * (place - low)


def top_k(df: DataFrame, k: int, score_col: str, tiebreak: list[str] | None = None,
          accuracy: int = 100_000) -> DataFrame:
    """The ``k`` rows with the highest ``score_col`` (ties by ``tiebreak``), exactly.

    ``orderBy(...).limit(k)`` sends k rows from every input partition into
    one merge task, which grows with the number of partitions.  Instead one
    pass gets the row count and a ladder of approximate upper quantiles
    (0.9, 0.99, ...; rank error at most rows/accuracy).  The highest rung
    expected to keep at least 2k rows becomes a score threshold; rows under
    it are dropped where they are and the ordered take runs on the rest.
    If fewer than k rows reach a rung the next lower one is taken, down to no
    threshold, so the result is exact.
    """
    tiebreak = tiebreak or []
    order = [F.desc(score_col)] + [F.col(c) for c in tiebreak]
    ladder = [1.0 - 10.0 ** -e for e in range(1, 10)]
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   F.percentile_approx(score_col, ladder, accuracy).alias("q")).first()
    n, qs = stats["n"], stats["q"] or []
    rungs = [t for q, t in zip(ladder, qs) if (1.0 - q) * n >= 2 * k and t is not None]
    while rungs and df.where(F.col(score_col) >= F.lit(rungs[-1])).count() < min(k, n):
        rungs.pop()
    cand = df.where(F.col(score_col) >= F.lit(rungs[-1])) if rungs else df
    return cand.orderBy(*order).limit(int(k))

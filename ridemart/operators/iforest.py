"""Isolation forest on Spark (N2-N5): trees grown level by level, rows scored in Arrow batches.

Isolation forests (Liu, Ting and Zhou, 2008) isolate points with random
axis-aligned cuts; anomalies need fewer cuts.  Each tree sees only
``max_samples`` (256) rows, so the build never needs the table in one
place:

1. every row draws its trees in the scan: a seeded hash keeps it for a tree
   with the probability that gives each tree about ``1.5 * max_samples``
   rows, so about ``1.5 * trees * max_samples`` rows leave the scan however
   large the table is,
2. they go to their tree's partition, which keeps the ``max_samples``
   smallest hashes (an exact sample without replacement),
3. all trees grow together, one level after the other: per (tree, node) the
   count and every feature's minimum and maximum; the split feature and the
   threshold between its minimum and maximum follow from a hash of (tree,
   node) that any SQL engine prints alike.  The rows stay in their tree's
   partition, so a level moves nothing,
4. the node table (at most ``trees * (2 * max_samples - 1)`` rows) goes to the
   tasks as arrays, and the rows of a batch walk each tree together, one level
   after the other.

Thresholds lie between a node's own values, so shifting and scaling a
feature changes no tree: the raw features serve as well as z-scores (N2).

Score s(x) = 2 ** (-E[h(x)] / c(max_samples)), in (0, 1], higher is odder.
Path lengths are added as whole multiples of 2**-44, so the sum of a row's
trees does not depend on their order.
"""

from __future__ import annotations

import math
import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridemart.constants import EULER_GAMMA
from ridemart.operators.sampling import HASH_SPAN, exact_quantile, hash_text, seeded_hash

# Executors need numpy, pandas and Arrow, not this package on their path: its task functions travel by value.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Parts of a path length that is 1.
PATH_UNIT = 1 << 44


def avg_path_length(n: float) -> float:
    """c(n): average path length of an unsuccessful BST search over n points."""
    if n <= 1:
        return 0.0
    if n == 2:
        return 1.0
    return 2.0 * (math.log(n - 1.0) + EULER_GAMMA) - 2.0 * (n - 1.0) / n


def feature_stats(df: DataFrame, features: list[str]) -> tuple[list[float], list[float], int]:
    """Per-feature mean and population std (0 -> 1), plus the row count, in one pass."""
    stats = df.agg(F.count(F.lit(1)).alias("n"),
                   *[F.avg(c).alias(f"m{i}") for i, c in enumerate(features)],
                   *[F.stddev_pop(c).alias(f"s{i}") for i, c in enumerate(features)]).first()
    center = [float(stats[f"m{i}"] or 0.0) for i in range(len(features))]
    scale = [float(stats[f"s{i}"] or 0.0) or 1.0 for i in range(len(features))]
    return center, scale, int(stats["n"])


def with_z(df: DataFrame, features: list[str], center: list[float],
           scale: list[float]) -> tuple[DataFrame, list[str]]:
    """Z-score columns ``_z_<feature>`` = (x - mean) / std."""
    zcols = [f"_z_{c}" for c in features]
    return df.withColumns({z: (F.col(c) - F.lit(m)) / F.lit(sd)
                           for z, c, m, sd in zip(zcols, features, center, scale)}), zcols


def standardize(df: DataFrame, features: list[str]) -> tuple[DataFrame, list[str], int]:
    """Z-scores with population std (std 0 leaves values centred only)."""
    center, scale, n = feature_stats(df, features)
    z, zcols = with_z(df, features, center, scale)
    return z, zcols, n


def tree_samples(df: DataFrame, features: list[str], trees: int, psi: int, seed: int, keys: list[str], rows: int) -> DataFrame:
    """Step 1 and 2: ``(tree_id, x)`` of exactly ``psi`` rows per tree (about that many where a tree drew fewer)."""
    wanted = 1.5 * trees * psi / rows  # trees per row
    copies = min(trees, max(1, math.ceil(wanted)))
    share = min(1.0, wanted / copies)
    drawn = df.select(F.array(*[F.col(c).cast("double") for c in features]).alias("x"), seeded_hash(keys, seed).alias("_own"))
    drawn = drawn.withColumn("_copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))) if copies > 1 else F.lit(0))
    drawn = drawn.withColumn("tree_id", ((F.col("_own") % trees + F.col("_copy")) % trees).cast("int"))
    drawn = drawn.withColumn("_h", hash_text(F.concat_ws("|", F.lit("sample"), F.lit(str(seed)), "_own", "tree_id")))
    kept = drawn.where(F.col("_h") < F.lit(math.floor(share * HASH_SPAN)).cast("long"))
    # Few rows (about 1.5 x trees x psi); the explicit count keeps AQE from growing all trees in one task.
    tasks = max(1, min(trees, df.sparkSession.sparkContext.defaultParallelism))
    by_hash = Window.partitionBy("tree_id").orderBy("_h", "_own", "x")
    return (kept.repartition(tasks, "tree_id").withColumn("_place", F.row_number().over(by_hash))
            .where(F.col("_place") <= psi).select("tree_id", "x"))


def split_columns(n_features: int, seed: int) -> list[tuple[str, Column]]:
    """The columns that decide a node's split, in order, from its count and its features' ranges ``lo`` and ``hi``."""
    def draw(purpose: str) -> Column:
        return hash_text(F.concat_ws("|", F.lit(purpose), F.lit(str(seed)), "tree_id", "node_id"))

    varying = F.filter(F.sequence(F.lit(0), F.lit(n_features - 1)), lambda i: F.get("hi", i) > F.get("lo", i))
    low, high = F.get("lo", F.col("feature")), F.get("hi", F.col("feature"))
    share = (draw("threshold") + 1).cast("double") / float(HASH_SPAN)
    return [
        ("_varying", varying),
        ("feature", F.when((F.col("size") > 1) & (F.size("_varying") > 0),
                           F.get("_varying", (draw("feature") % F.greatest(F.size("_varying"), F.lit(1))).cast("int")))),
        ("_at", F.least(low + share * (high - low), high)),
        # Both sides must keep a row: a threshold that rounding left at the minimum becomes the maximum.
        ("threshold", F.when(F.col("_at") > low, F.col("_at")).otherwise(high)),
    ]


def grown(samples: DataFrame, n_features: int, depth: int, seed: int) -> DataFrame:
    """Step 3: ``(tree_id, node_id, feature, threshold, size)`` of every node; leaves have no feature.

    Node k has children 2k+1 and 2k+2, the root is 0.
    """
    rows = samples.withColumn("node_id", F.lit(0)).withColumn("path", F.array().cast("array<struct<node_id:int,feature:int,threshold:double>>"))
    here = Window.partitionBy("tree_id", "node_id")
    for _ in range(depth):
        rows = rows.select("tree_id", "x", "node_id", "path", F.count(F.lit(1)).over(here).alias("size"),
                           F.array(*[F.min(F.col("x")[i]).over(here) for i in range(n_features)]).alias("lo"),
                           F.array(*[F.max(F.col("x")[i]).over(here) for i in range(n_features)]).alias("hi"))
        for name, column in split_columns(n_features, seed):
            rows = rows.withColumn(name, column)
        child = 2 * F.col("node_id") + F.when(F.get("x", F.col("feature")) < F.col("threshold"), 1).otherwise(2)
        split = F.col("feature").isNotNull()
        rows = rows.select(
            "tree_id", "x", F.when(split, child).otherwise(F.col("node_id")).cast("int").alias("node_id"),
            F.when(split, F.array_append("path", F.struct(F.col("node_id"), F.col("feature"), F.col("threshold")))).otherwise(F.col("path")).alias("path"))
    leaf = F.struct("node_id", F.lit(None).cast("int").alias("feature"), F.lit(None).cast("double").alias("threshold"))
    nodes = rows.select("tree_id", F.explode(F.array_append("path", leaf)).alias("node"))
    return nodes.groupBy("tree_id", "node.node_id", "node.feature", "node.threshold").agg(F.count(F.lit(1)).alias("size"))


def fit_forest(df: DataFrame, features: list[str], trees: int = 200, max_samples: int = 256,
               seed: int = 7, key_cols: list[str] | None = None, rows: int | None = None) -> pd.DataFrame:
    """Grow ``trees`` isolation trees; returns the (bounded) node table.

    Internal nodes have ``leaf_path`` NaN, leaves have feature -1 and
    ``leaf_path = depth + c(size)``.
    """
    n = df.count() if rows is None else rows
    if n == 0:
        raise ValueError("no rows to fit the isolation forest on")
    psi = min(max_samples, n)
    depth = int(math.ceil(math.log2(max(psi, 2))))
    samples = tree_samples(df, features, trees, psi, seed, key_cols or features, n)
    found = grown(samples, len(features), depth, seed).toPandas().sort_values(["tree_id", "node_id"], ignore_index=True)
    leaf = found["feature"].isna().to_numpy()
    node = found["node_id"].to_numpy()
    level = np.floor(np.log2(node + 1)).astype(int)
    path = [d + avg_path_length(int(s)) if end else math.nan for d, s, end in zip(level, found["size"], leaf)]
    out = pd.DataFrame({
        "tree_id": found["tree_id"].astype("int32"), "node_id": node.astype("int32"), "feature": found["feature"].fillna(-1).astype("int32"),
        "threshold": found["threshold"], "left_child": np.where(leaf, -1, 2 * node + 1).astype("int32"),
        "right_child": np.where(leaf, -1, 2 * node + 2).astype("int32"), "leaf_path": path})
    out.attrs["max_samples"] = psi
    return out


#: Rows that walk a tree together; what a step reads and writes for so many stays in a core's cache.
WALK_ROWS = 4096


def _ordered(values: np.ndarray) -> np.ndarray:
    """Doubles as integers of the same order, as Spark compares them: -0.0 equals 0.0, NaN is greater than all."""
    bits = np.where(np.isnan(values), np.nan, values + 0.0).view(np.int64)
    return bits ^ ((bits >> 63) & np.int64(0x7FFFFFFFFFFFFFFF))


def _full_trees(nodes: pd.DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(feature and threshold of every node, path length of every end, levels) of the trees, all filled up to one depth.

    Node k has children 2k+1 and 2k+2.  What lies below a leaf has the leaf's
    length, so a walk that goes on below it ends with the right one.
    """
    tree = np.unique(nodes["tree_id"], return_inverse=True)[1]
    node = nodes["node_id"].to_numpy().astype(np.int64)
    depth = int(node.max() + 1).bit_length() - 1
    feature = np.zeros((tree.max() + 1, (2 << depth) - 1), np.int64)
    threshold, length = np.zeros(feature.shape, np.int64), np.zeros(feature.shape, np.int64)
    leaf = nodes["feature"].to_numpy() < 0
    feature[tree[~leaf], node[~leaf]] = nodes["feature"].to_numpy()[~leaf]
    threshold[tree[~leaf], node[~leaf]] = _ordered(nodes["threshold"].to_numpy(np.float64)[~leaf])
    length[tree[leaf], node[leaf]] = [0 if math.isnan(p) else round(p * PATH_UNIT) for p in nodes["leaf_path"].to_numpy()[leaf]]
    ends = np.zeros(feature.shape, bool)
    ends[tree[leaf], node[leaf]] = True
    for k in range((1 << depth) - 1):
        for child in (2 * k + 1, 2 * k + 2):
            length[ends[:, k], child] = length[ends[:, k], k]
            ends[ends[:, k], child] = True
    return feature, threshold, length[:, (1 << depth) - 1:], depth


def _walk(x: np.ndarray, feature: np.ndarray, threshold: np.ndarray, length: np.ndarray, depth: int) -> np.ndarray:
    """Path lengths through all trees, added up, of rows given as one array of ``_ordered`` values a feature."""
    n = x.shape[1]
    total, row = np.zeros(n, np.int64), np.arange(n)
    flat, at = np.ascontiguousarray(x).ravel(), feature * n
    for t in range(len(feature)):
        place = np.zeros(n, np.int64)
        for _ in range(depth):
            left = flat.take(at[t].take(place) + row) < threshold[t].take(place)
            place = 2 * place + 2 - left
        total += length[t].take(place - ((1 << depth) - 1))
    return total


def walked(features: list[str], nodes: pd.DataFrame) -> Column:
    """A row's path lengths through all trees, added up in units of ``1 / PATH_UNIT``."""
    feature, threshold, length, depth = _full_trees(nodes)

    def add_up(*columns: pd.Series) -> pd.Series:
        x = np.stack([_ordered(c.to_numpy(np.float64, na_value=np.nan)) for c in columns])
        parts = [_walk(x[:, a:a + WALK_ROWS], feature, threshold, length, depth) for a in range(0, x.shape[1], WALK_ROWS)]
        return pd.Series(np.concatenate(parts) if parts else np.zeros(0, np.int64))

    return F.pandas_udf(add_up, "long")(*[F.col(c).cast("double") for c in features])


def score(df: DataFrame, features: list[str], nodes: pd.DataFrame, score_col: str = "anomaly_score") -> DataFrame:
    """Add ``score_col`` = 2 ** (-E[h] / c(psi)) to every row."""
    c_psi = avg_path_length(nodes.attrs.get("max_samples", 256))
    if c_psi <= 0:
        return df.withColumn(score_col, F.lit(1.0))
    mean = walked(features, nodes).cast("double") / float(PATH_UNIT) / float(nodes["tree_id"].nunique())
    return df.withColumn(score_col, F.pow(F.lit(2.0), -mean / F.lit(c_psi)))


def contamination_threshold(scored: DataFrame, contamination: float, score_col: str = "anomaly_score") -> float | None:
    """Score above which a row is an outlier: the exact, interpolated 1-contamination quantile."""
    return exact_quantile(scored, score_col, 1.0 - contamination)

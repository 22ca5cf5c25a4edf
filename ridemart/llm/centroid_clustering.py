"""Centroid clustering in exact integers, with centroids filtered by n-simplex projection.

A vector's distances to a few pivots fix its place above the simplex that the
pivots span: the coordinates of the apex of that simplex.  For two apexes the
Euclidean distance is a lower bound of the distance of the vectors, and the
same with one apex mirrored below the base is an upper bound.  The apex of
every vector is computed once and kept in a table; in each round it is set
against the apexes of the centroids, and a centroid whose lower bound lies
above the least upper bound cannot be the nearest.  Those that are left are
compared by exact squared distance of integers.

Bounds are floating point; a relative ``slack`` far above their rounding error
keeps a centroid rather than lose it, so the result is the exact one.

Only centroids, pivots and one sum per cluster reach the driver: ``clusters``
rows of ``dims`` numbers, whatever the table's size.  A task sends one partial
sum per cluster.

Edge cases: a vector that is null, has another number of components, or has a
null or non-finite component is not kept and has no row; repeated rows are kept
as often as they occur, each with its own row; a null id is hashed as an empty
text and carried through; fewer kept vectors than clusters make as many
clusters as vectors; equal vectors among the first centroids are allowed (the
smaller number wins every tie, the other stays where it is); an empty table
gives an empty result; other columns are not read.  A component beyond 2**27
after scaling is an error, since squared distances would leave a long.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.llm.cluster import shared_folder, written

#: Components up to here have squared distances (64 of them) that fit a long.
LARGEST = 1 << 27


@dataclass(frozen=True)
class ClusteringConfig:
    dims: int = 64
    scale: float = 64.0
    clusters: int = 16
    rounds: int = 3
    seed: str = "1"
    pivots: int = 8
    #: A pivot that rises less than this share above the base adds nothing but rounding error.
    least_altitude: float = 0.05
    slack: float = 1e-6


class Simplex:
    """Base simplex of the pivots, and apex coordinates above it from distances alone."""

    def __init__(self, candidates: np.ndarray, cfg: ClusteringConfig):
        """Pivots are chosen among ``candidates`` farthest from the base so far, at most ``cfg.pivots``."""
        chosen = [0]
        self.base = np.zeros((1, 0))
        self.pivots = candidates[:1]
        while len(chosen) < min(cfg.pivots, len(candidates)):
            apexes = self.apexes(candidates)
            far = int(apexes[:, -1].argmax())
            if apexes[far, -1] <= cfg.least_altitude * max(1.0, np.abs(apexes).max()):
                break
            chosen.append(far)
            self.base = np.vstack([np.pad(self.base, ((0, 0), (0, 1))), apexes[far]])
            self.pivots = candidates[chosen]

    def distances(self, v: np.ndarray) -> np.ndarray:
        """Squared distances to the pivots, in exact integers."""
        out = np.empty((len(v), len(self.pivots)), np.int64)
        for k, pivot in enumerate(self.pivots):
            d = v - pivot
            out[:, k] = (d * d).sum(axis=1)
        return out

    def apexes(self, v: np.ndarray) -> np.ndarray:
        """Coordinates in the space of the base, one column each, and last the altitude above it.

        The base is lower triangular with its first pivot at the origin, so the
        coordinates follow one after the other from differences of squared distances.
        """
        squared = self.distances(v).astype(float)
        n = len(self.base)
        out = np.zeros((len(v), n))
        for i in range(1, n):
            edge = self.base[i]
            half = (squared[:, 0] - squared[:, i] + edge @ edge) / 2
            out[:, i - 1] = (half - out[:, :i - 1] @ edge[:i - 1]) / edge[i - 1]
        rest = squared[:, 0] - (out * out).sum(axis=1)
        out[:, n - 1] = np.sqrt(np.maximum(rest, 0))
        return out


def survivors(apexes: np.ndarray, centres: np.ndarray, slack: float) -> np.ndarray:
    """Mask (rows x centroids): False where the bounds show that another centroid is nearer."""
    flat = ((apexes[:, None, :-1] - centres[None, :, :-1]) ** 2).sum(axis=2)
    up, down = apexes[:, None, -1], centres[None, :, -1]
    lower, upper = flat + (up - down) ** 2, flat + (up + down) ** 2
    size = (apexes ** 2).sum(axis=1)[:, None] + (centres ** 2).sum(axis=1).max() + 1.0
    return lower <= upper.min(axis=1, keepdims=True) + slack * size


def nearest(v: np.ndarray, apexes: np.ndarray, centroids: np.ndarray, centres: np.ndarray, slack: float) -> tuple[np.ndarray, np.ndarray]:
    """Nearest centroid (ties: smaller number) and squared distance of every row, exactly."""
    left = survivors(apexes, centres, slack)
    best = np.full(len(v), -1, np.int32)
    least = np.full(len(v), np.iinfo(np.int64).max)
    for k in range(len(centroids)):
        rows = np.flatnonzero(left[:, k])
        d = v[rows] - centroids[k]
        d = (d * d).sum(axis=1)
        nearer = d < least[rows]
        rows = rows[nearer]
        best[rows], least[rows] = k, d[nearer]
    return best, least


def _matrix(column: pa.Array, dtype) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(dtype, copy=False)
    return values.reshape(len(column), -1) if len(column) else np.zeros((0, 0), dtype)


def _lists(values: np.ndarray) -> pa.Array:
    offsets = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(offsets, values.ravel())


def kept_vectors(vectors: DataFrame, cfg: ClusteringConfig) -> DataFrame:
    """(vec_id, v) of the vectors that take part, components as integers."""
    x = F.col("embedding")
    bad = F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = vectors.select("vec_id", "embedding").where((F.size(x) == cfg.dims) & ~bad)
    return kept.select("vec_id", F.transform(x, lambda c: F.floor(c.cast("double") * cfg.scale)).alias("v"))


def _checked(v: np.ndarray) -> np.ndarray:
    if len(v) and np.abs(v).max() > LARGEST:
        raise ValueError(f"a component is beyond {LARGEST} after scaling; squared distances would not fit a long")
    return v


def _with_apexes(points: DataFrame, simplex: Simplex) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), _lists(simplex.apexes(_checked(_matrix(b.column(1), np.int64))))], ["vec_id", "v", "apex"])
    return points.mapInArrow(add, "vec_id long, v array<long>, apex array<double>")


def _sums(points: DataFrame, centroids: np.ndarray, simplex: Simplex, cfg: ClusteringConfig) -> dict[int, tuple[int, list[int]]]:
    """Per cluster (rows, componentwise sums) of the vectors nearest to it."""
    centres = simplex.apexes(centroids)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = np.zeros(len(centroids), np.int64)
        total = np.zeros(centroids.shape, np.int64)
        for b in batches:
            if b.num_rows:
                v = _matrix(b.column("v"), np.int64)
                best, _ = nearest(v, _matrix(b.column("apex"), float), centroids, centres, cfg.slack)
                n += np.bincount(best, minlength=len(n))
                np.add.at(total, best, v)
        used = np.flatnonzero(n)
        if len(used):
            yield pa.RecordBatch.from_arrays([pa.array(used.astype(np.int32)), pa.array(n[used]), _lists(total[used])], ["cluster", "n", "total"])

    parts = points.mapInArrow(partial, "cluster int, n long, total array<long>")
    rows = parts.groupBy("cluster").agg(F.sum("n").alias("n"), F.array(*[F.sum(F.col("total")[i]) for i in range(cfg.dims)]).alias("total")).collect()
    return {r["cluster"]: (r["n"], r["total"]) for r in rows}


def cluster_vectors(vectors: DataFrame, cfg: ClusteringConfig = ClusteringConfig()) -> tuple[DataFrame, np.ndarray]:
    """(vec_id, cluster, distance) of every kept vector as a written table, and the final centroids.

    The first centroids are the kept vectors with the smallest sha256 of ``seed:vec_id``.
    """
    spark = vectors.sparkSession
    folder = shared_folder(spark, "clusters")
    points = kept_vectors(vectors, cfg)
    key = F.sha2(F.concat(F.lit(f"{cfg.seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))), 256)
    first = points.orderBy(key, "v").limit(cfg.clusters).collect()  # as many rows as clusters
    if not first:
        return spark.createDataFrame([], "vec_id long, cluster int, distance long"), np.zeros((0, cfg.dims), np.int64)
    centroids = _checked(np.array([r["v"] for r in first], np.int64))
    simplex = Simplex(centroids, cfg)
    points = written(_with_apexes(points, simplex), folder, "points")
    for _ in range(cfg.rounds):
        for k, (n, total) in _sums(points, centroids, simplex, cfg).items():
            centroids[k] = [t // n for t in total]
    centres = simplex.apexes(centroids)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                best, least = nearest(_matrix(b.column("v"), np.int64), _matrix(b.column("apex"), float), centroids, centres, cfg.slack)
                yield pa.RecordBatch.from_arrays([b.column("vec_id"), pa.array(best), pa.array(least)], ["vec_id", "cluster", "distance"])

    return written(points.mapInArrow(assign, "vec_id long, cluster int, distance long"), folder, "assigned"), centroids


def cluster_report(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The assigned rows with their cluster's inertia, the whole inertia and a digest of the centroid."""
    spark = assigned.sparkSession
    per = {r["cluster"]: r["d"] for r in assigned.groupBy("cluster").agg(F.sum("distance").alias("d")).collect()}  # a row per cluster
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    rows = [(k, per.get(k, 0), sum(per.values()), d) for k, d in enumerate(digests)]
    report = spark.createDataFrame(rows, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return assigned.join(F.broadcast(report), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")

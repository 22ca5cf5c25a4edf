import hashlib
import math

import numpy as np
import pytest

from ridemart.llm import centroid_clustering as C

SF = "/root/testdata/sf0.01"


def brute(rows, cfg):
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) by comparing every centroid with every vector."""
    kept = [(i, [math.floor(cfg.scale * float(x)) for x in v]) for i, v in rows
            if v is not None and len(v) == cfg.dims and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"{cfg.seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cents = [list(v) for _, v in order[:cfg.clusters]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(v, c)), k) for k, c in enumerate(cents)) for _, v in kept]
    for _ in range(cfg.rounds):
        by = {}
        for (_, v), (_, k) in zip(kept, assign()):
            by.setdefault(k, []).append(v)
        for k, vs in by.items():
            cents[k] = [sum(col) // len(vs) for col in zip(*vs)]
    last = assign()
    inertia = {}
    for d, k in last:
        inertia[k] = inertia.get(k, 0) + d
    return sorted(((i, k, d, inertia[k], sum(inertia.values()), hashlib.sha256(",".join(map(str, cents[k])).encode()).hexdigest())
                   for (i, _), (d, k) in zip(kept, last)), key=str)


def run(spark, rows, cfg, parts=3):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<float>, cluster int, v int").repartition(parts)
    return sorted((tuple(r) for r in C.cluster_report(*C.cluster_vectors(df, cfg)).collect()), key=str)


def test_edges(spark):
    cfg = C.ClusteringConfig(dims=3, clusters=4, scale=1.0, pivots=3)
    rng = np.random.default_rng(1)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.integers(-3, 4, (60, 3)))]
    rows += [(100, None), (101, [1.0, 2.0]), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [1.0, float("inf"), 2.0]), (105, []),
             (None, [1.5, -0.5, 2.0]), (7, rows[7][1]), (7, rows[7][1]), (8, [9.0, 9.0, 9.0])]
    assert run(spark, rows, cfg) == brute(rows, cfg)
    assert run(spark, rows[:2], cfg, 1) == brute(rows[:2], cfg)
    same = [(i, [1.0, 1.0, 1.0]) for i in range(20)]
    assert run(spark, same, cfg) == brute(same, cfg)
    assert run(spark, [], cfg) == [] and run(spark, rows[60:66], cfg) == []
    with pytest.raises(Exception, match="beyond"):
        run(spark, [(1, [1e12, 0.0, 0.0])], cfg)


@pytest.mark.parametrize("seed", range(4))
def test_filter_loses_no_nearest_centroid_and_saves_work(seed):
    rng = np.random.default_rng(seed)
    cfg = C.ClusteringConfig()
    blobs = rng.normal(0, 300, (16, 64))
    v = np.floor(blobs[rng.integers(0, 16, 3000)] + rng.normal(0, 20, (3000, 64))).astype(np.int64)
    cents = v[rng.choice(3000, 16, replace=False)]
    cents[3] = cents[5]  # a tie
    s = C.Simplex(cents, cfg)
    assert len(s.pivots) >= 4
    left = C.survivors(s.apexes(v), s.apexes(cents), cfg.slack)
    exact = ((v[:, None, :] - cents[None]) ** 2).sum(axis=2)
    assert (left | (exact > exact.min(axis=1, keepdims=True))).all()
    assert left.mean() < 0.7
    best, least = C.nearest(v, s.apexes(v), cents, s.apexes(cents), cfg.slack)
    assert (best == exact.argmin(axis=1)).all() and (least == exact.min(axis=1)).all()


def test_whole_table(spark):
    cfg = C.ClusteringConfig()
    df = spark.read.parquet(f"{SF}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.select("vec_id", "embedding").collect()]
    assert run(spark, rows, cfg) == brute(rows, cfg)

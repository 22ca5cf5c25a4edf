"""The histogram booster (T5) against plain loops over rows, features and cuts."""

import math

import numpy as np
import pytest

from ridemart.operators.boosting import TIE, BoostingConfig, bin_edges, boost


def plain_boost(x, y, train, cfg):
    """Every cut of every leaf tried by going through the rows."""
    n, width = len(y), len(x[0])
    fit = [i for i in range(n) if train[i]]
    edges = [list(bin_edges(np.array([x[i][f] for i in fit]), cfg.bins)) for f in range(width)]
    pred = [math.fsum(y[i] for i in fit) / len(fit)] * n

    def left_of(i, f, edge, missing_left):
        return missing_left if math.isnan(x[i][f]) else edge is None or x[i][f] <= edge

    for _ in range(cfg.trees):
        g = [pred[i] - y[i] for i in range(n)]

        def best(rows):
            total, count = math.fsum(g[i] for i in rows), len(rows)
            parent = total ** 2 / (count + cfg.l2)
            options = []
            for missing_left in (False, True):
                for f in range(width):
                    for edge in [*edges[f], None]:
                        a = [i for i in rows if left_of(i, f, edge, missing_left)]
                        if cfg.min_leaf <= len(a) <= count - cfg.min_leaf:
                            ga = math.fsum(g[i] for i in a)
                            options.append((ga ** 2 / (len(a) + cfg.l2) + (total - ga) ** 2 / (count - len(a) + cfg.l2), f, edge, missing_left))
            top = max((o[0] for o in options), default=-1.0)
            if top <= parent * (1 + TIE):
                return None
            return (top - parent, *next(o for o in options if o[0] >= top * (1 - TIE))[1:])

        leaves, made = [], 0

        def leaf(everyone, depth):
            nonlocal made
            rows = [i for i in everyone if train[i]]
            leaves.append((everyone, depth, made, best(rows) if depth < cfg.depth and len(rows) >= 2 * cfg.min_leaf else None))
            made += 1

        leaf(list(range(n)), 0)
        while len(leaves) < cfg.leaves:
            open_ = [x_ for x_ in leaves if x_[3]]
            if not open_:
                break
            chosen = min(open_, key=lambda x_: (-float(f"{x_[3][0]:.9e}"), x_[2]))
            leaves.remove(chosen)
            everyone, depth, _, (_, f, edge, missing_left) = chosen
            leaf([i for i in everyone if left_of(i, f, edge, missing_left)], depth + 1)
            leaf([i for i in everyone if not left_of(i, f, edge, missing_left)], depth + 1)
        for everyone, _, _, _ in leaves:
            rows = [i for i in everyone if train[i]]
            value = -cfg.rate * math.fsum(g[i] for i in rows) / (len(rows) + cfg.l2)
            for i in everyone:
                pred[i] += value
    return pred


@pytest.mark.parametrize("seed,cfg", [(0, BoostingConfig(12, 0.3, 3, 31, 255, 5, 1.0)), (1, BoostingConfig(10, 0.06, 7, 6, 8, 3, 2.5)),
                                      (2, BoostingConfig(6, 1.0, 7, 31, 16, 1, 0.0)), (3, BoostingConfig(4, 0.1, 7, 31, 255, 40, 1.0))])
def test_equals_plain_loops(seed, cfg):
    rng = np.random.default_rng(seed)
    n = 90
    t = np.arange(n)
    x = np.column_stack([t % 24, np.round(np.sin(t / 4), 3), rng.integers(0, 5, n), t.astype(float), np.zeros(n)])
    x[:30, 2] = np.nan
    x[rng.integers(0, n, 10), 1] = np.nan
    y = (t % 24 > 12) * 5.0 + np.nan_to_num(x[:, 2], nan=9.0) + rng.integers(0, 3, n)
    train = t < 75
    got = boost(x, y, train, cfg)
    want = plain_boost([[float(v) for v in r] for r in x], [float(v) for v in y], [bool(v) for v in train], cfg)
    assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_missing_values_take_the_better_side():
    x = np.array([[np.nan]] * 30 + [[1.0]] * 30 + [[2.0]] * 30)
    y = np.array([7.0] * 30 + [1.0] * 30 + [7.0] * 30)
    got = boost(x, y, np.ones(90, bool), BoostingConfig(200, 0.2, 1, 2, 255, 5, 0.0))
    assert np.allclose(got, y, atol=1e-6)  # one cut is enough when missing values go with the large ones


def test_many_distinct_values_share_bins():
    edges = bin_edges(np.concatenate([np.arange(10_000.0), [np.nan]]), 255)
    assert len(edges) == 254 and (np.diff(edges) > 0).all()
    sizes = np.diff(np.searchsorted(np.arange(10_000.0), edges))
    assert sizes.min() >= 38 and sizes.max() <= 41


def test_all_fits_are_one_job_and_equal_plain_loops(spark):
    from pyspark.sql import functions as F

    from ridemart.operators import forecast
    from ridemart.operators.series import FEATURE_COLUMNS, design_matrix
    from support import shown_settings

    s = shown_settings().replace(forecast={"max_iter": 2, "folds": 1, "min_leaf": 60})
    hours = spark.range(1200).select(
        F.when(F.col("id") < 600, "yellow").otherwise("green").alias("fleet"),
        F.timestamp_add("HOUR", (F.col("id") % 600).cast("int"), F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")).alias("ds"))
    series = hours.withColumn("y", (F.hour("ds") * 3 + F.weekday("ds") + F.pmod(F.xxhash64("ds", "fleet"), F.lit(4))).cast("double")).repartition(5)
    rows = design_matrix(series).orderBy("fleet", "ds").toPandas()
    pred = {(r.fleet, r.fold, r.t): r for r in forecast.predictions(series, s).collect()}
    assert {k[:2] for k in pred} == {(f, k) for f in ("yellow", "green") for k in (-1, 0)}
    for (fleet, fold), cut, stop in [((f, k), c, 600) for f in ("yellow", "green") for k, c in ((-1, 432), (0, 576))]:
        part = rows[rows.fleet == fleet].reset_index(drop=True)[:stop]
        train = [t < cut for t in range(stop)]
        want = plain_boost(part[FEATURE_COLUMNS].astype(float).values.tolist(), part["y"].tolist(), train, forecast.boosting_config(s))
        got = [pred[fleet, fold, t] for t in range(stop)]
        assert np.allclose([r.raw_pred for r in got], want, rtol=0, atol=1e-9)
        assert [r.is_test for r in got] == [not t for t in train]

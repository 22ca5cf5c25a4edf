"""Anomaly rules (N6-N11), sampling (O8) and the isolation forest."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from ridemart.operators import anomaly, iforest
from ridemart.operators.sampling import sample_rows

from support import shown_settings as fixture_settings


def test_rule_reasons_for_hand_rows(spark):
    df = spark.createDataFrame(
        [(2.0, 10.0, 2.0, 15.0), (0.0, 12.0, 1.0, 20.0), (1.0, 0.0, 0.0, 10.0), (0.5, 80.0, 1.0, 120.0),
         (1.0, 4.0, 7.0, None)],
        "trip_distance double, fare_amount double, tip_amount double, avg_speed_mph double")
    got = [r.rules for r in anomaly.with_rules(df).collect()]
    assert got == ["", "zero_distance", "zero_fare", "implausible_speed,fare_distance_mismatch",
                   "tip_exceeds_fare"]


def test_rule_summary_matches_fixture_table(inputs001, settings):
    rows = anomaly.scoring_input(inputs001.fact(), settings)
    s = {r.rule: r["count"] for r in anomaly.rule_summary(rows).collect()}
    # FIXTURES.md part B, sf0.001 row.
    assert s == {"zero_distance": 21, "zero_fare": 1, "implausible_speed": 28,
                 "fare_distance_mismatch": 8, "tip_exceeds_fare": 78}


def test_sample_exact_seeded(spark):
    df = spark.range(10000).select(F.col("id"), (F.col("id") % 7).alias("g"))
    a = sorted(r.id for r in sample_rows(df, 500, seed=3).collect())
    b = sorted(r.id for r in sample_rows(df.repartition(7), 500, seed=3).collect())
    c = sorted(r.id for r in sample_rows(df, 500, seed=4).collect())
    assert len(a) == 500 and a == b and a != c
    assert sample_rows(df, 20000).count() == 10000


def test_path_length_constant():
    assert iforest.avg_path_length(1) == 0.0 and iforest.avg_path_length(2) == 1.0
    assert abs(iforest.avg_path_length(256) - 10.2448) < 1e-3


@pytest.fixture(scope="module")
def forest_input(spark):
    import numpy as np

    rng = np.random.default_rng(0)
    x = rng.normal(size=(3000, 3))
    x[0] = [12.0, -11.0, 14.0]  # one extreme point
    pdf = pd.DataFrame(x, columns=["a", "b", "c"])
    pdf.insert(0, "trip_id", range(1, 3001))
    return spark.createDataFrame(pdf)


def test_forest_scores_and_flags(spark, forest_input):
    nodes = iforest.fit_forest(forest_input, ["a", "b", "c"], trees=50, max_samples=128, seed=7,
                               key_cols=["trip_id"])
    assert nodes.tree_id.nunique() == 50 and len(nodes) <= 50 * 255
    scored = iforest.score(forest_input, ["a", "b", "c"], nodes).cache()
    s = scored.agg(F.min("anomaly_score"), F.max("anomaly_score")).first()
    assert 0 < s[0] and s[1] <= 1
    thr = iforest.contamination_threshold(scored, 0.01)
    flagged = scored.where(F.col("anomaly_score") > thr)
    assert 25 <= flagged.count() <= 35
    assert flagged.where("trip_id = 1").count() == 1
    top = scored.orderBy(F.desc("anomaly_score")).first()
    assert top.trip_id == 1


def test_forest_is_deterministic(spark, forest_input):
    a = iforest.fit_forest(forest_input, ["a", "b"], trees=10, max_samples=64, seed=5, key_cols=["trip_id"])
    b = iforest.fit_forest(forest_input.repartition(3), ["a", "b"], trees=10, max_samples=64, seed=5,
                           key_cols=["trip_id"])
    key = ["tree_id", "node_id"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True))


def test_rows_with_a_missing_feature_are_left_out(inputs001):
    from ridemart.operators import dims

    rows = dims.fact_rows(inputs001.featured())
    missing = rows.where("avg_speed_mph IS NULL").count()
    assert missing > 0 and inputs001.rule_input().count() == rows.count() - missing  # F11


def test_whole_mart_and_top_of_it(inputs001, scratch):
    s = fixture_settings().replace(anomaly={"trees": 20})
    out = anomaly.detect(inputs001.fact_with_ids(), s, scratch + "/scores")
    summ = out["summary"].first()
    assert out["mart"].count() == summ.anomalies > 10  # K22
    mart = anomaly.top_anomalies(out["mart"], 10).collect()
    scores = [r.anomaly_score for r in mart]
    assert scores == sorted(scores, reverse=True)
    top = out["scored"].where("is_anomaly").orderBy(F.desc("anomaly_score"), "trip_id").limit(10)
    assert [r.trip_id for r in mart] == [r.trip_id for r in top.collect()]


@pytest.mark.parametrize("rows,parts", [(1, 1), (7, 2), (1000, 3), (60_000, 5)])
def test_one_quantile_method_at_every_size(spark, rows, parts):
    import numpy as np

    from ridemart.operators.sampling import exact_quantile

    df = spark.range(rows).select((F.pmod(F.xxhash64("id"), F.lit(1000 if rows > 10 else 3)) / 1000.0 - 0.25).alias("v")).repartition(parts)
    values = [r.v for r in df.collect()]
    for q in (0.0, 0.5, 0.99, 1.0):
        assert exact_quantile(df, "v", q) == pytest.approx(np.percentile(values, 100 * q), rel=1e-12, abs=1e-15)
    assert exact_quantile(df.where("false"), "v", 0.5) is None
    assert exact_quantile(df.select(F.lit(2.5).alias("v")), "v", 0.99) == 2.5


def test_detect_end_to_end(inputs001, scratch):
    out = anomaly.detect(inputs001.fact_with_ids(), fixture_settings(), scratch + "/scores")
    summ = out["summary"].first()
    assert summ.sampled == 672 and summ.anomalies >= 78
    mart = out["mart"]
    assert mart.where("not is_anomaly").count() == 0
    assert mart.count() == summ.anomalies
    outliers = out["scored"].where("iso_outlier").count()
    assert 5 <= outliers <= 9  # about 1 % of 672


def test_top_k_is_exact(spark):
    from ridemart.operators.sampling import top_k

    df = spark.range(20000).select("id", ((F.col("id") * 7919) % 1000).cast("double").alias("s"))
    want = [tuple(r) for r in df.orderBy(F.desc("s"), "id").limit(50).collect()]
    got = [tuple(r) for r in top_k(df.repartition(13), 50, "s", ["id"]).collect()]
    assert got == want


def test_injected_extreme_trip_is_flagged(spark, scratch):
    from ridemart.plans.catalog import Inputs
    from support import SF01

    i = Inputs(spark, SF01)
    fact = i.fact_with_ids()
    odd = fact.orderBy("trip_id").limit(1).select(
        F.lit(10 ** 9).cast("long").alias("trip_id"), *[F.col(c) for c in fact.columns if c != "trip_id"])
    # Beyond the sf0.01 maxima in tip, total and speed (579.75, 967.25 and 2,227.5).
    odd = odd.withColumns({"trip_distance": F.lit(100.0), "fare_amount": F.lit(500.0), "tip_amount": F.lit(2000.0),
                           "total_amount": F.lit(3000.0), "trip_duration_min": F.lit(1.0),
                           "avg_speed_mph": F.lit(6000.0)})
    out = anomaly.detect(fact.unionByName(odd), fixture_settings().replace(anomaly={"trees": 100}), scratch + "/scores")
    row = out["scored"].where("trip_id = 1000000000").first()
    assert row.iso_outlier and row.is_anomaly
    assert out["mart"].where("trip_id = 1000000000").count() == 1


def test_sampled_mode_reports_both_denominators(inputs001, scratch):
    s = fixture_settings().replace(anomaly={"sample_rows": 300, "trees": 20})
    out = anomaly.detect(inputs001.fact_with_ids(), s, scratch + "/scores")
    summ = out["summary"].first()
    assert summ.sampled == 300 and summ.fact_rows == 672  # K23
    assert summ.anomaly_rate_of_fact == summ.anomalies / 672
    assert out["scored"].count() == 300


def test_vectorised_scores_equal_a_plain_tree_walk(spark, forest_input):
    import math

    nodes = iforest.fit_forest(forest_input, ["a", "b", "c"], trees=15, max_samples=64, seed=3,
                               key_cols=["trip_id"])
    scored = {r.trip_id: r.anomaly_score for r in iforest.score(forest_input, ["a", "b", "c"], nodes).collect()}
    trees = {t: g.set_index("node_id") for t, g in nodes.groupby("tree_id")}

    def walk(tree, x, node=0):
        n = tree.loc[node]
        if n.feature < 0:
            return n.leaf_path
        nxt = n.left_child if x[int(n.feature)] < n.threshold else n.right_child
        return walk(tree, x, int(nxt))

    c = iforest.avg_path_length(64)
    for row in forest_input.orderBy("trip_id").limit(40).collect():
        x = [row.a, row.b, row.c]
        eh = sum(walk(t, x) for t in trees.values()) / len(trees)
        assert math.isclose(scored[row.trip_id], 2.0 ** (-eh / c), rel_tol=1e-12)


@pytest.mark.parametrize("score", [anomaly.forest_scores, anomaly.largest_z])
def test_anomaly_outputs_equal_brute_force(inputs001, scratch, score):
    import numpy as np

    s = fixture_settings().replace(anomaly={"trees": 20})
    out = anomaly.detect(inputs001.fact_with_ids(), s, scratch + "/scores", score)
    scored = out["scored"].toPandas()
    thr = np.percentile(scored["anomaly_score"], 99)  # linear interpolation, as Spark's percentile
    assert (scored["iso_outlier"] == (scored["anomaly_score"] > thr)).all()
    flags = scored["iso_outlier"] | (scored["rules"] != "")
    assert (scored["is_anomaly"] == flags).all()
    summ = out["summary"].first()
    assert summ.sampled == len(scored) and summ.anomalies == int(flags.sum())
    assert summ.anomaly_rate == np.floor(flags.mean() * 10000 + 0.5) / 10000
    top = scored[flags].sort_values(["anomaly_score", "trip_id"], ascending=[False, True]).head(50)
    assert [r.trip_id for r in anomaly.top_anomalies(out["mart"], 50).collect()] == top["trip_id"].tolist()


def test_rows_walk_the_trees_in_batches(spark, monkeypatch):
    """No lambda is interpreted a row, tree and level; odd values go the way Spark's own comparison sends them."""
    import itertools

    nan, inf = float("nan"), float("inf")
    nodes = pd.DataFrame([(4, 0, 0, 0.0, 1, 2, nan), (4, 1, -1, nan, -1, -1, 1.5), (4, 2, 1, nan, 5, 6, nan), (4, 5, 0, inf, 11, 12, nan), (4, 6, -1, nan, -1, -1, 2.0),
                          (4, 11, -1, nan, -1, -1, 3.0), (4, 12, -1, nan, -1, -1, 4.25), (9, 0, -1, nan, -1, -1, 0.125)],
                         columns=["tree_id", "node_id", "feature", "threshold", "left_child", "right_child", "leaf_path"])
    monkeypatch.setattr(iforest, "WALK_ROWS", 7)
    odd = [None, nan, inf, -inf, 0.0, -0.0, -1.0, 5e-324]
    rows = spark.createDataFrame(list(itertools.product(odd, odd)), "a double, b double")
    scored = iforest.score(rows, ["a", "b"], nodes)
    assert "lambda" not in scored._jdf.queryExecution().optimizedPlan().toString()
    below = F.when(F.col("a") < F.lit(inf), 3.0).otherwise(4.25)
    path = F.when(F.col("a") < 0.0, 1.5).otherwise(F.when(F.col("b") < F.lit(nan), below).otherwise(2.0)) + 0.125
    want = F.pow(F.lit(2.0), -path / 2.0 / F.lit(iforest.avg_path_length(256)))
    got = scored.select("anomaly_score", want.alias("want")).collect()
    assert len(got) == 64 and all(r.anomaly_score == r.want for r in got)
    assert iforest.score(rows.limit(0), ["a", "b"], nodes).count() == 0

"""Hourly series, design matrix, seasonal-naive baseline and scoring."""

import datetime as dt
import math

import pytest
from pyspark.sql import functions as F

from ridemart.operators import series

from support import shown_settings as fixture_settings


@pytest.fixture(scope="module")
def formula_series(spark):
    """720 hours from 2022-01-01: y = (200 + 120*[h in 8,9,17,18,19]) * (0.7 + 0.3*[weekday]) + 3h."""
    df = spark.range(720).select(
        F.lit("yellow").alias("fleet"),
        F.timestamp_add("HOUR", F.col("id").cast("int"),
                        F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")).alias("ds"))
    h, dow = F.hour("ds"), F.weekday("ds")
    base = (F.lit(200) + 120 * h.isin(8, 9, 17, 18, 19).cast("int")) * (0.7 + 0.3 * (dow < 5).cast("int"))
    return df.withColumn("y", (base + 3 * h).cast("double"))


def test_scores_of_a_hand_case(spark):
    df = spark.createDataFrame([(10.0, 11.0), (20.0, 19.0), (30.0, 33.0)], "y_actual double, yhat double")
    s = df.agg(*series.score_columns()).first()
    assert math.isclose(s.MAE, 5 / 3) and s.RMSE >= s.MAE
    assert math.isclose(s.MAPE, (0.1 + 0.05 + 0.1) / 3 * 100)


def test_mape_skips_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 1.0), (0.0, 2.0)], "y_actual double, yhat double")
    s = df.agg(*series.score_columns()).first()
    assert s.MAPE is None and s.MAE == 1.5  # K19


def test_design_matrix(formula_series):
    dm = series.design_matrix(formula_series)
    assert dm.count() == 720
    assert {"hour", "dow", "trend", "d_sin1", "w_cos1", "lag_168", "lag_336"} <= set(dm.columns)
    assert len(series.FEATURE_COLUMNS) == 26
    r = dm.orderBy("ds").collect()
    assert r[0].trend == 0.0 and r[719].trend == 719.0
    assert r[0].lag_168 is None and r[168].lag_168 == r[0].y and r[400].lag_336 == r[64].y
    assert r[0].dow == 5  # 2022-01-01 was a Saturday
    assert r[6].d_sin1 == 1.0


def test_seasonal_naive_repeats_last_week(formula_series):
    s = fixture_settings()
    naive = series.seasonal_naive(formula_series, s).orderBy("ds").collect()
    ys = [r.y for r in formula_series.orderBy("ds").collect()]
    assert len(naive) == 168
    assert [r.yhat for r in naive] == ys[720 - 168 - 168: 720 - 168]
    assert [r.y_actual for r in naive] == ys[-168:]


def test_backtest_folds_and_guard(formula_series, spark):
    s = fixture_settings()
    p = series.with_position(formula_series)
    folds = series.backtest_folds(p, s).orderBy("fold").collect()
    assert [(f.fold, f.cut) for f in folds] == [(0, 648), (1, 672), (2, 696)]
    nb = series.naive_backtest(formula_series, s).first()
    assert nb.model == "seasonal_naive" and nb.MAE >= 0
    short = formula_series.where(F.col("ds") < F.lit("2022-01-20").cast("timestamp_ntz"))
    assert series.naive_metrics(short, s).count() == 0  # T13


def test_hourly_series_gap_fill(spark):
    rows = [("yellow", dt.datetime(2024, 1, 1, 0, 10)), ("yellow", dt.datetime(2024, 1, 1, 0, 50)),
            ("yellow", dt.datetime(2024, 1, 1, 3, 5)), ("green", dt.datetime(2024, 1, 2, 5, 0))]
    df = spark.createDataFrame(rows, "fleet string, pickup_datetime timestamp_ntz")
    out = series.hourly_series(df, fixture_settings()).orderBy("fleet", "ds").collect()
    assert [(r.fleet, r.ds.hour, r.y) for r in out] == [
        ("green", 5, 1.0), ("yellow", 0, 2.0), ("yellow", 1, 0.0), ("yellow", 2, 0.0), ("yellow", 3, 1.0)]
    assert series.hourly_series(df.where("false"), fixture_settings()).count() == 0


def test_horizon_longer_than_a_season_is_refused(formula_series):
    s = fixture_settings().replace(forecast={"test_days": 8})
    with pytest.raises(ValueError):
        series.seasonal_naive(formula_series, s)  # K17


def test_fold_guard_skips_early_cuts(formula_series, spark):
    # 520 hours: only folds whose cut is past two seasons (336 h) remain.
    short = formula_series.where(F.col("ds") < F.lit("2022-01-22 16:00:00").cast("timestamp_ntz"))
    s = fixture_settings().replace(forecast={"folds": 8})
    folds = series.backtest_folds(series.with_position(short), s).orderBy("fold").collect()
    assert [f.cut for f in folds] == [352, 376, 400, 424, 448, 472, 496]

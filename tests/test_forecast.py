"""GBT forecast invariants."""

import math

import pytest
from pyspark.sql import functions as F

from ridemart.operators import forecast

from support import shown_settings as fixture_settings


@pytest.fixture(scope="module")
def result(spark):
    df = spark.range(720).select(
        F.lit("yellow").alias("fleet"),
        F.timestamp_add("HOUR", F.col("id").cast("int"),
                        F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")).alias("ds"))
    h, dow = F.hour("ds"), F.weekday("ds")
    base = (F.lit(200) + 120 * h.isin(8, 9, 17, 18, 19).cast("int")) * (0.7 + 0.3 * (dow < 5).cast("int"))
    series = df.withColumn("y", (base + 3 * h).cast("double"))
    s = fixture_settings().replace(forecast={"max_iter": 10, "folds": 2})
    return forecast.forecast(series, s)


def test_forecast_rows_finite_and_banded(result):
    fc = result["mart_forecast"].collect()
    assert len(fc) == 168
    for r in fc:
        assert math.isfinite(r.yhat) and r.yhat >= 0
        assert r.yhat_lower <= r.yhat <= r.yhat_upper
    assert result["mart_forecast"].columns == ["fleet", "ds", "y_actual", "yhat", "yhat_lower", "yhat_upper"]


def test_metrics_and_backtest_have_both_models(result):
    m = {r.model for r in result["mart_forecast_metrics"].collect()}
    b = {r.model for r in result["mart_forecast_backtest"].collect()}
    assert m == b == {"gbm", "seasonal_naive"}
    best = forecast.best_model(result["mart_forecast_metrics"]).first()
    rmse = {r.model: r.RMSE for r in result["mart_forecast_metrics"].collect()}
    assert best.RMSE == min(rmse.values())


def test_gbm_learns_the_pattern(result):
    rmse = {r.model: r.RMSE for r in result["mart_forecast_metrics"].collect()}
    mean_y = result["mart_forecast"].agg(F.avg("y_actual")).first()[0]
    assert rmse["gbm"] < 0.2 * mean_y


def test_same_seed_same_forecast(spark, inputs001):
    from ridemart.operators import series as S

    s = fixture_settings().replace(forecast={"max_iter": 3, "folds": 1, "fleets": ("yellow",)},
                                   window={"start": "2024-01-01", "end": "2024-01-30"})
    hourly = S.hourly_series(inputs001.clean(), s)
    a = forecast.forecast(hourly, s)
    b = forecast.forecast(hourly.repartition(3), s)
    key = ["fleet", "ds"]
    ra = [tuple(r) for r in a["mart_forecast"].orderBy(*key).collect()]
    rb = [tuple(r) for r in b["mart_forecast"].orderBy(*key).collect()]
    assert len(ra) == 168 and ra == rb


def test_too_short_series_gives_empty_tables(spark):
    short = spark.range(100).select(
        F.lit("yellow").alias("fleet"),
        F.timestamp_add("HOUR", F.col("id").cast("int"), F.lit("2022-01-01 00:00:00").cast("timestamp_ntz")).alias("ds"),
        F.lit(5.0).alias("y"))
    out = forecast.forecast(short, fixture_settings())  # T13: 100 h < 168 + 336 h
    assert out["mart_forecast"].count() == 0
    assert out["mart_forecast_metrics"].count() == 0 and out["mart_forecast_backtest"].count() == 0


def test_forecast_outputs_equal_brute_force(spark, inputs001):
    import numpy as np

    from ridemart.operators import bi
    from ridemart.operators import series as S

    s = fixture_settings().replace(forecast={"max_iter": 3, "folds": 1})
    out = forecast.forecast(S.hourly_series(inputs001.clean(), s), s)
    fc = out["mart_forecast"].toPandas()
    metrics = {(r.fleet, r.model): r for r in out["mart_forecast_metrics"].collect()}
    errors = {r.fleet: r for r in bi.forecast_error(out["mart_forecast"]).collect()}
    for fleet, g in fc.groupby("fleet"):
        y, p = g["y_actual"].to_numpy(), g["yhat"].to_numpy()
        e = p - y
        nz = y > 0
        m = metrics[(fleet, "gbm")]
        assert np.isclose(m.MAE, np.abs(e).mean()) and np.isclose(m.RMSE, np.sqrt((e ** 2).mean()))
        assert np.isclose(m.MAPE, np.mean(np.abs(e[nz] / y[nz])) * 100)
        assert np.isclose(m.sMAPE, np.mean(2 * np.abs(e) / (np.abs(y) + np.abs(p) + 1e-9)) * 100)
        assert np.isclose(errors[fleet].bias, e.mean()) and np.isclose(errors[fleet].MAE, m.MAE)
        assert (g["yhat_lower"] <= g["yhat"]).all() and (g["yhat"] <= g["yhat_upper"]).all()
    best = {r.fleet: r.model for r in forecast.best_model(out["mart_forecast_metrics"]).collect()}
    for fleet in best:
        rm = {mod: metrics[(fleet, mod)].RMSE for mod in ("gbm", "seasonal_naive")}
        assert best[fleet] == min(rm, key=lambda k: (rm[k], k))


def test_model_beats_the_baseline_on_held_out_hours(spark):
    from ridemart.plans.catalog import Inputs
    from support import SF01

    s = fixture_settings().replace(window={"start": "2024-01-01", "end": "2024-02-01"}, forecast={"max_iter": 120, "folds": 1})
    out = forecast.forecast(Inputs(spark, SF01, s).series(), s)
    scores = {(r.fleet, r.model): r for r in out["mart_forecast_metrics"].collect()}
    assert {f for f, _ in scores} == {"yellow", "green"}
    for fleet in ("yellow", "green"):
        assert scores[fleet, "gbm"].MAPE < scores[fleet, "seasonal_naive"].MAPE
        assert scores[fleet, "gbm"].RMSE < scores[fleet, "seasonal_naive"].RMSE

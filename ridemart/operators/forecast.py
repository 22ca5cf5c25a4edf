"""Hourly volume forecast with gradient-boosted trees.

Per fleet: a model on calendar, Fourier, trend and lag features is fit on all
but the last ``test_days`` and scored on them next to the seasonal-naive
baseline; a rolling-origin backtest repeats the fit for each fold.  The design
matrix is built once for all fleets, the folds are rows, and (fleet, fold) is
the key by which its rows are grouped: all fits are one Spark job, one group
each.  A group's size is bounded by the window in hours, whatever the number
of trips.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.constants import INTERVAL_Z, WEEK_HOURS
from ridemart.functions import clip_lower
from ridemart.operators.boosting import BoostingConfig, boost
from ridemart.operators.joins import bounded
from ridemart.operators.series import (FEATURE_COLUMNS, METRICS, backtest_folds, by_fleet, design_matrix,
                                       eligible, naive_backtest, naive_metrics, ordered_mean, score, with_position)
from ridemart.settings import Settings

PREDICTIONS = "fleet string, fold int, t int, ds timestamp_ntz, y double, raw_pred double, is_test boolean"


def boosting_config(settings: Settings) -> BoostingConfig:
    fc = settings.forecast
    return BoostingConfig(fc.max_iter, fc.step_size, fc.max_depth, fc.max_leaves, fc.max_bins, fc.min_leaf, fc.l2)


def fits(positioned: DataFrame, settings: Settings) -> DataFrame:
    """T9 + W5, U2: one row ``(fleet, fold, cut, stop)`` per model fit, the final ones and the folds united.

    Fold -1 is the final fit (held-out week), folds 0.. are the backtest;
    rows before ``cut`` train the model and those up to ``stop`` are predicted.
    """
    fc = settings.forecast
    test = fc.test_days * 24
    lengths = positioned.select("fleet", "n").distinct()
    final = lengths.select("fleet", F.lit(-1).alias("fold"), (F.col("n") - test).alias("cut"), F.col("n").alias("stop"))
    folds = backtest_folds(positioned, settings)
    return final.unionByName(folds.select("fleet", "fold", "cut", (F.col("cut") + fc.horizon).alias("stop")))


def _fit_group(cfg: BoostingConfig, features: list[str]) -> Callable[[pd.DataFrame], pd.DataFrame]:
    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("t", ignore_index=True)
        train = (rows["t"] < rows["cut"]).to_numpy()
        rows["raw_pred"] = boost(rows[features].to_numpy(dtype=float), rows["y"].to_numpy(), train, cfg)
        rows["is_test"] = ~train
        return rows[["fleet", "fold", "t", "ds", "y", "raw_pred", "is_test"]]
    return fit


def predictions(series: DataFrame, settings: Settings) -> DataFrame:
    """Every fit's predictions ``(fleet, fold, t, ds, y, raw_pred, is_test)``.

    The training rows are kept so the residual spread can be taken in-sample
    (K18).  Lags before the start of the series stay NULL; the trees send
    them to the better side of each cut.  Fleets too short for a forecast
    are skipped (T13).
    """
    fc = settings.forecast
    if fc.test_days * 24 > WEEK_HOURS:
        raise ValueError("test horizon longer than one season would read held-out actuals")
    positioned = eligible(with_position(design_matrix(series)), settings)
    n_fits = len(fc.fleets) * (fc.folds + 1)
    plan = bounded(fits(positioned, settings), known_max_rows=n_fits)
    rows = positioned.join(plan, "fleet").where(F.col("t") < F.col("stop"))
    # Few rows but long fits: more partitions than fits (an explicit count is not
    # coalesced), so that hardly two fits share a task.
    rows = rows.select("fleet", "fold", "cut", "t", "ds", "y", *FEATURE_COLUMNS).repartition(8 * n_fits, "fleet", "fold")
    return rows.groupBy("fleet", "fold").applyInPandas(_fit_group(boosting_config(settings), FEATURE_COLUMNS), PREDICTIONS)


def forecast(series: DataFrame, settings: Settings, predictions_path: str | None = None) -> dict[str, DataFrame]:
    """``mart_forecast``, ``mart_forecast_metrics``, ``mart_forecast_backtest`` and the ``predictions`` behind them.

    With ``predictions_path`` the predictions are written there once and the
    tables read them; without, each table that is read fits its models anew.
    No eligible fleet gives empty tables.
    """
    pred = predictions(series, settings)
    if predictions_path:
        pred.write.mode("overwrite").parquet(predictions_path)
        pred = series.sparkSession.read.schema(PREDICTIONS).parquet(predictions_path)
    return {**forecast_tables(pred, series, settings), "predictions": pred}


def forecast_tables(pred: DataFrame, series: DataFrame, settings: Settings, model: str = "gbm") -> dict[str, DataFrame]:
    """T6, T8-T12 from any model's predictions ``(fleet, fold, t, ds, y, raw_pred, is_test)``.

    Fold -1 holds the final fit with its in-sample rows, folds 0.. the backtest.
    ``mart_forecast`` is the P10 projection with the interval from the
    in-sample residual std (A16).
    """
    # Sigma is the population std of in-sample residuals of the final fit.
    sigma = (pred.where((F.col("fold") == -1) & ~F.col("is_test"))
             .groupBy("fleet").agg(F.stddev_pop(F.col("y") - F.col("raw_pred")).alias("sigma")))
    final = pred.where((F.col("fold") == -1) & F.col("is_test")).join(sigma, "fleet")
    yhat = clip_lower("raw_pred")
    mart_forecast = final.select(
        "fleet", "ds", F.col("y").alias("y_actual"), yhat.alias("yhat"),
        clip_lower(yhat - INTERVAL_Z * F.col("sigma")).alias("yhat_lower"),
        (yhat + INTERVAL_Z * F.col("sigma")).alias("yhat_upper"))
    own = score(mart_forecast.withColumn("model", F.lit(model)), ["fleet", "model"]).select("fleet", "model", *METRICS)

    # Backtest: per-fold scores averaged per fleet, next to the baseline's.
    tests = pred.where((F.col("fold") >= 0) & F.col("is_test"))
    per_fold = score(tests.select("fleet", "fold", F.col("y").alias("y_actual"), clip_lower("raw_pred").alias("yhat")), ["fleet", "fold"])
    folds = (per_fold.groupBy("fleet").agg(*[ordered_mean(m, "fold").alias(m) for m in METRICS])
             .select("fleet", F.lit(model).alias("model"), *METRICS))
    return {"mart_forecast": mart_forecast,
            "mart_forecast_metrics": own.unionByName(naive_metrics(series, settings)),
            "mart_forecast_backtest": folds.unionByName(naive_backtest(series, settings))}


def two_week_mean(series: DataFrame, settings: Settings) -> DataFrame:
    """A model without a fit: the mean of the values one and two weeks earlier, as predictions of every fold."""
    fc = settings.forecast
    p = eligible(with_position(series), settings)
    w = by_fleet()
    p = p.withColumn("raw_pred", (F.lag("y", WEEK_HOURS).over(w) + F.lag("y", 2 * WEEK_HOURS).over(w)) / 2)
    final = p.select("fleet", F.lit(-1).alias("fold"), "t", "ds", "y", "raw_pred",
                     (F.col("t") >= F.col("n") - fc.test_days * 24).alias("is_test"))
    folds = backtest_folds(p.select("fleet", "n").distinct(), settings)
    tests = (p.join(folds, "fleet").where((F.col("t") >= F.col("cut")) & (F.col("t") < F.col("cut") + fc.horizon))
             .select("fleet", "fold", "t", "ds", "y", "raw_pred", F.lit(True).alias("is_test")))
    return final.unionByName(tests).where("raw_pred is not null")


def best_model(metrics: DataFrame) -> DataFrame:
    """A18 + O9: the model with the lowest RMSE per fleet (ties by model name)."""
    return metrics.groupBy("fleet").agg(
        F.min_by(F.struct("model", "RMSE", "MAPE"), F.struct("RMSE", "model")).alias("best")
    ).select("fleet", "best.model", "best.RMSE", "best.MAPE")

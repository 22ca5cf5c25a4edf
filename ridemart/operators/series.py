"""Hourly demand series, features, seasonal-naive baseline and scoring.

T1-T4, T7, T8 (naive part), T13, W2-W6, A15.  Everything is keyed by fleet,
so all fleets run in one plan.  The trips are reduced to hourly counts
first (map-side combined); later windows partition by fleet over series
whose length is bounded by the window (hours), not by the trip volume.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridemart.constants import DAILY_FOURIER, LAGS, SMAPE_EPS, WEEK_HOURS, WEEKLY_FOURIER
from ridemart.functions import fourier_terms, hour_long, hour_of_week, hour_start, monday_weekday
from ridemart.settings import Settings

METRICS = ["MAE", "RMSE", "MAPE", "sMAPE"]


def hourly_series(staged: DataFrame, settings: Settings) -> DataFrame:
    """``(fleet, ds, y)`` hourly ride counts, gap-filled with 0.

    F10 (fleet IN list, F13, + window filter) and A7 (count by hour, map-side combined),
    then gap filling from the first to the last hour with rides (K16, J7)
    without a spine join: each hour with rides emits itself and the empty
    hours up to the fleet's next hour with rides (``lead`` over at most
    window-hours rows per fleet).  One scan, one shuffle of hourly counts.
    Fleets without rides produce no rows.
    """
    w = settings.window
    ts = F.col("pickup_datetime")
    counts = (staged.where(F.col("fleet").isin(*settings.forecast.fleets)
                           & (ts >= F.lit(w.start).cast("timestamp_ntz"))
                           & (ts < F.lit(w.end).cast("timestamp_ntz")))
              .groupBy("fleet", hour_start(ts).alias("ds"))
              .agg(F.count(F.lit(1)).alias("n")))
    nxt = F.lead("ds").over(Window.partitionBy("fleet").orderBy("ds"))
    last = F.coalesce(F.timestamp_add("HOUR", F.lit(-1), nxt), F.col("ds"))
    spans = counts.withColumn("last", last).select("fleet", "n", F.posexplode(
        F.sequence("ds", "last", F.expr("INTERVAL 1 HOUR"))).alias("pos", "hour_ds"))
    return spans.select("fleet", F.col("hour_ds").alias("ds"),
                        F.when(F.col("pos") == 0, F.col("n")).otherwise(F.lit(0)).cast("double").alias("y"))


def by_fleet() -> Window:
    """Window over one fleet's series in time order (at most window-hours rows)."""
    return Window.partitionBy("fleet").orderBy("ds")


def with_position(series: DataFrame) -> DataFrame:
    """W4 helper: 0-based position ``t`` and series length ``n`` per fleet."""
    w = by_fleet()
    return (series.withColumn("t", F.row_number().over(w) - 1)
            .withColumn("n", F.count(F.lit(1)).over(Window.partitionBy("fleet"))))


def calendar_features(ds: str | Column = "ds") -> list[Column]:
    """T2 (without trend) + T3: hour, dow, is_weekend, daily and weekly harmonics."""
    ds = F.col(ds) if isinstance(ds, str) else ds
    hour, dow = hour_long(ds), monday_weekday(ds)
    how = hour_of_week(dow, hour)
    p_d, k_d, n_d = DAILY_FOURIER
    p_w, k_w, n_w = WEEKLY_FOURIER
    return [hour.alias("hour"), dow.alias("dow"), (dow >= 5).cast("long").alias("is_weekend"),
            *fourier_terms(hour, p_d, k_d, n_d), *fourier_terms(how, p_w, k_w, n_w)]


FEATURE_COLUMNS = (["hour", "dow", "is_weekend", "trend"]
                   + [f"{n}_{f}{i}" for p, k, n in (DAILY_FOURIER, WEEKLY_FOURIER)
                      for i in range(1, k + 1) for f in ("sin", "cos")]
                   + [f"lag_{lag}" for lag in LAGS])


def design_matrix(series: DataFrame) -> DataFrame:
    """T4: series + calendar, trend (W6) and lag (W2) features per fleet.

    ``trend`` is hours since the fleet's first hour; ``lag_168``/``lag_336``
    are NULL where the history is shorter.
    """
    w = by_fleet()
    first = F.min("ds").over(Window.partitionBy("fleet"))
    cal = calendar_features("ds")
    out = series.select(
        "fleet", "ds", "y", *cal,
        F.timestamp_diff("HOUR", first, F.col("ds")).cast("double").alias("trend"),
        *[F.lag("y", lag).over(w).alias(f"lag_{lag}") for lag in LAGS],
    )
    return out.select("fleet", "ds", "y", *FEATURE_COLUMNS)


def eligible(positioned: DataFrame, settings: Settings) -> DataFrame:
    """Keep fleets whose series covers the test block plus two seasons."""
    test = settings.forecast.test_days * 24
    return positioned.where(F.col("n") >= test + 2 * WEEK_HOURS)


def seasonal_naive(series: DataFrame, settings: Settings, season: int = WEEK_HOURS) -> DataFrame:
    """The held-out block predicted by the value one season earlier.

    Output ``(fleet, ds, y_actual, yhat)`` for the last ``test_days*24``
    hours of each eligible fleet.  Equal to the positional rule while the
    horizon is at most one season (K17).
    """
    test = settings.forecast.test_days * 24
    if test > season:
        raise ValueError("test horizon longer than one season would read held-out actuals")
    p = eligible(with_position(series), settings)
    p = p.withColumn("yhat", F.lag("y", season).over(by_fleet()))
    return (p.where(F.col("t") >= F.col("n") - test)
            .select("fleet", "ds", F.col("y").alias("y_actual"), "yhat"))


def score_columns(y: str = "y_actual", yhat: str = "yhat") -> list[Column]:
    """A15 + X19: MAE, RMSE, MAPE (hours with y > 0 only, NULL if none), sMAPE."""
    err = F.col(yhat) - F.col(y)
    ape = F.when(F.col(y) > 0, F.abs(err / F.col(y)))
    sape = 2 * F.abs(err) / (F.abs(F.col(y)) + F.abs(F.col(yhat)) + SMAPE_EPS)
    return [F.avg(F.abs(err)).alias("MAE"), F.sqrt(F.avg(err * err)).alias("RMSE"),
            (F.avg(ape) * 100).alias("MAPE"), (F.avg(sape) * 100).alias("sMAPE")]


def ordered_mean(value: str, order: str) -> Column:
    """Aggregate: mean of ``value`` over the group, summed in ``order`` order.

    A plain ``avg`` of doubles adds in arrival order, which depends on the
    partitioning.  For the handful of folds per fleet the values are summed
    in fold order instead, so the result is the same on every run.  NULLs
    are skipped; all-NULL gives NULL.
    """
    pairs = F.array_sort(F.collect_list(F.struct(F.col(order).alias("k"), F.col(value).alias("v"))))
    vals = F.filter(F.transform(pairs, lambda p: p["v"]), lambda x: x.isNotNull())
    total = F.aggregate(vals, F.lit(0.0), lambda acc, x: acc + x)
    return F.when(F.size(vals) > 0, total / F.size(vals))


def score(pred: DataFrame, keys: list[str], y: str = "y_actual", yhat: str = "yhat") -> DataFrame:
    return pred.groupBy(*keys).agg(*score_columns(y, yhat))


def naive_metrics(series: DataFrame, settings: Settings) -> DataFrame:
    """T8 (baseline part): held-out scores of the seasonal-naive model per fleet."""
    return score(seasonal_naive(series, settings).withColumn("model", F.lit("seasonal_naive")),
                 ["fleet", "model"]).select("fleet", "model", *METRICS)


def backtest_folds(positioned: DataFrame, settings: Settings) -> DataFrame:
    """Rolling-origin folds as rows ``(fleet, fold, cut)``.

    ``cut = n - (folds - fold) * horizon``; folds with ``cut <= 2 * season``
    are skipped (K20).  The folds sit inside the last ``folds*horizon``
    hours, i.e. inside the held-out week (K21).
    """
    fc = settings.forecast
    folds = positioned.select("fleet", "n").distinct().select(
        "fleet", "n", F.explode(F.sequence(F.lit(0), F.lit(fc.folds - 1))).alias("fold"))
    folds = folds.withColumn("cut", F.col("n") - (F.lit(fc.folds) - F.col("fold")) * fc.horizon)
    return folds.where(F.col("cut") > 2 * WEEK_HOURS).select("fleet", "fold", "cut")


def naive_backtest(series: DataFrame, settings: Settings, season: int = WEEK_HOURS) -> DataFrame:
    """T9 (baseline part) + A17: per-fold naive scores averaged per fleet.

    The fold test blocks tile the last ``folds * horizon`` hours without
    overlap, so each hour's fold follows from its position; no fold table is
    joined.  Folds with ``cut <= 2 * season`` are skipped (K20).
    """
    fc = settings.forecast
    p = eligible(with_position(series), settings)
    p = p.withColumn("yhat", F.lag("y", season).over(by_fleet()))
    start = F.col("n") - fc.folds * fc.horizon
    fold = F.floor((F.col("t") - start) / fc.horizon).cast("int")
    cut = F.col("n") - (F.lit(fc.folds) - F.col("fold")) * fc.horizon
    test = (p.where(F.col("t") >= start).withColumn("fold", fold)
            .where(cut > 2 * WEEK_HOURS))
    per_fold = score(test.withColumnRenamed("y", "y_actual"), ["fleet", "fold"])
    return (per_fold.groupBy("fleet").agg(*[ordered_mean(m, "fold").alias(m) for m in METRICS])
            .select("fleet", F.lit("seasonal_naive").alias("model"), *METRICS))

"""Cleaning raw trips into the staged trip table."""

from __future__ import annotations

from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.functions import (count_when, day_name, hour_long, is_rush_hour, is_weekend_day,
                                minutes_between, monday_weekday, round2, safe_divide, to_date_col)
from ridemart.settings import Settings

STAGED_COLUMNS = [
    "fleet", "pickup_datetime", "dropoff_datetime", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "fare_amount",
    "tip_amount", "total_amount", "payment_type", "pickup_date", "pickup_hour",
    "pickup_weekday", "pickup_day_name", "is_weekend", "is_rush_hour",
    "trip_duration_min", "avg_speed_mph",
]


def with_features(raw: DataFrame) -> DataFrame:
    """P4 + P5: calendar features, duration, then speed over the duration."""
    ts = F.col("pickup_datetime")
    feat = raw.withColumns({
        "pickup_date": to_date_col(ts),
        "pickup_hour": hour_long(ts),
        "pickup_weekday": monday_weekday(ts),
        "pickup_day_name": day_name(ts),
        "is_weekend": is_weekend_day(ts),
        "is_rush_hour": is_rush_hour(F.hour(ts)),
        "trip_duration_min": minutes_between("pickup_datetime", "dropoff_datetime"),
    })
    return feat.withColumn("avg_speed_mph",
                           safe_divide("trip_distance", F.col("trip_duration_min") / 60.0))


def keep_predicate(settings: Settings) -> Column:
    """F1-F6 as one predicate over featured rows (NULL means drop)."""
    c, w = settings.cleaning, settings.window
    ts = F.col("pickup_datetime")
    return (
        (ts >= F.lit(w.start).cast("timestamp_ntz"))
        & (ts < F.lit(w.end).cast("timestamp_ntz"))
        & (F.col("dropoff_datetime") > ts)
        & F.col("fare_amount").between(c.min_fare, c.max_fare)
        & F.col("trip_distance").between(c.min_distance, c.max_distance)
        & F.col("trip_duration_min").between(c.min_duration_min, c.max_duration_min)
        & F.coalesce(F.col("passenger_count"), F.lit(1.0)).between(1, c.max_passengers)
    )


def clean_trips(raw: DataFrame, settings: Settings, more: list[str] | None = None) -> DataFrame:
    """Normalised raw trips -> staged trips (19 columns, and those of ``more``).

    The window predicate on the raw timestamp is pushed into each parquet
    scan; the derived predicates run right after it in the same stage.
    """
    return with_features(raw).where(keep_predicate(settings)).select(*STAGED_COLUMNS, *(more or []))


def removal_counts(rows_raw: int, rows_clean: int) -> dict:
    """A8 from two row counts (percent rounded half up to 2 digits, 0 of nothing)."""
    removed = rows_raw - rows_clean
    percent = Decimal(removed * 100) / rows_raw if rows_raw else Decimal(0)
    return {"rows_raw": rows_raw, "rows_clean": rows_clean, "rows_removed": removed,
            "removed_pct": float(percent.quantize(Decimal("0.01"), ROUND_HALF_UP))}


def clean_summary(raw: DataFrame, settings: Settings) -> DataFrame:
    """Raw / kept / removed counts and removed percent, in one pass."""
    counts = with_features(raw).agg(
        F.count(F.lit(1)).alias("rows_raw"),
        count_when(keep_predicate(settings)).alias("rows_clean"),
    )
    removed = F.col("rows_raw") - F.col("rows_clean")
    return counts.select(
        "rows_raw", "rows_clean", removed.alias("rows_removed"),
        F.when(F.col("rows_raw") > 0, round2(removed / F.col("rows_raw") * 100))
         .otherwise(F.lit(0.0)).alias("removed_pct"),
    )

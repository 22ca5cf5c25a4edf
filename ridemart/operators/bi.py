"""Report measures (B1-B11) over the fact and marts.

Formulas the report only names are defined here: tip rate = sum(tip) /
sum(fare); week-over-week = trailing 7-day rides over the same sum 7 days
earlier, minus 1; distance bands are left-closed at 1, 3, 5 and 10 miles;
net flow = pickups - dropoffs per zone, with the average fare of trips
ending there next to it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridemart.constants import DISTANCE_BANDS
from ridemart.functions import distance_band, round2, safe_divide
from ridemart.settings import Settings


def kpis(fact: DataFrame) -> DataFrame:
    """Total trips, total revenue, tip rate and rush-hour share, one pass."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("total_amount").alias("total_revenue"),
        safe_divide(F.sum("tip_amount"), F.sum("fare_amount")).alias("tip_rate"),
        F.avg(F.col("is_rush_hour").cast("int")).alias("rush_hour_share"),
    )


def week_over_week(fact: DataFrame, dim_date: DataFrame, settings: Settings) -> DataFrame:
    """Daily rides per fleet on a gap-free day spine with a 7-day comparison.

    The spine is every day of the window for every configured fleet (a
    bounded frame, no join needed to build it); days without rides count 0.
    Windows are per fleet over at most ``window_days`` rows.
    """
    fleets = F.array(*[F.lit(f) for f in settings.ingest.fleets])
    spine = dim_date.select(F.explode(fleets).alias("fleet"), "date_key", "date")
    daily = fact.groupBy("fleet", "date_key").agg(F.count(F.lit(1)).alias("n"))
    s = spine.join(daily, ["fleet", "date_key"], "left").select(
        "fleet", "date", F.coalesce("n", F.lit(0)).alias("rides"))
    w = Window.partitionBy("fleet").orderBy("date")
    s = s.withColumn("rides_7d", F.sum("rides").over(w.rowsBetween(-6, 0)))
    s = s.withColumn("rides_prev_7d", F.lag("rides_7d", 7).over(w))
    return s.withColumn("wow_change",
                        safe_divide(F.col("rides_7d").cast("double"), F.col("rides_prev_7d")) - 1)


def distance_bands(fact: DataFrame) -> DataFrame:
    """Trips per distance band and their share of all trips.

    The share's denominator is a window over the banded aggregate, which has
    at most one row per band.
    """
    lows = F.create_map(*[x for lo, label in DISTANCE_BANDS for x in (F.lit(label), F.lit(lo))])
    agg = fact.groupBy(distance_band("trip_distance").alias("distance_band")) \
              .agg(F.count(F.lit(1)).alias("trips"))
    return agg.select(
        "distance_band", lows[F.col("distance_band")].alias("band_min_miles"), "trips",
        (F.col("trips") / F.sum("trips").over(Window.partitionBy())).alias("share"),
    )


def net_flow(fact: DataFrame, dim_zone: DataFrame) -> DataFrame:
    """B7 + B8: pickups, dropoffs and net flow per zone, avg fare of arrivals.

    One scan: every trip yields a pickup row and a dropoff row, aggregated by
    zone (map-side combined).  Full join onto the zone dimension keeps zones
    without trips (0 flows) and trips whose zone is unknown (NULL names).
    """
    roles = F.array(
        F.struct(F.col("pickup_location_id").alias("location_id"), F.lit(1).alias("p"),
                 F.lit(0).alias("d"), F.lit(None).cast("double").alias("fare")),
        F.struct(F.col("dropoff_location_id").alias("location_id"), F.lit(0).alias("p"),
                 F.lit(1).alias("d"), F.col("fare_amount").alias("fare")),
    )
    flows = (fact.select(F.inline(roles)).groupBy("location_id")
             .agg(F.sum("p").alias("pickups"), F.sum("d").alias("dropoffs"),
                  F.avg("fare").alias("_fare")))
    # Full outer joins cannot broadcast; both sides are one row per zone.
    z = dim_zone.select("location_id", "zone", "borough")
    out = z.join(flows, "location_id", "full")
    return out.select(
        "location_id", "zone", "borough",
        F.coalesce("pickups", F.lit(0)).cast("long").alias("pickups"),
        F.coalesce("dropoffs", F.lit(0)).cast("long").alias("dropoffs"),
        (F.coalesce("pickups", F.lit(0)) - F.coalesce("dropoffs", F.lit(0))).cast("long")
        .alias("net_flow"),
        round2("_fare").alias("avg_dropoff_fare"),
    )


def forecast_error(forecast: DataFrame) -> DataFrame:
    """MAE, MAPE and bias (mean of yhat - y) of the held-out forecast per fleet."""
    err = F.col("yhat") - F.col("y_actual")
    return forecast.groupBy("fleet").agg(
        F.avg(F.abs(err)).alias("MAE"),
        (F.avg(F.when(F.col("y_actual") > 0, F.abs(err / F.col("y_actual")))) * 100).alias("MAPE"),
        F.avg(err).alias("bias"),
    )


def anomaly_scatter(anomalies: DataFrame) -> DataFrame:
    """Fare against distance of the flagged trips in the anomaly mart."""
    return anomalies.select("trip_id", "fleet", "trip_distance", "fare_amount", "anomaly_score",
                            "rules")




__all__ = ["kpis", "week_over_week", "distance_bands", "net_flow", "forecast_error",
           "anomaly_scatter"]

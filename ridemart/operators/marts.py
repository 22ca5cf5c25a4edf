"""Marts M1-M4 and the serving queries behind the figures (V1-V5).

Every mart aggregates the fact on ids first (partial + final hash
aggregation; a hot key collapses map-side) and joins the tiny dimensions to
the aggregate, so the shuffle carries one row per group and map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridemart.functions import round2
from ridemart.operators.dims import window_days
from ridemart.operators.joins import bounded
from ridemart.settings import Settings


def _date_dim(dim_date: DataFrame, settings: Settings | None) -> DataFrame:
    return bounded(dim_date, known_max_rows=window_days(settings) if settings else None)


def _zones(dim_zone: DataFrame) -> DataFrame:
    """The zone columns the marts carry; its size is unknown, so Spark picks the join."""
    return dim_zone.select("location_id", "zone", "borough", "lat", "lng")


def mart_zone_demand(fact: DataFrame, dim_zone: DataFrame, ordered: bool = True) -> DataFrame:
    """M1: pickups and economics per pickup zone."""
    agg = fact.groupBy(F.col("pickup_location_id").alias("location_id")).agg(
        F.count(F.lit(1)).alias("pickups"),
        F.sum("total_amount").alias("_rev"),
        F.avg("fare_amount").alias("_fare"),
        F.avg("trip_distance").alias("_dist"),
        F.avg("trip_duration_min").alias("_dur"),
    )
    out = agg.join(_zones(dim_zone), "location_id").select(
        "location_id", "zone", "borough", "lat", "lng", "pickups",
        round2("_rev").alias("total_revenue"), round2("_fare").alias("avg_fare"),
        round2("_dist").alias("avg_distance"), round2("_dur").alias("avg_duration_min"),
    )
    return out.orderBy(F.desc("pickups"), "location_id") if ordered else out


def mart_hourly_volume(fact: DataFrame, dim_date: DataFrame, settings: Settings | None = None,
                       ordered: bool = True) -> DataFrame:
    """M2: average rides per day by fleet, weekday and hour.

    ``n_days`` counts dates that have at least one ride for the fleet and
    weekday (K10); rides are cast to DOUBLE before the division (X16).  This
    mart is also the B10 measure (average rides per weekday x hour).  The
    fact is scanned and shuffled once, into one row per (fleet, day, hour);
    ``n_days`` is a window over that small frame (at most window-days x 24
    rows per fleet and weekday), and the final aggregate reuses the
    window's partitioning.
    """
    per_hour = fact.groupBy("fleet", "date_key", "pickup_hour").agg(F.count(F.lit(1)).alias("n"))
    d = _date_dim(dim_date, settings).select("date_key", "weekday", "weekday_name")
    base = per_hour.join(d, "date_key")
    by_day = Window.partitionBy("fleet", "weekday")
    day = F.dense_rank().over(by_day.orderBy("date_key"))
    base = base.withColumn("day", day).withColumn("n_days", F.max("day").over(by_day).cast("long"))
    counts = base.groupBy("fleet", "weekday", "weekday_name", F.col("pickup_hour").alias("hour")) \
                 .agg(F.sum("n").alias("rides"), F.first("n_days").alias("n_days"))
    out = counts.select(
        "fleet", "weekday", "weekday_name", "hour", "rides", "n_days",
        round2(F.col("rides").cast("double") / F.col("n_days")).alias("avg_rides_per_day"),
    )
    return out.orderBy("fleet", "weekday", "hour") if ordered else out


def mart_daily_volume(fact: DataFrame, dim_date: DataFrame, settings: Settings | None = None,
                      ordered: bool = True) -> DataFrame:
    """M3: daily rides, revenue, average fare and distance per fleet."""
    agg = fact.groupBy("fleet", "date_key").agg(
        F.count(F.lit(1)).alias("rides"),
        F.sum("total_amount").alias("_rev"),
        F.avg("fare_amount").alias("_fare"),
        F.avg("trip_distance").alias("_dist"),
    )
    d = _date_dim(dim_date, settings).select("date_key", "date", "weekday_name", "is_weekend")
    out = agg.join(d, "date_key").select(
        "fleet", "date", "weekday_name", "is_weekend", "rides",
        round2("_rev").alias("revenue"), round2("_fare").alias("avg_fare"),
        round2("_dist").alias("avg_distance"),
    )
    return out.orderBy("fleet", "date") if ordered else out


ROUTE_LIMIT = 500
ROUTE_MIN_TRIPS = 5


def mart_route_flows(fact: DataFrame, dim_zone: DataFrame, limit: int = ROUTE_LIMIT,
                     min_trips: int = ROUTE_MIN_TRIPS) -> DataFrame:
    """M4: top pickup -> dropoff flows with both zones' names and centroids.

    F7, A6, F8, J3 (zone dimension in two roles), O4.  Ties at the cut are
    broken by fleet and the two zone ids (K12).
    """
    agg = (fact.where(F.col("pickup_location_id") != F.col("dropoff_location_id"))
           .groupBy("fleet", "pickup_location_id", "dropoff_location_id")
           .agg(F.count(F.lit(1)).alias("trips"),
                F.avg("fare_amount").alias("_fare"), F.avg("trip_distance").alias("_dist")))
    # One zone frame in both roles: the two broadcasts are the same exchange,
    # built once and reused.
    z = _zones(dim_zone)
    pz, dz = z.alias("pz"), z.alias("dz")
    out = (agg.where(F.col("trips") >= min_trips).alias("a")
           .join(pz, F.col("a.pickup_location_id") == F.col("pz.location_id"))
           .join(dz, F.col("a.dropoff_location_id") == F.col("dz.location_id"))
           .select("a.fleet", "a.pickup_location_id", "a.dropoff_location_id",
                   F.col("pz.zone").alias("pickup_zone"), F.col("dz.zone").alias("dropoff_zone"),
                   F.col("pz.borough").alias("pickup_borough"), F.col("dz.borough").alias("dropoff_borough"),
                   F.col("pz.lat").alias("pickup_lat"), F.col("pz.lng").alias("pickup_lng"),
                   F.col("dz.lat").alias("dropoff_lat"), F.col("dz.lng").alias("dropoff_lng"),
                   "a.trips", round2("a._fare").alias("avg_fare"), round2("a._dist").alias("avg_distance")))
    return out.orderBy(F.desc("trips"), "fleet", "pickup_location_id",
                       "dropoff_location_id").limit(limit)


# ---- serving queries behind the figures (V1-V5) ---------------------------------

def heatmap_grid(hourly: DataFrame, fleet: str) -> DataFrame:
    """V1: weekday x hour grid of average rides per day for one fleet, 0 where empty."""
    hours = list(range(24))
    grid = (hourly.where(F.col("fleet") == fleet)
            .groupBy("weekday", "weekday_name")
            .pivot("hour", hours).agg(F.first("avg_rides_per_day")))
    grid = grid.select("weekday", "weekday_name",
                       *[F.col(str(h)).alias(f"h{h:02d}") for h in hours])
    return grid.fillna(0.0).orderBy("weekday")


def daily_trend(daily: DataFrame) -> DataFrame:
    """V2: rides per fleet and date, in date order."""
    return daily.select("fleet", "date", "rides").orderBy("date", "fleet")


def top_zones(zone_demand: DataFrame, n: int = 12) -> DataFrame:
    """The n zones with most pickups (ties by location id)."""
    return (zone_demand.orderBy(F.desc("pickups"), "location_id").limit(n)
            .select("zone", "pickups"))


def forecast_band(forecast: DataFrame, fleet: str) -> DataFrame:
    """Held-out forecast band of one fleet, in time order."""
    return forecast.where(F.col("fleet") == fleet).orderBy("ds")


def zone_map_points(zone_demand: DataFrame) -> DataFrame:
    """V5: map points per zone."""
    return zone_demand.select("zone", "borough", "lat", "lng", "pickups", "avg_fare")

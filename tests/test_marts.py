"""Marts M1-M4 on the hand seed (3 zones, 2 dates, 11 trips) and views V1-V5."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from ridemart.operators import marts


@pytest.fixture(scope="module")
def seed(spark):
    dim_zone = spark.createDataFrame(
        [(1, "A", "Manhattan", "x", 40.75, -73.98), (2, "B", "Brooklyn", "x", 40.68, -73.94),
         (3, "C", "Queens", "x", 40.73, -73.79)],
        "location_id int, zone string, borough string, service_zone string, lat double, lng double")
    dim_date = spark.createDataFrame(
        [(20220103, dt.date(2022, 1, 3), 0, "Monday", False),
         (20220104, dt.date(2022, 1, 4), 1, "Tuesday", False)],
        "date_key int, date date, weekday long, weekday_name string, is_weekend boolean")
    rows = [(1, 2, "yellow", 8, 20220103)] * 6 + [(2, 3, "green", 18, 20220104)] * 5
    fact = spark.createDataFrame(rows, "pickup_location_id int, dropoff_location_id int, fleet string, "
                                       "pickup_hour long, date_key int")
    fact = fact.withColumns({"trip_id": F.monotonically_increasing_id(), "trip_distance": F.lit(2.0),
                             "fare_amount": F.lit(12.0), "tip_amount": F.lit(2.0),
                             "total_amount": F.lit(15.0), "trip_duration_min": F.lit(10.0),
                             "avg_speed_mph": F.lit(12.0)})
    return fact, dim_zone, dim_date


def test_zone_demand(seed):
    fact, z, _ = seed
    m = {r.location_id: r for r in marts.mart_zone_demand(fact, z).collect()}
    assert m[1].pickups == 6 and m[2].pickups == 5 and 3 not in m
    assert m[1].total_revenue == 90.0 and m[1].avg_fare == 12.0


def test_route_flows(seed):
    fact, z, _ = seed
    r = {(x.pickup_location_id, x.dropoff_location_id): x for x in marts.mart_route_flows(fact, z).collect()}
    assert r[(1, 2)].trips == 6 and r[(2, 3)].trips == 5
    assert r[(1, 2)].pickup_zone == "A" and r[(1, 2)].dropoff_borough == "Brooklyn"
    # HAVING trips >= 5: raising the bar drops the green route.
    assert marts.mart_route_flows(fact, z, min_trips=6).count() == 1


def test_daily_and_hourly(seed):
    fact, _, d = seed
    daily = marts.mart_daily_volume(fact, d)
    assert daily.agg(F.sum("rides")).first()[0] == 11
    hourly = marts.mart_hourly_volume(fact, d).collect()
    assert [(h.fleet, h.weekday, h.hour, h.rides, h.n_days, h.avg_rides_per_day) for h in hourly] == [
        ("green", 1, 18, 5, 1, 5.0), ("yellow", 0, 8, 6, 1, 6.0)]


def test_zone_join_drops_unknown_zones(seed, spark):
    fact, z, _ = seed
    extra = fact.limit(1).withColumn("pickup_location_id", F.lit(99))
    m = marts.mart_zone_demand(fact.unionByName(extra), z)
    assert m.agg(F.sum("pickups")).first()[0] == 11  # K11


def test_views(seed):
    fact, z, d = seed
    hourly = marts.mart_hourly_volume(fact, d, ordered=False)
    grid = marts.heatmap_grid(hourly, "yellow").collect()
    assert len(grid) == 1 and grid[0].h08 == 6.0 and grid[0].h09 == 0.0
    top = marts.top_zones(marts.mart_zone_demand(fact, z), 1).collect()
    assert [(t.zone, t.pickups) for t in top] == [("A", 6)]
    pts = marts.zone_map_points(marts.mart_zone_demand(fact, z))
    assert pts.columns == ["zone", "borough", "lat", "lng", "pickups", "avg_fare"]
    trend = marts.daily_trend(marts.mart_daily_volume(fact, d)).collect()
    assert [t.rides for t in trend] == [6, 5]


def test_route_tie_break_is_stable(spark, seed):
    fact, z, _ = seed
    a = [tuple(r) for r in marts.mart_route_flows(fact, z, limit=1).collect()]
    b = [tuple(r) for r in marts.mart_route_flows(fact.repartition(5), z, limit=1).collect()]
    assert a == b


def test_n_days_counts_only_days_with_rides(spark):
    # Two Mondays in the window, rides on one of them only.
    dim_date = spark.createDataFrame(
        [(20220103, dt.date(2022, 1, 3), 0, "Monday", False), (20220110, dt.date(2022, 1, 10), 0, "Monday", False)],
        "date_key int, date date, weekday long, weekday_name string, is_weekend boolean")
    fact = spark.createDataFrame([("yellow", 20220103, 8)] * 3 + [("yellow", 20220103, 9)],
                                 "fleet string, date_key int, pickup_hour long")
    rows = {r.hour: (r.rides, r.n_days, r.avg_rides_per_day) for r in marts.mart_hourly_volume(fact, dim_date).collect()}
    assert rows == {8: (3, 1, 3.0), 9: (1, 1, 1.0)}

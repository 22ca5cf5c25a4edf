"""Star schema: date, fleet, time and zone dimensions and the trip fact."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ridemart.constants import BOROUGH_CENTROID, CITY_CENTROID, FLEET_ROWS
from ridemart.functions import (date_key, day_name, day_part, is_rush_hour, is_weekend_day,
                                month_name, monday_weekday, week_start)
from ridemart.operators.joins import bounded, mark_bounded
from ridemart.session import ensure_checkpoint_dir
from ridemart.settings import Settings

FACT_COLUMNS = [
    "trip_id", "date_key", "pickup_hour", "fleet", "pickup_location_id",
    "dropoff_location_id", "passenger_count", "trip_distance", "fare_amount",
    "tip_amount", "total_amount", "trip_duration_min", "avg_speed_mph",
    "is_weekend", "is_rush_hour",
]
ZONE_COLUMNS = ["location_id", "zone", "borough", "service_zone", "lat", "lng"]


def window_days(settings: Settings) -> int:
    """Days in the half-open window (0 when inverted or empty, K1)."""
    d0, d1 = date.fromisoformat(settings.window.start), date.fromisoformat(settings.window.end)
    return max((d1 - d0).days, 0)


def dim_date(spark: SparkSession, settings: Settings) -> DataFrame:
    """One row per day of ``[start, end)`` (S9 + X1-X9)."""
    w = settings.window
    if window_days(settings) == 0:
        spine = spark.sql("SELECT CAST(NULL AS DATE) AS date").where("false")
    else:
        spine = spark.range(1).select(F.explode(F.sequence(
            F.lit(w.start).cast("date"), F.date_sub(F.lit(w.end).cast("date"), 1),
            F.expr("INTERVAL 1 DAY"))).alias("date"))
    d = F.col("date")
    return mark_bounded(spine.select(
        date_key(d).alias("date_key"),
        d,
        F.year(d).cast("long").alias("year"),
        F.month(d).cast("long").alias("month"),
        month_name(d).alias("month_name"),
        F.dayofmonth(d).cast("long").alias("day"),
        monday_weekday(d).alias("weekday"),
        day_name(d).alias("weekday_name"),
        is_weekend_day(d).alias("is_weekend"),
        week_start(d).alias("week_start"),
    ), window_days(settings))


def dim_fleet(spark: SparkSession) -> DataFrame:
    """Fixed fleet rows."""
    return mark_bounded(spark.createDataFrame(FLEET_ROWS, "fleet string, fleet_name string, color string"),
                        len(FLEET_ROWS))


def dim_time(spark: SparkSession) -> DataFrame:
    """D3: 24 hours with day part and rush flag (S10 + X14 + X15)."""
    h = F.col("id")
    return mark_bounded(spark.range(0, 24).select(
        h.alias("hour"), day_part(h).alias("day_part"), is_rush_hour(h).alias("is_rush_hour")), 24)


def default_borough_centroids(spark: SparkSession) -> DataFrame:
    rows = [(b, lat, lng) for b, (lat, lng) in BOROUGH_CENTROID.items()]
    return mark_bounded(spark.createDataFrame(rows, "borough string, lat double, lng double"), len(rows))


def dim_zone(lookup: DataFrame, centroids: DataFrame | None = None,
             borough_centroids: DataFrame | None = None) -> DataFrame:
    """Zone lookup + optional centroid table, borough then city fallback.

    ``lookup`` has location_id, zone, borough, service_zone; ``centroids``
    location_id, lat, lng (J5); ``borough_centroids`` borough, lat, lng (J6,
    defaults to the fixed borough table).  Missing coordinates take the
    borough centroid, then the city centroid (K26, X12 coalesce); P7 fixes
    the output columns.  The fixed borough table is broadcast (6 rows);
    inputs of unknown size are joined without a hint and Spark's size
    threshold picks the strategy.  The result has no recorded bound: a
    centroid table that repeats an id repeats its zone.
    """
    spark = lookup.sparkSession
    z = lookup.select(F.col("location_id").cast("int").alias("location_id"),
                      "zone", "borough", "service_zone")
    if centroids is not None:
        c = centroids.select(F.col("location_id").cast("int").alias("location_id"),
                             F.col("lat").cast("double").alias("c_lat"),
                             F.col("lng").cast("double").alias("c_lng"))
        z = z.join(c, "location_id", "left")
    else:
        z = z.withColumns({"c_lat": F.lit(None).cast("double"), "c_lng": F.lit(None).cast("double")})
    b = borough_centroids if borough_centroids is not None else default_borough_centroids(spark)
    bb = b.select("borough", F.col("lat").alias("b_lat"), F.col("lng").alias("b_lng"))
    known = getattr(b, "_ridemart_max_rows", None)
    z = z.join(F.broadcast(bb) if known is not None else bb, "borough", "left")
    out = z.select(
        "location_id", "zone", "borough", "service_zone",
        F.coalesce("c_lat", "b_lat", F.lit(CITY_CENTROID[0])).alias("lat"),
        F.coalesce("c_lng", "b_lng", F.lit(CITY_CENTROID[1])).alias("lng"),
    )
    return out


def read_zone_lookup_csv(spark: SparkSession, path: str) -> DataFrame:
    """S5 + P6: zone lookup CSV with header -> snake_case columns."""
    raw = (spark.read.option("header", True)
           .schema("LocationID int, Borough string, Zone string, service_zone string").csv(path))
    return raw.withColumnsRenamed({"LocationID": "location_id", "Borough": "borough", "Zone": "zone"})


def fact_rows(staged: DataFrame) -> DataFrame:
    """D5 without the surrogate key: P8 over the staged trips.

    Marts read this; Catalyst prunes it to the columns each one needs.
    """
    return staged.select(
        date_key("pickup_date").alias("date_key"),
        "pickup_hour", "fleet", "pickup_location_id", "dropoff_location_id",
        "passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount",
        "trip_duration_min", "avg_speed_mph", "is_weekend", "is_rush_hour",
    )


def id_partitions(df: DataFrame, requested: int | None = None) -> int:
    """Partitions for the id sort: as requested, else one per input split.

    Input splits are sized by ``spark.sql.files.maxPartitionBytes``, so the
    count grows with the data and is known from planning alone (no job).
    The floor is the cluster's default parallelism, so every core takes part
    (an explicit count is never coalesced by AQE, so no fixed large floor).
    """
    if requested:
        return int(requested)
    return max(df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions())


def with_dense_ids(df: DataFrame, order_cols: list[str], id_col: str,
                   partitions: int | None = None) -> DataFrame:
    """Dense 1..n ids in the total order of ``order_cols`` (NULLS FIRST).

    A single global ``row_number()`` window runs in one task.  Instead the
    rows are range-partitioned on the full sort key (a hot day or zone is
    split across partitions by the later key columns), sorted within
    partitions, numbered locally, and checkpointed to the shared checkpoint
    folder so the numbering is fixed before the per-partition offsets are
    summed.  The offset table has one row per partition (a known bound) and
    is broadcast.  Rows equal on every ``order_cols`` column may swap ids.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n = id_partitions(df, partitions)
    keys = [F.col(c).asc_nulls_first() for c in order_cols]
    local = (df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
             .withColumn("_pid", F.spark_partition_id())
             .withColumn("_mono", F.monotonically_increasing_id())
             .checkpoint(eager=True))
    per_part = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_first",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    out = local.join(bounded(offsets, known_max_rows=n), "_pid")
    ids = (F.col("_offset") + (F.col("_mono") - F.col("_first")) + 1).cast("long").alias(id_col)
    return out.select(ids, *[c for c in df.columns])


def with_scan_ids(df: DataFrame, id_col: str) -> DataFrame:
    """W1 without a shuffle: dense 1..n ids in scan order.

    Numbers rows by input partition and position, then adds per-partition
    offsets (one row per partition, broadcast).  No data moves and nothing
    is checkpointed: for a fixed set of input files the split-to-partition
    assignment and the row order inside a split are fixed, so the two
    passes (offsets, then ids) see the same numbering, and so does a task
    recomputed after an executor loss.  The id order is the storage order,
    not a sort order.
    """
    local = (df.withColumn("_pid", F.spark_partition_id())
             .withColumn("_mono", F.monotonically_increasing_id()))
    per_part = local.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"), F.min("_mono").alias("_first"))
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_part.select("_pid", "_first",
                              F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    n_parts = df.rdd.getNumPartitions()
    out = local.join(bounded(offsets, known_max_rows=n_parts), "_pid")
    ids = (F.col("_offset") + (F.col("_mono") - F.col("_first")) + 1).cast("long").alias(id_col)
    return out.select(ids, *df.columns)


def fact_trip(staged: DataFrame, settings: Settings | None = None) -> DataFrame:
    """The trip fact with a dense ``trip_id``.

    ``settings.fact_ids`` picks the numbering: ``"scan"`` (default) numbers
    in storage order without moving data; ``"sorted"`` numbers in the order
    of the fact columns after a range sort, which is reproducible anywhere.
    """
    rows = fact_rows(staged)
    mode = settings.fact_ids if settings else "scan"
    if mode == "scan":
        return with_scan_ids(rows, "trip_id").select(*FACT_COLUMNS)
    if mode != "sorted":
        raise ValueError(f"unknown fact id mode {mode!r}")
    order = [c for c in FACT_COLUMNS if c != "trip_id"]
    parts = settings.id_partitions if settings else None
    return with_dense_ids(rows, order, "trip_id", parts).select(*FACT_COLUMNS)

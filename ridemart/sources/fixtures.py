"""Trips and zones derived from the driver tables (FIXTURES.md part B).

No taxi data exists in the test environment, so a fixed projection turns the
``events`` table into raw trips and ``nation``/``region`` into zone inputs.
The same expressions appear, in DuckDB dialect, in the oracle SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fleet assignment of the fixture: these event types become yellow trips.
YELLOW_EVENT_TYPES = ("view", "click", "purchase")


#: Columns of the driver tables that the fixture reads.
SCHEMAS = {
    "events": "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "region": "r_regionkey int, r_name string",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table; the schema is stated, so opening it starts no job."""
    return spark.read.schema(SCHEMAS[name]).parquet(f"{str(sf_dir).rstrip('/')}/{name}.parquet")


def raw_trips_from_events(events: DataFrame) -> DataFrame:
    """Normalised raw trips (the columns a raw-file scan produces), one scan.

    ``k`` is the top-level ``$.k`` of ``props``.  ``json_tuple`` parses the
    document once per row in a generator; a scalar expression would be
    inlined by predicate pushdown into every cleaning predicate that uses
    the dropoff time and parsed again for each.
    """
    e = (events.select("event_id", "ts", "user_id", "event_type", "value",
                       F.json_tuple("props", "k").alias("k_text"))
         .withColumn("k", F.col("k_text").cast("int")))
    amount = F.floor(F.col("value") * 4).cast("double") / 4
    return e.select(
        F.when(F.col("event_type").isin(*YELLOW_EVENT_TYPES), "yellow").otherwise("green").alias("fleet"),
        F.col("ts").alias("pickup_datetime"),
        F.timestamp_add("MINUTE", F.col("k") * 2, F.col("ts")).alias("dropoff_datetime"),
        (F.col("user_id") % 27 + 1).cast("int").alias("pickup_location_id"),
        ((F.col("event_id") * 7) % 27 + 1).cast("int").alias("dropoff_location_id"),
        F.when(F.col("event_id") % 10 == 9, F.lit(None).cast("double"))
         .otherwise((F.col("event_id") % 8).cast("double")).alias("passenger_count"),
        F.when(F.col("event_id") % 50 == 0, F.lit(0.0))
         .when(F.col("event_id") % 37 == 0, F.lit(0.5))
         .otherwise(F.floor("value").cast("double") / 4).alias("trip_distance"),
        amount.alias("fare_amount"),
        (amount * (F.col("k") % 8) / 4).alias("tip_amount"),
        (amount * (F.col("k") % 8 + 4) / 4 + 1).alias("total_amount"),
        (F.col("k") % 6).alias("payment_type"),
    )


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw_trips_from_events(table(spark, sf_dir, "events"))


def zone_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zone_lookup_from(table(spark, sf_dir, "nation"), table(spark, sf_dir, "region"))


def zone_lookup_from(n: DataFrame, r: DataFrame) -> DataFrame:
    """Zone lookup rows: ids 1..25 from nations, boroughs from regions."""
    return n.join(r, n.n_regionkey == r.r_regionkey).select(
        (F.col("n_nationkey") + 1).alias("location_id"),
        F.col("n_name").alias("zone"),
        F.col("r_name").alias("borough"),
        F.lit("Boro Zone").alias("service_zone"),
    )


def zone_centroids_from(n: DataFrame) -> DataFrame:
    """Centroids for even nation keys only, so fallbacks are exercised."""
    step = F.col("n_nationkey") / F.lit(64.0)
    return n.where(F.col("n_nationkey") % 2 == 0).select(
        (F.col("n_nationkey") + 1).alias("location_id"),
        (F.lit(40.5) + step).alias("lat"),
        (F.lit(-74.25) + step).alias("lng"),
    )


def borough_centroids_from(r: DataFrame) -> DataFrame:
    """Borough fallback for regions 0..3; region 4 falls to the city default."""
    return r.where(F.col("r_regionkey") < 4).select(
        F.col("r_name").alias("borough"),
        (F.lit(40.0) + F.col("r_regionkey")).alias("lat"),
        (F.lit(-74.0) - F.col("r_regionkey")).alias("lng"),
    )


def write_landing(spark: SparkSession, sf_dir: str, landing_dir: str, month: str = "2024-01") -> list[str]:
    """Land the fixture trips as raw fleet-month files with fleet-prefixed columns.

    Used by tests of the file path (S1-S3): the same trips as
    ``raw_trips`` but shaped like the published trip files (``tpep_``/
    ``lpep_`` timestamps, ``PULocationID``/``DOLocationID`` and payment type
    as BIGINT).
    """
    from ridemart.constants import FLEET_PREFIX
    from ridemart.sources.landing import raw_file_name

    raw = raw_trips(spark, sf_dir)
    written = []
    for fleet, prefix in FLEET_PREFIX.items():
        out = raw.where(F.col("fleet") == fleet).select(
            F.col("pickup_datetime").alias(f"{prefix}_pickup_datetime"),
            F.col("dropoff_datetime").alias(f"{prefix}_dropoff_datetime"),
            "passenger_count", "trip_distance",
            F.col("pickup_location_id").cast("long").alias("PULocationID"),
            F.col("dropoff_location_id").cast("long").alias("DOLocationID"),
            F.col("payment_type").cast("long").alias("payment_type"),
            "fare_amount", "tip_amount", "total_amount")
        path = f"{landing_dir.rstrip('/')}/{raw_file_name(fleet, month)}"
        out.write.mode("overwrite").parquet(path)
        written.append(path)
    return written


#: The landed table's second file begins here.
SECOND_FILE = "2024-01-16"


def write_drifted_landing(spark: SparkSession, sf_dir: str, landing_dir: str) -> None:
    """The fixture trips as two files per fleet, ``2024-01`` and from ``SECOND_FILE`` on ``2024-02``, in the order of their columns.

    The second has DOUBLE location ids and payment types where the first has
    BIGINT, the way published files drift.
    """
    from ridemart.constants import FLEET_PREFIX
    from ridemart.sources.landing import raw_file_name

    raw = raw_trips(spark, sf_dir)
    for fleet, prefix in FLEET_PREFIX.items():
        for month, kind, part in (("2024-01", "long", F.col("pickup_datetime") < SECOND_FILE), ("2024-02", "double", F.col("pickup_datetime") >= SECOND_FILE)):
            rows = raw.where((F.col("fleet") == fleet) & part).orderBy(*raw.columns)
            rows.select(
                F.col("pickup_datetime").alias(f"{prefix}_pickup_datetime"), F.col("dropoff_datetime").alias(f"{prefix}_dropoff_datetime"),
                "passenger_count", "trip_distance", F.col("pickup_location_id").cast(kind).alias("PULocationID"),
                F.col("dropoff_location_id").cast(kind).alias("DOLocationID"), F.col("payment_type").cast(kind).alias("payment_type"),
                "fare_amount", "tip_amount", "total_amount",
            ).write.mode("overwrite").parquet(f"{landing_dir.rstrip('/')}/{raw_file_name(fleet, month)}")


def write_zone_lookup_csv(spark: SparkSession, sf_dir: str, path: str) -> str:
    """The fixture zone lookup as a CSV with the published header."""
    zone_lookup(spark, sf_dir).select(
        F.col("location_id").alias("LocationID"), F.col("borough").alias("Borough"),
        F.col("zone").alias("Zone"), "service_zone",
    ).coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path

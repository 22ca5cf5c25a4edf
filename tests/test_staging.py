"""Cleaning (D6, F1-F6, A8) on the fixture trips, and the raw-file path."""

from pyspark.sql import functions as F

from ridemart.operators import staging

from support import shown_settings as fixture_settings
from ridemart.sources import fixtures, landing

from support import SF001


def test_bounds_hold_after_cleaning(inputs001, settings):
    df = inputs001.clean()
    c = settings.cleaning
    bad = df.where(
        ~F.col("fare_amount").between(c.min_fare, c.max_fare)
        | ~F.col("trip_distance").between(c.min_distance, c.max_distance)
        | ~F.col("trip_duration_min").between(c.min_duration_min, c.max_duration_min)
        | (F.col("dropoff_datetime") <= F.col("pickup_datetime"))
        | ~F.col("pickup_hour").between(0, 23) | ~F.col("pickup_weekday").between(0, 6))
    assert bad.count() == 0
    assert df.columns == staging.STAGED_COLUMNS
    types = dict(df.dtypes)
    assert types["pickup_hour"] == "bigint" and types["pickup_weekday"] == "bigint"
    assert types["pickup_datetime"] == "timestamp_ntz" and types["payment_type"] == "int"


def test_fixture_counts_match_published_table(inputs001):
    # FIXTURES.md part B, sf0.001 row.
    s = staging.clean_summary(inputs001.raw(), inputs001.settings).first()
    assert (s.rows_raw, s.rows_clean, s.rows_removed) == (1000, 672, 328)
    assert s.removed_pct == 32.8
    clean = inputs001.clean()
    assert clean.agg(F.sum("fare_amount")).first()[0] == 33689.5
    assert clean.select("pickup_date").distinct().count() == 29


def test_cleaning_drops_negative_fares(spark, inputs001, settings):
    raw = inputs001.raw().withColumn(
        "fare_amount", F.when(F.col("pickup_location_id") == 1, F.lit(-10.0)).otherwise(F.col("fare_amount")))
    clean = staging.clean_trips(raw, settings)
    assert clean.where("fare_amount < 0").count() == 0
    assert clean.where("pickup_location_id = 1").count() == 0


def test_passenger_null_counts_as_one_and_bounds_inclusive(spark, settings):
    rows = [("yellow", "2024-01-02 10:00:00", "2024-01-02 10:10:00", 1, 2, None, 0.0, 0.0, 0.0, 1.0, 1),
            ("yellow", "2024-01-02 10:00:00", "2024-01-02 13:00:00", 1, 2, 6.0, 100.0, 500.0, 0.0, 1.0, 1),
            ("yellow", "2024-01-02 10:00:00", "2024-01-02 10:00:59", 1, 2, 1.0, 1.0, 5.0, 0.0, 1.0, 1),
            ("yellow", "2024-01-02 10:00:00", "2024-01-02 10:10:00", 1, 2, 7.0, 1.0, 5.0, 0.0, 1.0, 1),
            ("yellow", "2024-01-30 00:00:00", "2024-01-30 00:10:00", 1, 2, 1.0, 1.0, 5.0, 0.0, 1.0, 1)]
    schema = ("fleet string, p string, d string, pickup_location_id int, dropoff_location_id int, "
              "passenger_count double, trip_distance double, fare_amount double, tip_amount double, "
              "total_amount double, payment_type int")
    raw = spark.createDataFrame(rows, schema).select(
        "fleet", F.col("p").cast("timestamp_ntz").alias("pickup_datetime"),
        F.col("d").cast("timestamp_ntz").alias("dropoff_datetime"), *[c for c in schema.split(", ")[3:]
                                                                      for c in [c.split(" ")[0]]])
    kept = staging.clean_trips(raw, settings).collect()
    # kept: NULL passengers (as 1, zero fare and distance survive: K2, K3) and the
    # all-upper-bounds row; dropped: 59 s trip, 7 passengers, window end (K1).
    assert len(kept) == 2
    assert {r.trip_duration_min for r in kept} == {10.0, 180.0}


def test_raw_files_round_trip(spark, scratch):
    settings = fixture_settings().replace(ingest={"months": ("2024-01", "2024-02")})
    paths = fixtures.write_landing(spark, SF001, scratch + "/landing", "2024-01")
    assert len(paths) == 2
    files = landing.discover_landing(spark, scratch + "/landing", settings)
    assert sorted(f["fleet"] for f in files) == ["green", "yellow"]  # 2024-02 missing: warned
    raw = landing.read_landing(spark, scratch + "/landing", settings)
    direct = fixtures.raw_trips(spark, SF001)
    assert sorted(raw.columns) == sorted(direct.columns)
    assert raw.exceptAll(direct.select(*raw.columns)).count() == 0
    assert raw.count() == direct.count()


def test_row_sample_is_per_file_and_repeatable(spark, scratch):
    fixtures.write_landing(spark, SF001, scratch + "/landing", "2024-01")
    settings = fixture_settings().replace(ingest={"months": ("2024-01",), "sample_rows": 50})
    raw = landing.read_landing(spark, scratch + "/landing", settings)
    counts = {r.fleet: r["count"] for r in raw.groupBy("fleet").count().collect()}
    assert all(30 <= counts[f] <= 75 for f in ("yellow", "green"))
    again = landing.read_landing(spark, scratch + "/landing", settings)
    assert raw.exceptAll(again).count() == 0 == again.exceptAll(raw).count()


def test_no_files_is_an_error(spark, scratch):
    import pytest

    with pytest.raises(FileNotFoundError):
        landing.discover_landing(spark, scratch + "/empty", fixture_settings())


def test_int_cast_rounds_half_even(spark):
    raw = spark.createDataFrame([(3.6, 2.5, 1.0)], "PULocationID double, DOLocationID double, payment_type double")
    raw = raw.select(F.lit("2024-01-01").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
                     F.lit("2024-01-01").cast("timestamp_ntz").alias("tpep_dropoff_datetime"),
                     "*", *[F.lit(1.0).alias(c) for c in ["passenger_count", "trip_distance",
                                                           "fare_amount", "tip_amount", "total_amount"]])
    r = landing.normalize_fleet(raw, "yellow").first()
    assert (r.pickup_location_id, r.dropoff_location_id) == (4, 2)


def test_null_measure_drops_row(spark, settings):
    raw = spark.createDataFrame(
        [("yellow", 1, 2, 1.0, None, 5.0, 0.0, 6.0, 1), ("yellow", 1, 2, 1.0, 1.0, 5.0, 0.0, 6.0, 1)],
        "fleet string, pickup_location_id int, dropoff_location_id int, passenger_count double, "
        "trip_distance double, fare_amount double, tip_amount double, total_amount double, payment_type int")
    raw = raw.withColumns({"pickup_datetime": F.lit("2024-01-02 10:00:00").cast("timestamp_ntz"),
                           "dropoff_datetime": F.lit("2024-01-02 10:20:00").cast("timestamp_ntz")})
    assert staging.clean_trips(raw, settings).count() == 1  # K2


def test_landing_manifest_frame(spark, scratch):
    fixtures.write_landing(spark, SF001, scratch + "/landing", "2024-01")
    files = landing.discover_landing(spark, scratch + "/landing", fixture_settings().replace(ingest={"months": ("2024-01",)}))
    m = landing.landing_manifest(spark, files)
    assert m.columns == ["fleet", "month", "path", "source"]
    assert sorted((r.fleet, r.month) for r in m.collect()) == [("green", "2024-01"), ("yellow", "2024-01")]


def test_files_of_drifting_types_are_read_by_group(spark, scratch):
    for k in range(6):  # six months of two kinds
        month = f"2024-{k + 1:02d}"
        kind = "double" if k % 2 else "long"
        (spark.range(40).select(
            *[F.lit(f"{month}-05 10:00:00").cast("timestamp_ntz").alias(f"tpep_{c}_datetime") for c in ("pickup", "dropoff")],
            *[(F.col("id") + (0.6 if k % 2 else 0)).cast(kind).alias(c) for c in ("PULocationID", "DOLocationID", "payment_type")],
            *[F.lit(1.0).alias(c) for c in ("passenger_count", "trip_distance", "fare_amount", "tip_amount", "total_amount")],
            *([F.lit("x").alias("airport_fee")] if k == 3 else []))
         .repartition(1 + k % 3).write.parquet(f"{scratch}/l/yellow_tripdata_{month}.parquet"))
    s = fixture_settings().replace(ingest={"fleets": ("yellow",), "months": tuple(f"2024-{k + 1:02d}" for k in range(6))})
    raw = landing.read_landing(spark, scratch + "/l", s, with_month=True)
    assert raw._jdf.queryExecution().executedPlan().toString().count("FileScan") == 2
    counts = {r.landed_month: (r.n, r.top) for r in raw.groupBy("landed_month").agg(F.count("*").alias("n"), F.max("pickup_location_id").alias("top")).collect()}
    assert counts == {f"2024-{k + 1:02d}": (40, 40 if k % 2 else 39) for k in range(6)}


def test_exact_row_cap_per_file(spark, scratch):
    fixtures.write_drifted_landing(spark, SF001, scratch + "/l")
    months = {"months": ("2024-01", "2024-02")}
    whole = landing.read_landing(spark, scratch + "/l", fixture_settings().replace(ingest=months), with_month=True)
    sizes = {(r.fleet, r.landed_month): r["count"] for r in whole.groupBy("fleet", "landed_month").count().collect()}
    for cap in (1, 150, 250, 10_000):
        raw = landing.read_landing(spark, scratch + "/l", fixture_settings().replace(ingest={**months, "sample_rows": cap}), with_month=True)
        got = {(r.fleet, r.landed_month): r["count"] for r in raw.groupBy("fleet", "landed_month").count().collect()}
        assert got == {k: min(cap, n) for k, n in sizes.items()}
        assert raw.exceptAll(whole).count() == 0
        assert "Exchange hash" not in raw._jdf.queryExecution().executedPlan().toString()


def test_sample_step_visits_every_row_once():
    for n in (1, 2, 3, 10, 97, 360, 1000, 6936):
        step = landing.spread_step(n)
        assert len({i * step % n for i in range(n)}) == n


def test_manifest_counts_every_landed_file(spark, scratch):
    fixtures.write_drifted_landing(spark, SF001, scratch + "/l")
    settings = fixture_settings().replace(ingest={"months": ("2024-01", "2024-02")})
    spark.read.parquet(scratch + "/l/green_tripdata_2024-01.parquet").limit(0).write.parquet(scratch + "/l/green_tripdata_2024-03.parquet")
    files = landing.discover_landing(spark, scratch + "/l", settings.replace(ingest={"months": ("2024-01", "2024-02", "2024-03")}))
    rows = {(r.fleet, r.month): r for r in landing.landing_counts(spark, files).collect()}
    assert sum(r.rows for r in rows.values()) == 1000 and rows["green", "2024-03"].rows == 0
    assert all(r.bytes > 0 and r.parts > 0 for k, r in rows.items() if k[1] != "2024-03")

"""Contract (Q1-Q9) and full-table metrics (Q10)."""

from pyspark.sql import functions as F

from ridemart.operators import quality


def test_clean_table_has_no_contract_failures(inputs001, settings):
    f = quality.contract_failures(inputs001.clean(), settings)
    assert f.where("failures > 0").count() == 0
    assert quality.contract_report(f)["passed"]


def test_out_of_range_fares_are_counted(inputs001, settings):
    clean = inputs001.clean().withColumn("_r", F.monotonically_increasing_id())
    n = clean.count()
    half = clean.orderBy("_r").limit(n // 2).select("_r")
    bad = (clean.join(half.withColumn("_bad", F.lit(True)), "_r", "left")
           .withColumn("fare_amount", F.when(F.col("_bad"), F.lit(10000.0)).otherwise(F.col("fare_amount")))
           .drop("_r", "_bad"))
    f = {(r.column_name, r.check_name): r.failures for r in quality.contract_failures(bad, settings).collect()}
    assert f[("fare_amount", "in_range(0.0,500.0)")] == n // 2
    rep = quality.contract_report(quality.contract_failures(bad, settings))
    assert not rep["passed"] and rep["errors"] == [{"check_name": "in_range(0.0,500.0)", "n": n // 2}]


def test_contract_nulls_types_and_missing_columns(spark, settings):
    df = spark.createDataFrame(
        [("yellow", None, "x", 1.0), ("taxi", "2024-01-01 00:00:00", "3", -1.0)],
        "fleet string, pickup_datetime string, pickup_location_id string, passenger_count double")
    f = {(r.column_name, r.check_name): r.failures for r in quality.contract_failures(df, settings).collect()}
    assert f[("fleet", "isin(yellow,green)")] == 1
    assert f[("pickup_datetime", "not_nullable")] == 1
    assert f[("pickup_location_id", "coerce(int)")] == 1
    assert f[("passenger_count", "ge(0)")] == 1
    assert f[("trip_distance", "column_present")] == 1


def test_metrics(inputs001):
    m = quality.quality_metrics(inputs001.clean()).first()
    assert m.row_count == 672
    assert m.duplicate_groups == 0
    assert 0 < m.null_rate_passenger_count < 1 and m.null_rate_fare_amount == 0.0
    assert m.min_trip_distance == 0.0 and m.max_fare_amount <= 500


def test_metrics_empty_table(inputs001):
    m = quality.quality_metrics(inputs001.clean().where("false")).first()
    assert m.row_count == 0 and m.null_rate_fare_amount == 0.0
    assert m.min_fare_amount is None and m.date_min is None  # K27


def test_duplicate_groups(inputs001):
    clean = inputs001.clean()
    doubled = clean.unionByName(clean.limit(3))
    assert quality.duplicate_groups(doubled).count() == 3
    assert quality.quality_metrics(doubled).first().duplicate_groups == 3

"""Scalar helpers and K-items (K4-K9) against hand cases and DuckDB."""

import datetime as dt

import duckdb
from pyspark.sql import functions as F

from ridemart import functions as X


def one(spark, col, sql_values="SELECT 1"):
    return spark.sql(sql_values).select(col.alias("v")).first()["v"]


def test_round_half_up_matches_duckdb(spark):
    values = [1.005, 2.675, 0.125, 10.0 / 3, 1234.565, 0.0, 7.995]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r["r"] for r in df.select(X.round2("x").alias("r")).collect()]
    want = [duckdb.sql(f"SELECT floor(CAST({v!r} AS DOUBLE) * 100 + 0.5) / 100").fetchall()[0][0] for v in values]
    assert got == want


def test_weekday_monday_zero_and_names(spark):
    df = spark.createDataFrame([(dt.date(2024, 1, 1),), (dt.date(2024, 1, 7),)], "d date")
    rows = df.select(X.monday_weekday("d").alias("w"), X.day_name("d").alias("n"),
                     X.month_name("d").alias("m"), X.is_weekend_day("d").alias("we"),
                     X.week_start("d").alias("ws"), X.date_key("d").alias("k")).collect()
    assert [(r.w, r.n, r.m, r.we) for r in rows] == [(0, "Monday", "January", False),
                                                   (6, "Sunday", "January", True)]
    assert rows[1].ws == dt.date(2024, 1, 1)
    assert rows[0].k == 20240101


def test_minutes_between_keeps_fractions(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00' a, "
                   "timestamp_ntz'2024-01-01 00:01:30.5' b")
    assert df.select(X.minutes_between("a", "b")).first()[0] == 90.5 / 60


def test_safe_divide_zero_is_null(spark):
    df = spark.sql("SELECT 5.0 AS a, 0.0 AS b")
    assert df.select(X.safe_divide("a", "b")).first()[0] is None


def test_hour_start_stays_ntz(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 05:59:59.9' AS t").select(X.hour_start("t").alias("h"))
    assert df.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert df.first()["h"] == dt.datetime(2024, 1, 1, 5)


def test_day_part_and_rush_hour(spark):
    df = spark.range(24).select(X.day_part("id").alias("p"), X.is_rush_hour("id").alias("r"))
    rows = df.collect()
    assert rows[5].p == "Overnight" and rows[6].p == "Morning" and rows[10].p == "Midday"
    assert rows[16].p == "Evening" and rows[20].p == "Night"
    assert [i for i, r in enumerate(rows) if r.r] == [7, 8, 9, 16, 17, 18, 19]


def test_distance_band_edges(spark):
    df = spark.createDataFrame([(v,) for v in [0.0, 0.99, 1.0, 2.99, 3.0, 5.0, 9.99, 10.0, 95.0]], "d double")
    got = [r[0] for r in df.select(X.distance_band("d")).collect()]
    assert got == ["<1", "<1", "1-3", "1-3", "3-5", "5-10", "5-10", "10+", "10+"]


def test_round_is_symmetric_and_passes_odd_values(spark):
    values = [-0.125, 0.125, 1.005, -2.5, float("nan"), float("inf"), float("-inf"), None, 0.0, 1e300]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(X.round2("x")).collect()]
    assert got[:4] == [-0.13, 0.13, 1.0, -2.5]
    assert got[4] != got[4] and got[5:8] == [float("inf"), float("-inf"), None] and got[8:] == [0.0, 1e300]


def test_fourier_terms_are_plain(spark):
    import math

    cols = X.fourier_terms(F.lit(6), 24, 2, "d")
    row = spark.range(1).select(*cols).first()
    assert row["d_sin1"] == 1.0 and row["d_cos1"] == math.cos(math.pi / 2) != 0.0
    assert list(row.asDict()) == ["d_sin1", "d_cos1", "d_sin2", "d_cos2"]


def test_clip_lower(spark):
    df = spark.createDataFrame([(-2.0,), (3.0,), (None,)], "x double")
    assert [r[0] for r in df.select(X.clip_lower("x")).collect()] == [0.0, 3.0, None]


def test_zone_free_under_dst_session(spark):
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.sql("SELECT timestamp_ntz'2024-03-10 01:30:00' a, timestamp_ntz'2024-03-10 03:30:00' b")
        r = df.select(X.minutes_between("a", "b").alias("m"), X.hour_start("b").alias("h")).first()
        assert r.m == 120.0 and r.h == dt.datetime(2024, 3, 10, 3)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_settings_from_dict():
    import pytest

    from ridemart.settings import settings_from_dict

    s = settings_from_dict({"window": {"start": "2024-01-01", "end": "2024-01-30"},
                            "forecast": {"fleets": ["yellow"]}, "fact_ids": "scan"})
    assert s.window.start == "2024-01-01" and s.forecast.fleets == ("yellow",) and s.fact_ids == "scan"
    assert s.cleaning.max_fare == 500.0
    with pytest.raises(TypeError):
        settings_from_dict({"window": {"begin": "2024-01-01"}})

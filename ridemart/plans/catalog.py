"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per key.

All of them start from the driver tables through the fixture projection
(``ridemart.sources.fixtures``) and run the library's stage functions over
the whole tables.
"""

from __future__ import annotations

import dataclasses
import hashlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ridemart.functions import round_half_up
from ridemart.operators import anomaly, bi, dims, forecast, marts, quality, series, staging
from ridemart.operators.sampling import sample_rows
from ridemart.plans import jobs
from ridemart.session import ensure_checkpoint_dir
from ridemart.settings import Settings, fixture_settings
from ridemart.sources import fixtures, landing, sinks


class Inputs:
    """Frames of one query over one input folder; each table is opened once per instance."""

    def __init__(self, spark: SparkSession, sf_dir: str, settings: Settings | None = None):
        self.spark, self.sf_dir = spark, sf_dir
        self.settings = settings or fixture_settings()
        self._opened: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._opened:
            self._opened[name] = fixtures.table(self.spark, self.sf_dir, name)
        return self._opened[name]

    def raw(self) -> DataFrame:
        return fixtures.raw_trips_from_events(self.table("events"))

    def featured(self) -> DataFrame:
        """Raw trips with the engineered columns, before any cleaning."""
        return staging.with_features(self.raw())

    def clean(self) -> DataFrame:
        return staging.clean_trips(self.raw(), self.settings)

    def fact(self) -> DataFrame:
        """Fact rows without the surrogate key (what the marts read)."""
        return dims.fact_rows(self.clean())

    def fact_with_ids(self) -> DataFrame:
        """The fact with dense ids in a reproducible order, so that SQL can number it alike."""
        return dims.fact_trip(self.clean(), dataclasses.replace(self.settings, fact_ids="sorted"))

    def dim_zone(self) -> DataFrame:
        n, r = self.table("nation"), self.table("region")
        return dims.dim_zone(fixtures.zone_lookup_from(n, r), fixtures.zone_centroids_from(n), fixtures.borough_centroids_from(r))

    def dim_date(self) -> DataFrame:
        return dims.dim_date(self.spark, self.settings)

    def zone_demand(self, ordered: bool = True) -> DataFrame:
        return marts.mart_zone_demand(self.fact(), self.dim_zone(), ordered)

    def hourly(self, ordered: bool = True) -> DataFrame:
        return marts.mart_hourly_volume(self.fact(), self.dim_date(), self.settings, ordered)

    def daily(self, ordered: bool = True) -> DataFrame:
        return marts.mart_daily_volume(self.fact(), self.dim_date(), self.settings, ordered)

    def series(self) -> DataFrame:
        return series.hourly_series(self.clean(), self.settings)

    def rule_input(self) -> DataFrame:
        """The rules' input over the trips before cleaning, where features can be NULL."""
        return anomaly.scoring_input(dims.fact_rows(self.featured()), self.settings)

    def _handed_over(self, purpose: str, names: list[str], build: Callable[[str], dict[str, DataFrame]]) -> dict[str, DataFrame]:
        """Tables written once below the shared checkpoint folder for these files and settings, and read by all that need them.

        The folder's name follows from the input files (path, size, time) and the
        application, so changed input makes new tables, and no table of other
        code is read.
        """
        sc = self.spark.sparkContext
        fs = sc._jvm.org.apache.hadoop.fs
        stamp = []
        for f in sorted(self.table("events").inputFiles()):
            path = fs.Path(f)
            status = path.getFileSystem(sc._jsc.hadoopConfiguration()).getFileStatus(path)
            stamp.append((f, status.getLen(), status.getModificationTime()))
        digest = hashlib.sha256(repr((stamp, self.settings, sc.applicationId)).encode()).hexdigest()[:16]
        folder = f"{ensure_checkpoint_dir(self.spark)}/{purpose}-{digest}"
        done = fs.Path(f"{folder}/done/_SUCCESS")
        if not done.getFileSystem(sc._jsc.hadoopConfiguration()).exists(done):
            for name, df in build(folder).items():
                if name in names:
                    sinks.write_table(df, f"{folder}/{name}")
            sinks.write_report(self.spark, {"tables": names}, f"{folder}/done")
        return {name: self.spark.read.parquet(f"{folder}/{name}") for name in names}

    def forecast(self) -> dict[str, DataFrame]:
        """Forecast tables: all fits run once, their result is a written table."""
        def build(folder: str) -> dict[str, DataFrame]:
            return forecast.forecast(self.series(), self.settings, f"{folder}/predictions")
        return self._handed_over("forecast", ["mart_forecast", "mart_forecast_metrics", "mart_forecast_backtest"], build)

    def plain_forecast(self) -> dict[str, DataFrame]:
        """The same tables from a model without a fit, which SQL can repeat."""
        s = self.series()
        return forecast.forecast_tables(forecast.two_week_mean(s, self.settings), s, self.settings, "two_week_mean")

    def anomalies(self) -> dict[str, DataFrame]:
        """Anomaly tables of the forest, grown once; the scored rows are a written table."""
        def build(folder: str) -> dict[str, DataFrame]:
            return anomaly.detect(self.fact_with_ids(), self.settings, f"{folder}/scores")
        return self._handed_over("anomaly", ["mart", "summary"], build)

    def plain_anomalies(self) -> dict[str, DataFrame]:
        """The same tables from the largest z-score, which SQL can repeat."""
        folder = f"{ensure_checkpoint_dir(self.spark)}/z-scores-{uuid.uuid4().hex}"
        return anomaly.detect(self.fact_with_ids(), self.settings, folder, anomaly.largest_z)


HEATMAP_FLEET = "yellow"
TOP_ZONES = 12
SAMPLE_ROWS = 1_000
TOP_ANOMALIES = 100
#: A coarser key than the contract's, which raw trips do repeat.
REPEATED_KEY = ["fleet", "pickup_location_id", "dropoff_location_id", "fare_amount"]
#: F1 is shown on a window that ends before the table does.
SHOWN_WINDOW = {"start": "2024-01-01", "end": "2024-01-30"}


SAMPLE_KEY = ["fleet", "_pickup_us", "pickup_location_id", "dropoff_location_id", "payment_type"]


def sampled_trips(i: Inputs) -> DataFrame:
    """A seeded sample of the staged trips, keyed by values that all engines print alike."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    keyed = i.clean().withColumn("_pickup_us", F.timestamp_diff("MICROSECOND", epoch, F.col("pickup_datetime")))
    return sample_rows(keyed, SAMPLE_ROWS, seed=7, key_cols=SAMPLE_KEY).drop("_pickup_us")


#: S3 is shown with so many rows of each landed file.
LANDED_CAP = 400


def _landed(i: Inputs) -> tuple[str, Settings]:
    """The trips as raw fleet-month files with prefixed columns, whose types drift from file to file; December was never landed."""
    folder = f"{ensure_checkpoint_dir(i.spark)}/landing-{uuid.uuid4().hex}"
    fixtures.write_drifted_landing(i.spark, i.sf_dir, folder)
    return folder, i.settings.replace(ingest={"months": ("2023-12", "2024-01", "2024-02")})


def landed_trips(i: Inputs) -> DataFrame:
    """Raw files of differing types discovered, grouped by type, normalised and united."""
    return landing.read_landing(i.spark, *_landed(i))


def landed_sample(i: Inputs) -> DataFrame:
    """S3: exactly ``LANDED_CAP`` rows of every landed file (all of a smaller one), spread over it."""
    folder, wanted = _landed(i)
    return landing.read_landing(i.spark, folder, wanted.replace(ingest={"sample_rows": LANDED_CAP}), with_month=True)


def landing_manifest(i: Inputs) -> DataFrame:
    """The landed files found, with their rows from the files' own metadata."""
    folder, wanted = _landed(i)
    found = landing.landing_counts(i.spark, landing.discover_landing(i.spark, folder, wanted))
    return found.select("fleet", "month", F.element_at(F.split("path", "/"), -1).alias("file"), "source", "rows", (F.col("bytes") > 0).alias("has_bytes"))


EXPORTED_CSV = ("daily", "zones")


def _exported(i: Inputs) -> tuple[str, dict[str, DataFrame]]:
    """Three marts as replaced, registered tables, exported by name with a manifest."""
    root = f"{ensure_checkpoint_dir(i.spark)}/export-{uuid.uuid4().hex}"
    tables = {"daily": i.daily(False), "hourly": i.hourly(False), "zones": i.zone_demand(False)}
    for name, df in tables.items():
        sinks.replace_table(df, f"{root}/{name}")
    stored = {name: sinks.read_table(i.spark, f"{root}/{name}") for name in tables}
    sinks.export_tables(i.spark, stored, f"{root}/bi", EXPORTED_CSV)
    return f"{root}/bi", stored


def export_manifest(i: Inputs) -> DataFrame:
    """The manifest of an export of three marts, read back."""
    folder, _ = _exported(i)
    manifest = sinks.read_manifest(i.spark, folder)
    return manifest.select("table", "rows", F.array_join("columns", ",").alias("columns"), F.array_join("formats", ",").alias("formats"))


def exported_daily(i: Inputs) -> DataFrame:
    """The daily mart's CSV extract, read back with the mart's schema."""
    folder, stored = _exported(i)
    return sinks.read_extract(i.spark, folder, "daily", stored["daily"].schema)


def catalog_counts(i: Inputs) -> DataFrame:
    """Tables replaced twice, registered by name, listed by the catalog and counted."""
    root = f"{ensure_checkpoint_dir(i.spark)}/warehouse-{uuid.uuid4().hex}"
    tables = {"shown_daily": i.daily(False), "shown_zones": i.zone_demand(False)}
    for name, df in tables.items():
        sinks.replace_table(df.limit(1), f"{root}/{name}")
        sinks.replace_table(df, f"{root}/{name}")
        sinks.register_table(i.spark, name, f"{root}/{name}")
    return sinks.catalog_counts(i.spark, list(tables))


def staged_window(i: Inputs) -> DataFrame:
    """Landed files staged into the partitioned table, one month of them twice, and the window read back."""
    folder, wanted = _landed(i)
    paths = jobs.Paths(f"{ensure_checkpoint_dir(i.spark)}/staged-{uuid.uuid4().hex}", folder)
    jobs.run_staging(i.spark, wanted, paths)
    jobs.run_staging(i.spark, wanted.replace(ingest={"months": ("2024-02",)}), paths)
    return jobs.staged_trips(i.spark, paths, shown_window(i))


def calendar_rollup(i: Inputs) -> DataFrame:
    """Rides and revenue by fleet name, month, week start and day part."""
    fact = i.fact().groupBy("fleet", "date_key", "pickup_hour").agg(F.count("*").alias("n"), F.sum("total_amount").alias("revenue"))
    day = i.dim_date().select("date_key", "year", "month_name", "week_start")
    time = dims.dim_time(i.spark).withColumnRenamed("hour", "pickup_hour")
    joined = fact.join(day, "date_key").join(F.broadcast(time), "pickup_hour").join(F.broadcast(dims.dim_fleet(i.spark)), "fleet")
    return (joined.groupBy("fleet_name", "year", "month_name", "week_start", "day_part", time["is_rush_hour"])
            .agg(F.sum("n").alias("rides"), F.sum("revenue").alias("revenue")))


def shown_window(i: Inputs) -> Settings:
    return i.settings.replace(window=SHOWN_WINDOW)


def rounded(df: DataFrame, columns: list[str], digits: int = 6) -> DataFrame:
    """Both sides of a check round values whose last bit depends on the engine."""
    return df.withColumns({c: round_half_up(c, digits) for c in columns})


BAND = ["yhat_lower", "yhat_upper"]
WAVES = [c for c in series.FEATURE_COLUMNS if "_sin" in c or "_cos" in c]


def _registered(fn: Callable[[Inputs], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return fn(Inputs(spark, sf_dir))
    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def spark_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    q = {
        "landed_trips": landed_trips,
        "landed_sample": landed_sample,
        "landing_manifest": landing_manifest,
        "staged_window": staged_window,
        "export_manifest": export_manifest,
        "exported_daily": exported_daily,
        "catalog_counts": catalog_counts,
        "clean_trips": lambda i: staging.clean_trips(i.raw(), shown_window(i)),
        "clean_summary": lambda i: staging.clean_summary(i.raw(), shown_window(i)),
        "dim_zone": lambda i: i.dim_zone(),
        "fact_trip": lambda i: i.fact_with_ids(),
        "mart_zone_demand": lambda i: i.zone_demand(),
        "mart_hourly_volume": lambda i: i.hourly(),
        "mart_daily_volume": lambda i: i.daily(),
        "mart_route_flows": lambda i: marts.mart_route_flows(i.fact(), i.dim_zone()),
        "heatmap_grid": lambda i: marts.heatmap_grid(i.hourly(False), HEATMAP_FLEET),
        "daily_trend": lambda i: marts.daily_trend(i.daily(False)),
        "top_zones": lambda i: marts.top_zones(i.zone_demand(False), TOP_ZONES),
        "zone_map_points": lambda i: marts.zone_map_points(i.zone_demand(False)),
        "quality_metrics": lambda i: quality.quality_metrics(i.clean()),
        "duplicate_groups": lambda i: quality.duplicate_groups(i.featured(), REPEATED_KEY),
        "contract_failures": lambda i: quality.contract_failures(i.featured(), i.settings),
        "contract_errors": lambda i: quality.contract_errors(quality.contract_failures(i.featured(), i.settings)),
        "calendar_rollup": calendar_rollup,
        "sampled_trips": sampled_trips,
        "hourly_series": lambda i: i.series(),
        "design_matrix": lambda i: rounded(series.design_matrix(i.series()), WAVES),
        "seasonal_naive": lambda i: series.seasonal_naive(i.series(), i.settings),
        "naive_metrics": lambda i: series.naive_metrics(i.series(), i.settings),
        "naive_backtest": lambda i: series.naive_backtest(i.series(), i.settings),
        "anomaly_rules": lambda i: anomaly.with_rules(i.rule_input()),
        "anomaly_rule_summary": lambda i: anomaly.rule_summary(i.rule_input()),
        "kpis": lambda i: bi.kpis(i.fact()),
        "week_over_week": lambda i: bi.week_over_week(i.fact(), i.dim_date(), i.settings),
        "distance_bands": lambda i: bi.distance_bands(i.fact()),
        "net_flow": lambda i: bi.net_flow(i.fact(), i.dim_zone()),
        "mart_forecast": lambda i: i.forecast()["mart_forecast"],
        "mart_forecast_metrics": lambda i: i.forecast()["mart_forecast_metrics"],
        "mart_forecast_backtest": lambda i: i.forecast()["mart_forecast_backtest"],
        "best_model": lambda i: forecast.best_model(i.forecast()["mart_forecast_metrics"]),
        "forecast_error": lambda i: bi.forecast_error(i.forecast()["mart_forecast"]),
        "forecast_band": lambda i: marts.forecast_band(i.forecast()["mart_forecast"], HEATMAP_FLEET),
        "mart_trip_anomalies": lambda i: rounded(i.anomalies()["mart"], ["anomaly_score"]),
        "anomaly_summary": lambda i: i.anomalies()["summary"],
        "anomaly_scatter": lambda i: rounded(bi.anomaly_scatter(i.anomalies()["mart"]), ["anomaly_score"]),
        "plain_forecast": lambda i: rounded(i.plain_forecast()["mart_forecast"], BAND),
        "plain_forecast_metrics": lambda i: i.plain_forecast()["mart_forecast_metrics"],
        "plain_forecast_backtest": lambda i: i.plain_forecast()["mart_forecast_backtest"],
        "plain_best_model": lambda i: forecast.best_model(i.plain_forecast()["mart_forecast_metrics"]),
        "plain_forecast_error": lambda i: bi.forecast_error(i.plain_forecast()["mart_forecast"]),
        "plain_forecast_band": lambda i: rounded(marts.forecast_band(i.plain_forecast()["mart_forecast"], HEATMAP_FLEET), BAND),
        "plain_anomalies": lambda i: rounded(i.plain_anomalies()["mart"], ["anomaly_score"]),
        "plain_anomaly_summary": lambda i: i.plain_anomalies()["summary"],
        "plain_anomaly_rules": lambda i: i.plain_anomalies()["rules"],
        "plain_anomaly_scatter": lambda i: rounded(bi.anomaly_scatter(i.plain_anomalies()["mart"]), ["anomaly_score"]),
        "plain_top_anomalies": lambda i: rounded(anomaly.top_anomalies(i.plain_anomalies()["mart"], TOP_ANOMALIES), ["anomaly_score"]),
    }
    return {k: _registered(v) for k, v in q.items()}

"""Stage jobs (E1) and the full run.

Each stage reads its inputs from tables written by earlier stages and writes
its outputs as tables under ``Paths.root`` (a shared folder on a cluster), so
a stage can be rerun on its own and lineage is cut at every hand-over.  The
staged trips are partitioned and replaced landed month by landed month; all
other tables are replaced as a whole by a new version (``sinks.replace_table``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ridemart.operators import anomaly, dims, forecast, marts, quality, series, staging
from ridemart.settings import Settings
from ridemart.sources import landing, sinks

@dataclass(frozen=True)
class Paths:
    root: str
    landing_dir: str | None = None     # raw fleet-month files; default root/landing
    zone_lookup_csv: str | None = None  # default root/reference/taxi_zone_lookup.csv
    zone_centroids: str | None = None   # optional parquet (location_id, lat, lng)

    def _p(self, *parts: str) -> str:
        return "/".join([self.root.rstrip("/"), *parts])

    @property
    def landing(self) -> str:
        return self.landing_dir or self._p("landing")

    @property
    def lookup_csv(self) -> str:
        return self.zone_lookup_csv or self._p("reference", "taxi_zone_lookup.csv")

    @property
    def staged(self) -> str:
        return self._p("staged", "trips")

    @property
    def landing_manifest(self) -> str:
        return self._p("landing_manifest")

    @property
    def quality_report(self) -> str:
        return self._p("reports", "trips_quality")

    def table(self, name: str) -> str:
        return self._p("warehouse", name)

    @property
    def exports(self) -> str:
        return self._p("exports", "bi")


WAREHOUSE_TABLES = ["dim_date", "dim_fleet", "dim_time", "dim_zone", "fact_trip",
                    "mart_zone_demand", "mart_hourly_volume", "mart_daily_volume", "mart_route_flows"]
FORECAST_TABLES = ["mart_forecast", "mart_forecast_metrics", "mart_forecast_backtest"]
ANOMALY_TABLES = ["mart_trip_anomalies", "mart_anomaly_summary"]


def register_tables(spark: SparkSession, paths: Paths) -> list[str]:
    """S13 as SQL names: every written warehouse table is a table of the catalog.

    After a run, or in a new session after this call,
    ``spark.sql("SELECT ... FROM mart_zone_demand")`` works the way queries
    against the tables of a warehouse database do.
    """
    names = [n for n in WAREHOUSE_TABLES + FORECAST_TABLES + ANOMALY_TABLES if sinks.table_exists(spark, paths.table(n))]
    for n in names:
        sinks.register_table(spark, n, paths.table(n))
    return names


def _table(spark: SparkSession, paths: Paths, name: str) -> DataFrame:
    return sinks.read_table(spark, paths.table(name))


def run_zone_dim(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """D4 + S5/S6/S12: zone lookup CSV (+ optional centroids) -> dim_zone table."""
    lookup = dims.read_zone_lookup_csv(spark, paths.lookup_csv)
    cents = spark.read.parquet(paths.zone_centroids) if paths.zone_centroids else None
    sinks.replace_table(dims.dim_zone(lookup, cents), paths.table("dim_zone"))
    return {"zones": _table(spark, paths, "dim_zone").count()}


STAGED_PARTITIONS = ["fleet", "landed_month", "pickup_month"]


def run_staging(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """E1 + S1-S3, S11, S19, U1, D6, A8: landed raw files -> staged trips.

    The staged table is partitioned by fleet, landed month and pickup month;
    only the landed months of this run are replaced, so a month can be staged
    again or added without touching the others.  The raw files' data is
    scanned once: raw rows are counted by the footers, kept rows by the write
    itself (which has no shuffle, so every row is counted once).
    """
    files = landing.discover_landing(spark, paths.landing, settings)
    parts = [r.asDict() for r in landing.landed_parts(spark, files).collect()]
    landed = landing.manifest_rows(files, parts)
    sinks.write_report(spark, {"files": landed}, paths.landing_manifest)
    cap = settings.ingest.sample_rows
    raw = landing.read_files(spark, files, cap, with_month=True, parts=parts)
    kept = Observation("kept trips")
    staged = staging.clean_trips(raw, settings, ["landed_month"]).observe(kept, F.count(F.lit(1)).alias("rows"))
    staged = staged.withColumn("pickup_month", F.date_format("pickup_datetime", "yyyy-MM"))
    # Sorting each task's rows by partition and pickup time (a local sort, no shuffle)
    # satisfies the partitioned writer's ordering and makes parquet row-group min/max
    # statistics prune time-window reads later.
    staged = staged.sortWithinPartitions(*STAGED_PARTITIONS, "pickup_datetime")
    sinks.replace_partitions(staged, paths.staged, STAGED_PARTITIONS[:2], STAGED_PARTITIONS[2:],
                             [{"fleet": f["fleet"], "landed_month": f["month"]} for f in files])
    rows_raw = sum(min(f["rows"], cap) if cap else f["rows"] for f in landed)
    return {**staging.removal_counts(rows_raw, kept.get["rows"]), "path": paths.staged}


def staged_trips(spark: SparkSession, paths: Paths, settings: Settings) -> DataFrame:
    """The staged table's months of the window, registered as the ``stg_trips`` view."""
    w = settings.window
    df = spark.read.parquet(paths.staged)
    month = F.substring(F.col("pickup_month").cast("string"), 1, 7)
    df = df.where((month >= w.start[:7]) & (month <= w.end[:7])).select(*staging.STAGED_COLUMNS)
    df.createOrReplaceTempView("stg_trips")
    return df


def run_quality(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """E1 + Q1-Q10, S20: metrics and contract over the staged table; report written as JSON.

    A failing contract is reported, never raised (K25).
    """
    df = staged_trips(spark, paths, settings)
    checked = df
    if settings.quality.sample_rows:
        from ridemart.operators.sampling import sample_rows
        checked = sample_rows(df, settings.quality.sample_rows, 7)
    metrics = quality.quality_metrics(df).first().asDict()
    failures = quality.contract_failures(checked, settings)
    contract = quality.contract_report(failures)
    contract["rows_checked"] = metrics["row_count"] if checked is df else checked.count()
    report = {"status": "pass" if contract["passed"] else "fail", "metrics": metrics,
              "contract": contract}
    sinks.write_report(spark, report, paths.quality_report)
    return report


def run_warehouse(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """E1 + D1-D5, M1-M4, S7, S13, S15: dimensions, fact and marts as tables.

    The marts read the written fact table, so its lineage (and the id
    checkpoint) is not recomputed.
    """
    staged = staged_trips(spark, paths, settings)
    def put(name: str, df: DataFrame) -> None:
        sinks.replace_table(df, paths.table(name))

    put("dim_date", dims.dim_date(spark, settings))
    put("dim_fleet", dims.dim_fleet(spark))
    put("dim_time", dims.dim_time(spark))
    if not sinks.table_exists(spark, paths.table("dim_zone")):
        run_zone_dim(spark, settings, paths)
    put("fact_trip", dims.fact_trip(staged, settings))
    fact, dim_zone, dim_date = (_table(spark, paths, n) for n in ("fact_trip", "dim_zone", "dim_date"))
    put("mart_zone_demand", marts.mart_zone_demand(fact, dim_zone, ordered=False))
    put("mart_hourly_volume", marts.mart_hourly_volume(fact, dim_date, settings, ordered=False))
    put("mart_daily_volume", marts.mart_daily_volume(fact, dim_date, settings, ordered=False))
    put("mart_route_flows", marts.mart_route_flows(fact, dim_zone))
    register_tables(spark, paths)
    return {"tables": {r["table"]: r["rows"] for r in sinks.catalog_counts(spark, WAREHOUSE_TABLES).collect()}}


def run_forecast(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """E1 + T1-T13: hourly series from the staged table -> forecast tables."""
    s = series.hourly_series(staged_trips(spark, paths, settings), settings)
    out = forecast.forecast(s, settings, paths.table("forecast_predictions"))
    for name in FORECAST_TABLES:
        sinks.replace_table(out[name], paths.table(name))
    register_tables(spark, paths)
    best = forecast.best_model(_table(spark, paths, "mart_forecast_metrics")).collect()
    return {"forecasts": _table(spark, paths, "mart_forecast").count(), "best": {r["fleet"]: r["model"] for r in best}}


def run_anomaly(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """E1 + N1-N14: score the fact table, write the scores, the flagged-trip mart and the rule summary."""
    out = anomaly.detect(_table(spark, paths, "fact_trip"), settings, paths.table("trip_scores"))
    sinks.replace_table(out["mart"], paths.table("mart_trip_anomalies"))
    sinks.replace_table(out["rules"], paths.table("mart_anomaly_summary"))
    summary = out["summary"].first().asDict()
    summary["by_rule"] = {r["rule"]: r["count"] for r in _table(spark, paths, "mart_anomaly_summary").collect()}
    register_tables(spark, paths)
    return summary


def run_export(spark: SparkSession, settings: Settings, paths: Paths) -> dict:
    """E1 + S15-S18: every warehouse table of the catalog to parquet (+ CSV as listed) with a manifest."""
    names = register_tables(spark, paths)
    manifest = sinks.export_tables(spark, {n: spark.table(n) for n in names}, paths.exports, settings.export.csv_tables)
    return {"tables": manifest.count(), "path": paths.exports}


#: What can be asked for by name, in the order in which each finds its inputs.
JOBS = {"zones": run_zone_dim, "stage": run_staging, "quality": run_quality, "warehouse": run_warehouse,
        "forecast": run_forecast, "anomaly": run_anomaly, "export": run_export}


def run_all(spark: SparkSession, settings: Settings, paths: Paths,
            stages: list[str] | None = None) -> dict:
    """The whole run, or the named stages of it; each one's result under its name."""
    unknown = set(stages or ()) - set(JOBS)
    if unknown:
        raise ValueError(f"unknown stages {sorted(unknown)}; known: {list(JOBS)}")
    return {name: job(spark, settings, paths) for name, job in JOBS.items() if not stages or name in stages}


def main(argv: list[str] | None = None) -> dict:
    """E2 as one ``spark-submit`` job.

    ``spark-submit ridemart/plans/jobs.py --root <shared folder> [--stages stage,quality]
    [--window-start 2022-01-01 --window-end 2022-03-01] [--months 2022-01,2022-02]``
    """
    import argparse
    import json

    from ridemart.session import get_spark

    ap = argparse.ArgumentParser(prog="ridemart-jobs")
    ap.add_argument("--root", required=True, help="shared folder holding landing/, reference/, staged/, ...")
    ap.add_argument("--landing", help="raw file folder (default <root>/landing)")
    ap.add_argument("--zone-lookup", help="zone lookup CSV (default <root>/reference/taxi_zone_lookup.csv)")
    ap.add_argument("--zone-centroids", help="optional centroid parquet (location_id, lat, lng)")
    ap.add_argument("--stages", help="comma-separated subset of " + ",".join(JOBS))
    ap.add_argument("--window-start")
    ap.add_argument("--window-end")
    ap.add_argument("--months", help="comma-separated yyyy-mm list")
    ap.add_argument("--fleets", help="comma-separated fleet list")
    ap.add_argument("--settings", help="JSON file with settings sections (see settings_from_dict)")
    a = ap.parse_args(argv)

    settings = Settings()
    if a.settings:
        from ridemart.settings import settings_from_dict
        with open(a.settings) as fh:
            settings = settings_from_dict(json.load(fh))
    window = {k: v for k, v in (("start", a.window_start), ("end", a.window_end)) if v}
    ingest = {}
    if a.months:
        ingest["months"] = tuple(a.months.split(","))
    if a.fleets:
        ingest["fleets"] = tuple(a.fleets.split(","))
    if window:
        settings = settings.replace(window=window)
    if ingest:
        settings = settings.replace(ingest=ingest)
    paths = Paths(a.root, a.landing, a.zone_lookup, a.zone_centroids)
    spark = get_spark()
    result = run_all(spark, settings, paths, a.stages.split(",") if a.stages else None)
    print(json.dumps(result, default=str))
    return result


if __name__ == "__main__":
    main()

"""Every registered query with an oracle equals its DuckDB SQL (sf0.001), plus the entry smoke check."""

import importlib.util
import os

import duckdb
import pytest

from support import SF001

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _load(name, path):
    spec = importlib.util.spec_from_file_location(name, path)
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


entry = _load("spark_entry", os.path.join(ROOT, "__spark_entry__.py"))
check = _load("check_oracle", os.path.join(ROOT, "tools", "check_oracle.py"))


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in check.TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


def test_entry(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert df.columns[:2] == ["location_id", "zone"]


def test_oracle_keys_are_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


SPARK_TO_DUCK = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "date": "DATE", "timestamp_ntz": "TIMESTAMP"}


@pytest.mark.parametrize("key", sorted(entry.oracle_sql()))
def test_query_equals_oracle(spark, con, key):
    sdf = entry.queries()[key](spark, SF001)
    rel = con.sql(entry.oracle_sql()[key])
    otypes = dict(zip(rel.columns, [str(t) for t in rel.types]))
    assert {c: SPARK_TO_DUCK.get(t, t) for c, t in sdf.dtypes} == otypes
    res = con.execute(entry.oracle_sql()[key])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    srows = [tuple(r) for r in sdf.collect()]
    assert sorted(sdf.columns) == sorted(ocols)
    assert len(srows) == len(orows)
    assert check.rows_of(sdf.columns, srows, False) == check.rows_of(ocols, orows, False)


MODEL_OUTPUTS = {"mart_forecast", "mart_forecast_metrics", "mart_forecast_backtest", "best_model",
                 "forecast_error", "forecast_band"}
PLAIN = {"plain_forecast", "plain_forecast_metrics", "plain_forecast_backtest", "plain_best_model", "plain_forecast_error",
         "plain_forecast_band", "plain_anomalies", "plain_anomaly_summary", "plain_anomaly_rules", "plain_anomaly_scatter",
         "plain_top_anomalies"}
REGISTERED = PLAIN | MODEL_OUTPUTS | {
    "mart_trip_anomalies", "anomaly_summary", "anomaly_scatter", "landed_sample", "landing_manifest", "staged_window",
    "export_manifest", "exported_daily", "catalog_counts",
    "landed_trips", "clean_trips", "clean_summary", "dim_zone", "fact_trip", "mart_zone_demand", "mart_hourly_volume",
    "mart_daily_volume", "mart_route_flows", "heatmap_grid", "daily_trend", "top_zones", "zone_map_points", "calendar_rollup",
    "quality_metrics", "duplicate_groups", "contract_failures", "contract_errors", "sampled_trips", "hourly_series",
    "design_matrix", "seasonal_naive", "naive_metrics", "naive_backtest", "anomaly_rules",
    "anomaly_rule_summary", "kpis", "week_over_week", "distance_bands", "net_flow",
}


def test_registered_queries_are_all_still_there():
    from ridemart.plans.catalog import spark_queries
    from ridemart.plans.oracle import oracle_queries

    assert set(spark_queries()) == REGISTERED <= set(entry.queries())
    assert set(oracle_queries()) == REGISTERED - MODEL_OUTPUTS <= set(entry.oracle_sql())
    assert set(entry.oracle_sql()) <= set(entry.queries())

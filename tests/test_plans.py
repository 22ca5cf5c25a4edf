"""Plan-shape guards for the registered queries (scale properties, not values)."""

import importlib.util
import os

import pytest

from support import SF001
from ridemart.plans import catalog
from ridemart.plans.catalog import spark_queries

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
spec = importlib.util.spec_from_file_location("spark_entry_plans", os.path.join(ROOT, "__spark_entry__.py"))
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

GROUPED = ["mart_zone_demand", "mart_hourly_volume", "mart_daily_volume", "mart_route_flows", "duplicate_groups",
           "net_flow", "hourly_series", "distance_bands"]


def _plan(spark, key):
    df = entry.queries()[key](spark, SF001)
    df.collect()  # final adaptive plan
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(autouse=True)
def short_fits(monkeypatch):
    """Plans do not depend on how many trees a model has."""
    few = catalog.fixture_settings().replace(forecast={"max_iter": 2, "folds": 1}, anomaly={"trees": 20})
    monkeypatch.setattr(catalog, "fixture_settings", lambda: few)


@pytest.mark.parametrize("key", sorted(spark_queries()))
def test_no_cartesian_or_nested_loop_join(spark, key):
    plan = _plan(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("key", GROUPED)
def test_group_bys_combine_map_side(spark, key):
    # A hot key becomes one row per map task before the shuffle.
    assert "partial_" in _plan(spark, key)


def test_fact_ids_need_no_range_sort_by_default(spark, inputs001, settings):
    from ridemart.operators import dims

    plan = dims.fact_trip(inputs001.clean(), settings)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning" not in plan and "Scan ExistingRDD" not in plan


def test_trees_are_drawn_in_the_scan(spark, inputs001, monkeypatch):
    from ridemart.operators import iforest

    rows = inputs001.rule_input()
    seen = []
    monkeypatch.setattr(type(rows), "toPandas", lambda df: seen.append(df._jdf.queryExecution().executedPlan().toString()) or (_ for _ in ()).throw(StopIteration))
    with pytest.raises(StopIteration):
        iforest.fit_forest(rows, ["trip_distance"], trees=8, max_samples=16, key_cols=["fleet", "trip_distance", "fare_amount"])
    assert "TakeOrdered" not in seen[0] and "SinglePartition" not in seen[0] and "hashpartitioning(tree_id" in seen[0]


def test_overwritten_input_is_read_again(spark, tmp_path):
    from ridemart.sources import fixtures

    spark.read.parquet(f"{SF001}/events.parquet").limit(10).write.parquet(f"{tmp_path}/events.parquet")
    assert catalog.Inputs(spark, str(tmp_path)).raw().count() == 10
    fixtures.table(spark, SF001, "events").limit(25).write.mode("overwrite").parquet(f"{tmp_path}/events.parquet")
    assert catalog.Inputs(spark, str(tmp_path)).raw().count() == 25


def test_window_predicate_reaches_the_scan(spark):
    plan = _plan(spark, "clean_trips")
    assert "PushedFilters: [IsNotNull(ts)" in plan and "GreaterThanOrEqual(ts" in plan


def test_tables_of_another_application_are_not_read(spark, inputs001, monkeypatch):
    built = []

    def build(folder):
        built.append(folder)
        return {"probe": spark.range(1)}

    for app in ("probe-1", "probe-2", "probe-2"):
        monkeypatch.setattr(type(spark.sparkContext), "applicationId", app)
        assert inputs001._handed_over("probe", ["probe"], build)["probe"].count() == 1
    assert len(built) == len(set(built)) == 2

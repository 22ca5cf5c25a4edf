"""Stage jobs end to end on landed fixture files."""

import os

from ridemart.plans import jobs
from ridemart.plans.catalog import Inputs

from support import shown_settings as fixture_settings
from ridemart.sources import fixtures, sinks

from support import SF001


def test_run_all(spark, scratch):
    root = scratch + "/run"
    fixtures.write_landing(spark, SF001, root + "/landing", "2024-01")
    fixtures.write_zone_lookup_csv(spark, SF001, root + "/reference/taxi_zone_lookup.csv")
    settings = fixture_settings().replace(
        ingest={"months": ("2024-01",)}, forecast={"max_iter": 5, "folds": 1},
        anomaly={"trees": 20}, export={"csv_tables": ("dim_time",)})
    paths = jobs.Paths(root)
    res = jobs.run_all(spark, settings, paths)

    assert res["zones"]["zones"] == 25
    assert res["stage"]["rows_raw"] == 1000 and res["stage"]["rows_clean"] == 672
    assert res["quality"]["status"] == "pass"
    assert sinks.read_report(spark, paths.quality_report)["metrics"]["row_count"] == 672
    t = res["warehouse"]["tables"]
    assert t["fact_trip"] == 672 and t["dim_date"] == 29 and t["dim_time"] == 24
    # Same mart from the tables as from the registered query (lookup CSV has no
    # centroids here, so compare counts and pickups only).
    q = Inputs(spark, SF001, fixture_settings()).zone_demand()
    got = {r.location_id: r.pickups for r in sinks.read_table(spark, paths.table("mart_zone_demand")).collect()}
    assert got == {r.location_id: r.pickups for r in q.collect()}
    assert res["anomaly"]["sampled"] == 672
    assert res["anomaly"]["by_rule"]["zero_distance"] == 21
    assert set(res["forecast"]["best"]) <= {"yellow", "green"}
    manifest = {r.table: r for r in spark.read.json(paths.exports + "/manifest.json").collect()}
    assert manifest["fact_trip"].formats == ["parquet"]          # not among the CSV tables
    assert manifest["dim_time"].formats == ["parquet", "csv"]
    assert os.path.isdir(paths.exports + "/dim_time.csv")
    # Every table is queryable by name after the run.
    assert spark.sql("SELECT count(*) FROM fact_trip").first()[0] == 672
    assert spark.sql("SELECT sum(pickups) FROM mart_zone_demand").first()[0] > 0
    landed = sinks.read_report(spark, paths.landing_manifest)
    assert sorted(f["fleet"] for f in landed["files"]) == ["green", "yellow"]


def test_main_runs_selected_stages(spark, scratch):
    root = scratch + "/cli"
    fixtures.write_landing(spark, SF001, root + "/landing", "2024-01")
    res = jobs.main(["--root", root, "--stages", "stage,quality", "--months", "2024-01",
                     "--window-start", "2024-01-01", "--window-end", "2024-01-30"])
    assert set(res) == {"stage", "quality"}
    assert res["stage"]["rows_clean"] == 672 and res["quality"]["status"] == "pass"


def test_scan_order_ids_through_the_settings_file(spark, scratch):
    import json

    root = scratch + "/scan"
    fixtures.write_landing(spark, SF001, root + "/landing", "2024-01")
    fixtures.write_zone_lookup_csv(spark, SF001, root + "/reference/taxi_zone_lookup.csv")
    with open(scratch + "/s.json", "w") as fh:
        json.dump({"window": {"start": "2024-01-01", "end": "2024-01-30"}, "ingest": {"months": ["2024-01"]},
                   "fact_ids": "scan"}, fh)
    res = jobs.main(["--root", root, "--settings", scratch + "/s.json", "--stages", "zones,stage,warehouse"])
    assert res["warehouse"]["tables"]["fact_trip"] == 672
    ids = sorted(r.trip_id for r in sinks.read_table(spark, jobs.Paths(root).table("fact_trip")).select("trip_id").collect())
    assert ids == list(range(1, 673))


def test_quality_stage_with_a_contract_sample(spark, scratch):
    root = scratch + "/q"
    fixtures.write_landing(spark, SF001, root + "/landing", "2024-01")
    s = fixture_settings().replace(ingest={"months": ("2024-01",)}, quality={"sample_rows": 100})
    paths = jobs.Paths(root)
    jobs.run_staging(spark, s, paths)
    report = jobs.run_quality(spark, s, paths)
    assert report["contract"]["rows_checked"] == 100 and report["metrics"]["row_count"] == 672
    assert report["status"] == "pass"


def test_unknown_stage_is_an_error(spark, scratch):
    import pytest

    with pytest.raises(ValueError, match="unknown stages"):
        jobs.run_all(spark, fixture_settings(), jobs.Paths(scratch), ["stage", "staging"])


def _files(folder):
    return {os.path.join(d, f) for d, _, names in os.walk(folder) for f in names if f.endswith(".parquet")}


def test_staging_one_month_again_rewrites_only_its_folders(spark, scratch):
    root = scratch + "/inc"
    fixtures.write_drifted_landing(spark, SF001, root + "/landing")
    s = fixture_settings().replace(ingest={"months": ("2024-01", "2024-02")})
    paths = jobs.Paths(root)
    first = jobs.run_staging(spark, s, paths)
    before = _files(paths.staged)
    again = jobs.run_staging(spark, s.replace(ingest={"months": ("2024-02",)}), paths)
    after = _files(paths.staged)
    assert first["rows_raw"] == 1000 and first["rows_clean"] == 672
    assert {f for f in before if "landed_month=2024-01" in f} == {f for f in after if "landed_month=2024-01" in f}
    assert not {f for f in before if "landed_month=2024-02" in f} & after
    assert again["rows_raw"] < 1000 and jobs.staged_trips(spark, paths, s).count() == 672
    # A stricter rule that leaves a pickup month without rows removes its folder as well.
    none = s.replace(ingest={"months": ("2024-02",)}, cleaning={"max_fare": -1.0})
    assert jobs.run_staging(spark, none, paths)["rows_clean"] == 0
    assert not {f for f in _files(paths.staged) if "landed_month=2024-02" in f}
    assert jobs.staged_trips(spark, paths, s).count() == 672 - again["rows_clean"]


def test_window_read_prunes_partitions(spark, scratch):
    root = scratch + "/prune"
    fixtures.write_drifted_landing(spark, SF001, root + "/landing")
    s = fixture_settings().replace(ingest={"months": ("2024-01", "2024-02")})
    paths = jobs.Paths(root)
    jobs.run_staging(spark, s, paths)
    plan = jobs.staged_trips(spark, paths, s)._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "pickup_month" in plan.split("PartitionFilters: [")[1].split("]")[0]


def test_staging_scans_the_raw_data_once(spark, scratch, monkeypatch):
    from ridemart.sources import landing

    root = scratch + "/once"
    fixtures.write_drifted_landing(spark, SF001, root + "/landing")
    s = fixture_settings().replace(ingest={"months": ("2024-01", "2024-02")})
    frames = []
    read = landing.read_files
    monkeypatch.setattr(landing, "read_files", lambda *a, **k: frames.append(read(*a, **k)) or frames[-1])
    res = jobs.run_staging(spark, s, jobs.Paths(root))
    assert len(frames) == 1 and res["rows_raw"] == frames[0].count() == 1000
    # Raw rows come from the footers: the counting scan reads no column of the files.
    files = landing.discover_landing(spark, root + "/landing", s)
    plan = landing.landed_parts(spark, files)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1 and "ReadSchema: struct<>" in plan
    # One scan per fleet and type combination, however many files.
    assert frames[0]._jdf.queryExecution().executedPlan().toString().count("FileScan") == 4


def test_tables_by_name_in_a_new_session(spark, scratch):
    root = scratch + "/names"
    paths = jobs.Paths(root)
    sinks.replace_table(spark.range(3), paths.table("dim_time"))
    sinks.replace_table(spark.range(5), paths.table("dim_time"))
    other = spark.newSession()
    assert jobs.register_tables(other, paths) == ["dim_time"]
    assert other.sql("SELECT count(*) FROM dim_time").first()[0] == 5
    assert [tuple(r) for r in sinks.catalog_counts(other, ["dim_time"]).collect()] == [("dim_time", 5)]

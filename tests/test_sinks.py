"""Sinks S13, S15-S18, S20 on small tables in a scratch folder."""

import os

from ridemart.sources import sinks


def test_counts_export_and_manifest(spark, scratch):
    small = spark.range(5).selectExpr("id", "id * 2 AS v")
    big = spark.range(50).selectExpr("id")
    paths = {"small": sinks.write_table(small, scratch + "/wh/small"),
             "big": sinks.write_table(big, scratch + "/wh/big")}
    counts = {r.table: r.rows for r in sinks.table_counts(spark, paths).collect()}
    assert counts == {"small": 5, "big": 50}
    manifest = {r.table: r for r in sinks.export_tables(spark, paths, scratch + "/bi", csv_tables=("small",)).collect()}
    assert manifest["small"].formats == ["parquet", "csv"] and manifest["big"].formats == ["parquet"]
    assert manifest["small"].columns == ["id", "v"] and manifest["big"].rows == 50
    assert os.path.isdir(scratch + "/bi/small.csv") and not os.path.exists(scratch + "/bi/big.csv")
    header = spark.read.option("header", True).csv(scratch + "/bi/small.csv")
    assert header.columns == ["id", "v"] and header.count() == 5
    assert spark.read.json(scratch + "/bi/manifest.json").count() == 2


def test_report_round_trip(spark, scratch):
    report = {"status": "pass", "metrics": {"row_count": 3}, "errors": []}
    sinks.write_report(spark, report, scratch + "/report")
    assert sinks.read_report(spark, scratch + "/report") == report


def test_partitioned_table(spark, scratch):
    df = spark.createDataFrame([("yellow", 1), ("green", 2), ("yellow", 3)], "fleet string, x int")
    sinks.write_table(df, scratch + "/p", ["fleet"])
    assert {d for d in os.listdir(scratch + "/p") if d.startswith("fleet=")} == {"fleet=green", "fleet=yellow"}
    back = spark.read.parquet(scratch + "/p").where("fleet = 'yellow'")
    assert back.count() == 2


def test_failed_rewrite_leaves_the_old_table(spark, scratch):
    import pytest
    from pyspark.sql import functions as F

    path = scratch + "/t"
    with pytest.raises(FileNotFoundError):
        sinks.read_table(spark, path)
    sinks.replace_table(spark.range(4), path)
    broken = spark.range(100).repartition(4).withColumn("id", F.when(F.col("id") == 57, F.raise_error("lost")).otherwise(F.col("id")))
    with pytest.raises(Exception, match="lost"):
        sinks.replace_table(broken, path)
    assert sinks.read_table(spark, path).count() == 4 and len(sinks.versions(spark, path)) == 1
    sinks.replace_table(sinks.read_table(spark, path).selectExpr("id + 1 AS id"), path)  # from itself
    assert sorted(r.id for r in sinks.read_table(spark, path).collect()) == [1, 2, 3, 4]
    open_before = sinks.read_table(spark, path)
    sinks.replace_table(spark.range(9), path)
    assert open_before.count() == 4 and sinks.read_table(spark, path).count() == 9
    for _ in range(3):
        sinks.replace_table(spark.range(2), path)
    assert len(sinks.versions(spark, path)) == 2


def test_registered_table_follows_its_versions(spark, scratch):
    path = scratch + "/r"
    sinks.replace_table(spark.range(4), path)
    sinks.register_table(spark, "kept_rows", path)
    sinks.replace_table(spark.range(7), path)
    sinks.register_table(spark, "kept_rows", path)
    assert spark.sql("SELECT count(*) FROM kept_rows").first()[0] == 7
    sinks.replace_table(spark.range(2).selectExpr("id", "'x' AS label"), path)
    sinks.register_table(spark, "kept_rows", path)
    assert spark.table("kept_rows").columns == ["id", "label"]
    spark.sql("DROP TABLE kept_rows")
    assert sinks.read_table(spark, path).count() == 2


def test_manifest_and_extract_read_back(spark, scratch):
    import datetime as dt

    rows = [(1, "a,b\"c", 1.5, dt.date(2024, 1, 2), True), (2, None, None, None, None), (3, " é\n", -0.25, dt.date(2024, 2, 29), False)]
    df = spark.createDataFrame(rows, "id long, name string, x double, d date, flag boolean")
    sinks.export_tables(spark, {"t": df}, scratch + "/bi", ("t",))
    assert [tuple(r) for r in sinks.read_manifest(spark, scratch + "/bi").collect()] == [("t", 3, ["id", "name", "x", "d", "flag"], ["parquet", "csv"])]
    for fmt in ("csv", "parquet"):
        back = sorted(tuple(r) for r in sinks.read_extract(spark, scratch + "/bi", "t", df.schema, fmt).collect())
        assert back == rows, fmt


def test_report_is_a_struct_to_readers(spark, scratch):
    sinks.write_report(spark, {"status": "pass", "metrics": {"row_count": 3}}, scratch + "/report")
    row = spark.read.json(scratch + "/report").first()
    assert row.status == "pass" and row.metrics.row_count == 3

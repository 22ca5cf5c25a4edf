"""Benchmark the headline queries.

Runs each query of ``HEADLINE`` on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` (default 8): one cold run,
then ``$BENCH_RUNS`` (default 3) warm runs; the warm median is reported.
Each run executes the whole plan into the ``noop`` sink (no driver
collection).  The model stages (all forecast fits, the isolation forest) are
run once, fresh, and are part of the sum (``BENCH_MODELS=0`` leaves them out).
``machine_seconds`` is a fixed JVM loop outside the sum, by which runs on
different hosts can be compared.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "mart_zone_demand",      # M1
    "mart_hourly_volume",    # M2
    "mart_daily_volume",     # M3
    "mart_route_flows",      # M4
    "contract_failures",     # Q9
    "quality_metrics",       # Q10
    "hourly_series",         # T1
    "clean_trips",           # D6
    "fact_trip",             # D5 + W1
    "naive_backtest",        # T9 baseline
    "anomaly_rule_summary",  # N14
    "net_flow",              # B7
]


def model_timings(spark, sf_dir: str) -> dict:
    """One fresh run each of the forecast (all fits at full size) and the anomaly forest."""
    import uuid

    from ridemart.operators import anomaly, forecast
    from ridemart.plans.catalog import Inputs
    from ridemart.session import ensure_checkpoint_dir

    out = {}
    i = Inputs(spark, sf_dir)
    t0 = time.perf_counter()
    fc = forecast.forecast(i.series(), i.settings, f"{ensure_checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}")
    for name in ("mart_forecast", "mart_forecast_metrics", "mart_forecast_backtest"):
        fc[name].write.format("noop").mode("overwrite").save()
    out["forecast_all_fits"] = round(time.perf_counter() - t0, 3)
    t0 = time.perf_counter()
    res = anomaly.detect(i.fact_with_ids(), i.settings, f"{ensure_checkpoint_dir(spark)}/bench-{uuid.uuid4().hex}")
    res["mart"].write.format("noop").mode("overwrite").save()
    res["summary"].write.format("noop").mode("overwrite").save()
    out["anomaly_forest"] = round(time.perf_counter() - t0, 3)
    return out


def machine_seconds(spark) -> float:
    """Best of three: the same arithmetic over the same numbers, on all cores."""
    loop = spark.range(400_000_000).selectExpr("sum((id * 31 + 7) % 1009 * (id % 13)) AS s")
    times = []
    for _ in range(3):
        t0 = time.perf_counter()
        loop.collect()
        times.append(time.perf_counter() - t0)
    return round(min(times), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    from ridemart.session import ensure_checkpoint_dir, get_spark
    from ridemart.plans.catalog import spark_queries

    spark = get_spark(f"local[{cpus}]", app_name="ridemart-bench", shuffle_partitions=cpus,
                      extra={"spark.driver.memory": "8g"})
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    machine = machine_seconds(spark)
    qs = spark_queries()
    timings: dict[str, float] = {}
    for name in HEADLINE:
        samples = []
        for i in range(runs + 1):
            t0 = time.perf_counter()
            qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            dt = time.perf_counter() - t0
            if i > 0:
                samples.append(dt)
        timings[name] = round(statistics.median(samples), 3)
    if os.environ.get("BENCH_MODELS", "1") == "1":
        timings.update(model_timings(spark, sf_dir))
    m = re.search(r"sf([0-9.]+)", sf_dir)
    out = {
        "metric": "sum_of_warm_median_query_seconds",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(m.group(1)) if m else None,
        "cpus": cpus,
        "runs": runs,
        "machine_seconds": machine,
        "spark": {"version": spark.version,
                  "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
                  "aqe": spark.conf.get("spark.sql.adaptive.enabled")},
    }
    spark.stop()
    print(json.dumps(out))


if __name__ == "__main__":
    main()

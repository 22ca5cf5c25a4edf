"""Python tasks must not need this package on the workers' path."""

import os
import subprocess
import sys
import textwrap

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_forest_runs_when_workers_cannot_import_the_package(tmp_path):
    script = textwrap.dedent(f"""
        import sys
        sys.path.insert(0, {ROOT!r})
        import __spark_entry__ as e
        from pyspark.sql import SparkSession
        spark = (SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false")
                 .config("spark.sql.shuffle.partitions", "4").getOrCreate())
        spark.sparkContext.setLogLevel("ERROR")
        n = e.queries()["anomaly_summary"](spark, "/root/testdata/sf0.001").first().sampled
        print("SAMPLED", n)
    """)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    out = subprocess.run([sys.executable, "-c", script], cwd=tmp_path, env=env, capture_output=True,
                         text=True, timeout=600)
    assert "SAMPLED 701" in out.stdout, out.stderr[-2000:]


def test_module_entry_prints_help(tmp_path):
    env = dict(os.environ, PYTHONPATH=ROOT)
    out = subprocess.run([sys.executable, "-m", "ridemart", "--help"], cwd=tmp_path, env=env,
                         capture_output=True, text=True, timeout=120)
    assert out.returncode == 0 and "--root" in out.stdout and "--stages" in out.stdout

"""Property checks of the generic operators on random inputs (few examples each: Spark jobs are slow)."""

import duckdb
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from ridemart import functions as X
from ridemart.operators import dims
from ridemart.operators.sampling import sample_rows, top_k

SLOW = settings(max_examples=8, deadline=None, derandomize=True, suppress_health_check=list(HealthCheck))

finite = st.floats(min_value=-1e6, max_value=1e6, allow_nan=False, allow_infinity=False)


@SLOW
@given(st.lists(finite, min_size=1, max_size=40))
def test_round2_equals_duckdb_round(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in df.select(X.round2("x")).collect()]
    con = duckdb.connect()
    want = [con.execute("SELECT round(CAST(? AS DOUBLE), 2)", [v]).fetchall()[0][0] for v in values]
    assert got == want


@SLOW
@given(st.lists(st.tuples(st.integers(0, 50), st.integers(0, 10 ** 6)), min_size=1, max_size=300, unique_by=lambda t: t[1]),
       st.integers(1, 40), st.integers(1, 6))
def test_top_k_equals_full_sort(spark, rows, k, parts):
    df = spark.createDataFrame(rows, "s long, id long").withColumn("s", F.col("s").cast("double")).repartition(parts)
    want = sorted(rows, key=lambda r: (-r[0], r[1]))[:k]
    got = [(int(r.s), r.id) for r in top_k(df, k, "s", ["id"]).collect()]
    assert got == want


@SLOW
@given(st.integers(1, 400), st.integers(1, 500), st.integers(0, 3))
def test_sample_is_exact_and_seeded(spark, n_rows, n, seed):
    df = spark.range(n_rows).select(F.col("id"), (F.col("id") * 13 % 7).alias("g"))
    a = [r.id for r in sample_rows(df, n, seed).collect()]
    b = [r.id for r in sample_rows(df.repartition(3), n, seed).collect()]
    assert len(a) == min(n, n_rows) and len(set(a)) == len(a)
    assert sorted(a) == sorted(b)


@SLOW
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 5))), min_size=1, max_size=200),
       st.integers(1, 5))
def test_dense_ids_follow_the_sort_order(spark, rows, parts):
    df = spark.createDataFrame(rows, "a int, b int")
    out = dims.with_dense_ids(df, ["a", "b"], "rid", partitions=parts).collect()
    assert sorted(r.rid for r in out) == list(range(1, len(rows) + 1))
    by_id = [(r.a, -1 if r.b is None else r.b) for r in sorted(out, key=lambda r: r.rid)]
    assert by_id == sorted(by_id)  # NULLS FIRST order

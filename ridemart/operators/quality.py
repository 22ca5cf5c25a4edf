"""Data contract and full-table quality metrics.

The whole table is checked in one aggregation pass (every check is a
conditional count), plus one grouped count for duplicate keys; no sample
and no per-column scans are needed.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridemart.constants import LOCATION_ID_RANGE
from ridemart.functions import round4
from ridemart.settings import Settings

NULL_RATE_COLUMNS = [
    "passenger_count", "pickup_location_id", "dropoff_location_id", "trip_distance",
    "fare_amount", "tip_amount", "total_amount", "trip_duration_min", "avg_speed_mph",
]
RANGE_COLUMNS = [
    "trip_distance", "fare_amount", "tip_amount", "total_amount",
    "trip_duration_min", "avg_speed_mph",
]
DUPLICATE_KEY = ["fleet", "pickup_datetime", "pickup_location_id", "dropoff_location_id",
                 "fare_amount"]


def quality_metrics(staged: DataFrame) -> DataFrame:
    """Q10 (A9-A13): one row of full-table metrics.

    Row count, NULL rate per column (4 decimals, 0 for an empty table),
    min/max per measure (NULL for an empty table, K27), pickup date range and
    the number of duplicate key groups (scalar subquery over one grouped
    count).
    """
    # SQL text: one JVM parse per expression instead of a call per Column op.
    aggs = ["count(1) AS row_count"]
    aggs += [f"count_if(`{c}` IS NULL) AS _n_{c}" for c in NULL_RATE_COLUMNS]
    aggs += [f"CAST({f}(`{c}`) AS DOUBLE) AS {f}_{c}" for c in RANGE_COLUMNS for f in ("min", "max")]
    aggs += ["min(pickup_date) AS date_min", "max(pickup_date) AS date_max"]
    m = staged.agg(*[F.expr(a) for a in aggs])
    rates = [F.when(F.col("row_count") > 0, round4(F.col(f"_n_{c}") / F.col("row_count")))
              .otherwise(F.lit(0.0)).alias(f"null_rate_{c}") for c in NULL_RATE_COLUMNS]
    out = m.select("row_count", "date_min", "date_max", *rates,
                   *[f"{p}_{c}" for c in RANGE_COLUMNS for p in ("min", "max")])
    return out.withColumn("duplicate_groups", duplicate_groups(staged).agg(
        F.count(F.lit(1))).scalar())


def duplicate_groups(staged: DataFrame, key: list[str] | None = None) -> DataFrame:
    """Key groups seen more than once, with their size."""
    return (staged.groupBy(*(key or DUPLICATE_KEY)).agg(F.count(F.lit(1)).alias("n"))
            .where(F.col("n") > 1))


# ---- contract (Q1-Q9) ------------------------------------------------------------

@dataclass(frozen=True)
class ColumnRule:
    column: str
    dtype: str            # Spark type the value must coerce to
    nullable: bool
    check: str | None     # check label, None when only type/NULL are checked
    sql: str | None = None    # the passing condition as SQL over ``{v}`` (Spark and the oracle)


def _fmt(x) -> str:
    return repr(x)


def contract_rules(settings: Settings) -> list[ColumnRule]:
    """Q1-Q7: the 12-column trip contract."""
    c = settings.cleaning
    fleets = tuple(settings.ingest.fleets)
    lo, hi = LOCATION_ID_RANGE

    def rng(column, dtype, a, b):
        return ColumnRule(column, dtype, False, f"in_range({_fmt(a)},{_fmt(b)})",
                          f"{{v}} BETWEEN {_fmt(a)} AND {_fmt(b)}")

    def ge0(column):
        return ColumnRule(column, "double", True, "ge(0)", "{v} >= 0")

    fleet_sql = ", ".join(f"'{f}'" for f in fleets)
    return [
        ColumnRule("fleet", "string", False, f"isin({','.join(fleets)})", f"{{v}} IN ({fleet_sql})"),
        ColumnRule("pickup_datetime", "timestamp_ntz", False, None),
        ColumnRule("dropoff_datetime", "timestamp_ntz", False, None),
        rng("pickup_location_id", "int", lo, hi),
        rng("dropoff_location_id", "int", lo, hi),
        ge0("passenger_count"),
        rng("trip_distance", "double", c.min_distance, c.max_distance),
        rng("fare_amount", "double", c.min_fare, c.max_fare),
        rng("trip_duration_min", "double", c.min_duration_min, c.max_duration_min),
        ge0("avg_speed_mph"),
        rng("pickup_hour", "long", 0, 23),
        rng("pickup_weekday", "long", 0, 6),
    ]


def contract_failures(staged: DataFrame, settings: Settings) -> DataFrame:
    """Q9: failure count of every check, all from one aggregation pass.

    Rows ``(column_name, check_name, failures)``, one per check, including
    zero counts.  A value that does not coerce to the column type is a
    ``coerce(type)`` failure (Q8); a NULL in a required column is a
    ``not_nullable`` failure; value checks see only coerced non-NULL values.
    A missing column is one ``column_present`` failure.  Extra columns are
    ignored.
    """
    present = set(staged.columns)
    counters: list[tuple[str, str, str]] = []
    for r in contract_rules(settings):
        if r.column not in present:
            counters.append((r.column, "column_present", "CAST(1 AS BIGINT)"))
            continue
        raw = f"`{r.column}`"
        val = f"try_cast({raw} AS {r.dtype})"
        counters.append((r.column, f"coerce({r.dtype})", f"count_if({raw} IS NOT NULL AND {val} IS NULL)"))
        if not r.nullable:
            counters.append((r.column, "not_nullable", f"count_if({raw} IS NULL)"))
        if r.check is not None:
            passes = r.sql.format(v=val)
            counters.append((r.column, r.check, f"count_if({val} IS NOT NULL AND NOT ({passes}))"))
    # Built as SQL text: one expression per counter, parsed once on the JVM.
    agg = staged.agg(*[F.expr(f"CAST({e} AS BIGINT)").alias(f"_c{i}") for i, (_, _, e) in enumerate(counters)])
    rows = ", ".join(f"named_struct('column_name', '{col}', 'check_name', '{chk}', 'failures', _c{i})"
                     for i, (col, chk, _) in enumerate(counters))
    return agg.select(F.expr(f"inline(array({rows}))"))


def contract_errors(failures: DataFrame) -> DataFrame:
    """Failing checks grouped by check label, as in a lazy validation report."""
    return (failures.where(F.col("failures") > 0).groupBy("check_name")
            .agg(F.sum("failures").alias("n")))


def contract_report(failures: DataFrame) -> dict:
    """Small driver-side summary: pass/fail and the failing checks."""
    errors = [r.asDict() for r in contract_errors(failures).orderBy("check_name").collect()]
    return {"passed": not errors, "errors": errors}

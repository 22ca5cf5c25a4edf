"""Trip anomalies: business rules plus an isolation-forest score.

Rules are plain boolean columns.  The forest is grown from seeded draws of
bounded size and scores every trip in Arrow batches; see
``ridemart.operators.iforest``.  What follows a score
(threshold, flags, mart, summary) is the same for any score column.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridemart.constants import (ANOMALY_FEATURES, ANOMALY_RULES, MAX_PLAUSIBLE_SPEED_MPH,
                                MISMATCH_MAX_DISTANCE, MISMATCH_MIN_FARE, TIP_TO_FARE_LIMIT)
from ridemart.functions import count_when, round4
from ridemart.settings import Settings

KEYS = ["trip_id", "fleet", "pickup_location_id", "dropoff_location_id"]


def rule_columns() -> dict[str, Column]:
    """One boolean per rule, NULL comparisons count as false."""
    dist, fare = F.col("trip_distance"), F.col("fare_amount")
    tip, speed = F.col("tip_amount"), F.col("avg_speed_mph")
    rules = {
        "zero_distance": dist <= 0,
        "zero_fare": fare <= 0,
        "implausible_speed": speed > MAX_PLAUSIBLE_SPEED_MPH,
        "fare_distance_mismatch": (fare > MISMATCH_MIN_FARE) & (dist < MISMATCH_MAX_DISTANCE),
        "tip_exceeds_fare": tip > fare * TIP_TO_FARE_LIMIT,
    }
    assert tuple(rules) == ANOMALY_RULES
    return {k: F.coalesce(v, F.lit(False)) for k, v in rules.items()}


def rule_reasons() -> Column:
    """Names of the rules that fire, comma-separated in rule order ('' if none)."""
    return F.concat_ws(",", *[F.when(c, F.lit(name)) for name, c in rule_columns().items()])


def scoring_input(fact: DataFrame, settings: Settings, keys: list[str] = KEYS) -> DataFrame:
    """N1 + P9 + F11: keys and features, optional seeded sample, rows with NULLs dropped."""
    df = fact.select(*[k for k in keys if k in fact.columns], *ANOMALY_FEATURES)
    if settings.anomaly.sample_rows:
        from ridemart.operators.sampling import sample_rows
        key_cols = ["trip_id"] if "trip_id" in df.columns else None
        df = sample_rows(df, settings.anomaly.sample_rows, settings.anomaly.seed, key_cols)
    return df.dropna(subset=list(ANOMALY_FEATURES))


def with_rules(df: DataFrame) -> DataFrame:
    """Rule reason string added to a scoring frame."""
    return df.withColumn("rules", rule_reasons())


def rule_summary(df: DataFrame) -> DataFrame:
    """``(rule, count)`` for every rule, from one aggregation pass.

    X21: the rule booleans are counted directly instead of searching the
    reason strings.
    """
    cols = rule_columns()
    agg = df.agg(*[count_when(c).alias(name) for name, c in cols.items()])
    return agg.select(F.inline(F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(name).cast("long").alias("count"))
        for name in cols])))


def flag(scored: DataFrame, threshold: Column | float) -> DataFrame:
    """N5 + N12: forest outlier above the contamination threshold, OR any rule."""
    out = scored.withColumn("iso_outlier", F.col("anomaly_score") > threshold)
    if "rules" not in out.columns:
        out = with_rules(out)
    return out.withColumn("is_anomaly", F.col("iso_outlier") | (F.col("rules") != ""))


def anomaly_mart(flagged: DataFrame) -> DataFrame:
    """N13 + F12: every flagged trip with its score and reasons."""
    return flagged.where("is_anomaly")


def top_anomalies(mart: DataFrame, k: int) -> DataFrame:
    """The k flagged trips with the highest score (ties by trip id), see ``top_k``."""
    from ridemart.operators.sampling import top_k

    return top_k(mart, k, "anomaly_score", ["trip_id"] if "trip_id" in mart.columns else [])


def anomaly_summary(flagged: DataFrame, fact_rows: Column | int | None = None) -> DataFrame:
    """A19 + B5: scored rows, flagged rows, rate over scored rows (4 dp) and over the fact."""
    out = flagged.agg(F.count(F.lit(1)).alias("sampled"),
                      F.count_if("is_anomaly").alias("anomalies"))
    out = out.withColumn("anomaly_rate",
                         F.when(F.col("sampled") > 0, round4(F.col("anomalies") / F.col("sampled")))
                         .otherwise(F.lit(None).cast("double")))
    if fact_rows is not None:
        total = fact_rows if isinstance(fact_rows, Column) else F.lit(int(fact_rows))
        out = out.withColumn("fact_rows", total.cast("long")).withColumn(
            "anomaly_rate_of_fact", F.try_divide(F.col("anomalies"), F.col("fact_rows")))
    return out


def largest_z(df: DataFrame, settings: Settings) -> DataFrame:
    """A plain score next to the forest's: the largest absolute z-score of the six features."""
    from ridemart.operators import iforest

    feats = list(ANOMALY_FEATURES)
    z, zcols, _ = iforest.standardize(df, feats)
    return z.withColumn("anomaly_score", F.greatest(*[F.abs(c) for c in zcols])).drop(*zcols)


def forest_scores(df: DataFrame, settings: Settings) -> DataFrame:
    """The isolation-forest score of every row (raw features: scaling them changes no tree)."""
    from ridemart.operators import iforest

    a, feats = settings.anomaly, list(ANOMALY_FEATURES)
    rows = df.count()
    if not rows:
        return df.withColumn("anomaly_score", F.lit(None).cast("double"))
    keys = ["trip_id"] if "trip_id" in df.columns else None
    nodes = iforest.fit_forest(df, feats, a.trees, a.max_samples, a.seed, keys, rows)
    return iforest.score(df, feats, nodes)


def assess(scored: DataFrame, settings: Settings, fact_rows: Column | int | None = None) -> dict[str, DataFrame]:
    """N5, N12-N14, A19 over any scored rows (a table: several outputs read it)."""
    from ridemart.operators import iforest

    scored = with_rules(scored)
    thr = iforest.contamination_threshold(scored, settings.anomaly.contamination)
    flagged = flag(scored, F.lit(thr if thr is not None else float("inf")))
    return {
        "scored": flagged,
        "mart": anomaly_mart(flagged),
        "summary": anomaly_summary(flagged, fact_rows),
        "rules": rule_summary(flagged),
        "threshold": thr,
    }


def detect(fact: DataFrame, settings: Settings, scores_path: str, score=forest_scores) -> dict[str, DataFrame]:
    """N1-N14 end to end over the fact (with ``trip_id``).

    The scored rows are written once to ``scores_path`` and read back by the
    outputs: ``scored``, ``mart`` (N13), ``summary`` (A19, B5), ``rules``
    (N14).  Only the node table, one threshold and the feature means reach
    the driver.
    """
    score(scoring_input(fact, settings), settings).write.mode("overwrite").parquet(scores_path)
    return assess(fact.sparkSession.read.parquet(scores_path), settings, fact.count())

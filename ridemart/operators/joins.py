"""Join helpers: broadcast only behind a size bound."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Small-side ceiling for dimension broadcasts (rows).
MAX_BROADCAST_ROWS = 1_000_000

_BOUND_ATTR = "_ridemart_max_rows"


def mark_bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Record a row bound that follows from how ``df`` was built."""
    setattr(df, _BOUND_ATTR, int(max_rows))
    return df


def bounded(df: DataFrame, known_max_rows: int | None = None, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Broadcast ``df`` only when its row count is proven to be at most ``max_rows``.

    The bound is ``known_max_rows`` or one recorded with ``mark_bounded``
    (days in a window, 24 hours, partitions of a sort, a fixed table).
    Without one no hint is given and Spark's own size test decides: the planner broadcasts a side whose
    estimated size is under ``spark.sql.autoBroadcastJoinThreshold``, AQE
    re-decides from the exact size of shuffled sides, and anything larger
    gets a shuffle (sort-merge) join.
    """
    n = known_max_rows if known_max_rows is not None else getattr(df, _BOUND_ATTR, None)
    return F.broadcast(df) if n is not None and n <= max_rows else df

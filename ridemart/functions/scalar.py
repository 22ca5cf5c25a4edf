"""Scalar Column expressions shared by every stage.

Everything here returns a ``pyspark.sql.Column`` built from built-in
functions, so it stays inside whole-stage codegen.
"""

from __future__ import annotations


from pyspark.sql import Column
from pyspark.sql import functions as F

from ridemart.constants import DAY_PARTS, DISTANCE_BANDS, LAST_DAY_PART, RUSH_HOURS

__all__ = [
    "col_of", "round_half_up", "round2", "round4", "to_date_col", "hour_long",
    "monday_weekday", "is_weekend_day", "day_name", "month_name", "week_start",
    "hour_start", "date_key", "minutes_between", "safe_divide", "is_rush_hour",
    "day_part", "fourier_terms", "clip_lower", "hour_of_week", "distance_band",
    "count_when",
]


def col_of(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_half_up(c: str | Column, digits: int) -> Column:
    """``round(x, digits)``, ties away from zero on the scaled double.

    The usual database ``round`` of a DOUBLE: -0.125 gives -0.13, and NULL,
    NaN and infinities pass through unchanged (K8).
    """
    scale = float(10 ** digits)
    return F.round(col_of(c).cast("double") * scale, 0) / scale


def round2(c: str | Column) -> Column:
    return round_half_up(c, 2)


def round4(c: str | Column) -> Column:
    return round_half_up(c, 4)


def to_date_col(ts: str | Column) -> Column:
    """``CAST(ts AS DATE)``."""
    return F.to_date(col_of(ts))


def hour_long(ts: str | Column) -> Column:
    """``EXTRACT(hour)`` as BIGINT."""
    return F.hour(col_of(ts)).cast("long")


def monday_weekday(ts: str | Column) -> Column:
    """Monday=0 .. Sunday=6 as BIGINT (K6)."""
    return F.weekday(col_of(ts)).cast("long")


def is_weekend_day(ts: str | Column) -> Column:
    """Saturday or Sunday."""
    return F.weekday(col_of(ts)) >= 5


def day_name(ts: str | Column) -> Column:
    """Full English weekday name, e.g. ``Monday`` (K7)."""
    return F.date_format(col_of(ts), "EEEE")


def month_name(ts: str | Column) -> Column:
    """Full English month name, e.g. ``January`` (K7)."""
    return F.date_format(col_of(ts), "MMMM")


def week_start(d: str | Column) -> Column:
    """Monday of the week, as DATE."""
    return F.trunc(col_of(d), "week")


def hour_start(ts: str | Column) -> Column:
    """``date_trunc('hour')`` kept zone-less.

    Built as midnight of the day plus the hour, all on TIMESTAMP_NTZ, so no
    session-zone conversion is involved (``date_trunc`` would return a zoned
    TIMESTAMP).
    """
    t = col_of(ts)
    return F.timestamp_add("HOUR", F.hour(t), F.to_date(t).cast("timestamp_ntz"))


def date_key(d: str | Column) -> Column:
    """Yyyymmdd as INT (arithmetic, no string formatting)."""
    d = col_of(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def minutes_between(start: str | Column, end: str | Column) -> Column:
    """Fractional minutes between two timestamps, sub-second kept (K4)."""
    return F.timestamp_diff("MICROSECOND", col_of(start), col_of(end)) / 60_000_000.0


def safe_divide(num: str | Column, den: str | Column) -> Column:
    """X11: ``num / NULLIF(den, 0)``: NULL instead of an ANSI error (K5)."""
    return F.try_divide(col_of(num), col_of(den))


def is_rush_hour(hour: str | Column) -> Column:
    """X15 (an F13 IN list)."""
    return col_of(hour).isin(*RUSH_HOURS)


def day_part(hour: str | Column) -> Column:
    """Overnight / Morning / Midday / Evening / Night."""
    h = col_of(hour)
    expr = None
    for bound, label in DAY_PARTS:
        expr = F.when(h < bound, label) if expr is None else expr.when(h < bound, label)
    return expr.otherwise(LAST_DAY_PART)


def fourier_terms(values: str | Column, period: int, k: int, name: str) -> list[Column]:
    """``{name}_sin{i}``, ``{name}_cos{i}`` for i = 1..k."""
    v = col_of(values)
    out = []
    for i in range(1, k + 1):
        arg = F.lit(2.0) * F.pi() * F.lit(i) * v / F.lit(period)
        out += [F.sin(arg).alias(f"{name}_sin{i}"), F.cos(arg).alias(f"{name}_cos{i}")]
    return out


def clip_lower(c: str | Column, lower: float = 0.0) -> Column:
    """``clip(lower=0)``; NULL stays NULL."""
    c = col_of(c)
    return F.when(c.isNull(), F.lit(None)).otherwise(F.greatest(c, F.lit(lower)))


def hour_of_week(dow: str | Column, hour: str | Column) -> Column:
    """``dow*24 + hour``."""
    return col_of(dow) * 24 + col_of(hour)


def distance_band(dist: str | Column) -> Column:
    """Left-closed distance band label."""
    d = col_of(dist)
    expr = None
    for (lo, label), nxt in zip(DISTANCE_BANDS, list(DISTANCE_BANDS[1:]) + [None]):
        if nxt is None:
            expr = expr.when(d >= lo, label)
        else:
            cond = d < nxt[0]
            expr = F.when(cond, label) if expr is None else expr.when(cond, label)
    return expr


def count_when(cond: Column) -> Column:
    """``count_if`` that counts a NULL condition as false."""
    return F.count_if(F.coalesce(cond, F.lit(False)))



"""Calendar features and time/string helpers as built-in expressions.

Day of week is Monday = 0 (``weekday``; ``dayofweek`` is Sunday = 1), week
of year is ISO 8601, hours are UTC (the session clock).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# --- fixed values: hour / weekday sets of the calendar flags ---------------
WEEKEND_DAYS = (5, 6)
RUSH_HOURS = (7, 8, 9, 17, 18, 19)
MORNING_PEAK_HOURS = (7, 8, 9)
EVENING_PEAK_HOURS = (17, 18, 19)
LUNCH_HOURS = (12, 13, 14)
NIGHT_HOURS = (22, 23, 0, 1, 2, 3, 4, 5)
TS_FORMAT = "yyyy-MM-dd HH:mm:ss"
# ---------------------------------------------------------------------------


def time_parts(df: DataFrame, ts: str = "ts") -> DataFrame:
    """hour, day_of_week (Mon=0), day_of_month, month, week_of_year (ISO)."""
    return df.withColumns({
        "hour": F.hour(ts),
        "day_of_week": F.weekday(ts),
        "day_of_month": F.dayofmonth(ts),
        "month": F.month(ts),
        "week_of_year": F.weekofyear(ts),
    })


def time_flags(df: DataFrame) -> DataFrame:
    """boolean calendar flags from ``hour`` / ``day_of_week``."""
    h, d = F.col("hour"), F.col("day_of_week")
    return df.withColumns({
        "is_weekend": d.isin(*WEEKEND_DAYS),
        "is_rush_hour": h.isin(*RUSH_HOURS),
        "is_morning_peak": h.isin(*MORNING_PEAK_HOURS),
        "is_evening_peak": h.isin(*EVENING_PEAK_HOURS),
        "is_lunch_hour": h.isin(*LUNCH_HOURS),
        "is_night": h.isin(*NIGHT_HOURS),
    })


def _cyc(c: str, period: int, fn) -> Column:
    return fn(F.lit(2 * math.pi) * F.col(c) / F.lit(float(period)))


def time_cyclic(df: DataFrame) -> DataFrame:
    """sin / cos encodings of hour (24), weekday (7) and month (12)."""
    return df.withColumns({
        "hour_sin": _cyc("hour", 24, F.sin), "hour_cos": _cyc("hour", 24, F.cos),
        "day_sin": _cyc("day_of_week", 7, F.sin), "day_cos": _cyc("day_of_week", 7, F.cos),
        "month_sin": _cyc("month", 12, F.sin), "month_cos": _cyc("month", 12, F.cos),
    })


def with_time_features(df: DataFrame, ts: str = "ts") -> DataFrame:
    return time_cyclic(time_flags(time_parts(df, ts)))


def list_join(col: str) -> Column:
    """H1: list -> ', '-joined text."""
    return F.array_join(F.col(col).cast("array<string>"), ", ")


def list_split(col: str, as_double: bool = False) -> Column:
    """H2: ', '-joined text -> ARRAY<STRING> (or ARRAY<DOUBLE>)."""
    parts = F.split(F.col(col), ", ")
    return F.transform(parts, lambda x: x.cast("double")) if as_double else parts


def parse_timestamp(col: str) -> Column:
    """H3: strict 'yyyy-MM-dd HH:mm:ss'; unparsable -> NULL."""
    return F.expr(f"try_to_timestamp({col}, '{TS_FORMAT}')")


def format_arrival(col: str) -> Column:
    """H4: timestamp -> 'yyyy-MM-dd HH:mm:ss' (fraction truncated)."""
    return F.date_format(F.col(col), TS_FORMAT)


def minutes_between(a: str, b: str) -> Column:
    """H5: (a - b) in minutes."""
    return (F.unix_micros(F.col(a)) - F.unix_micros(F.col(b))) / F.lit(6e7)

"""Band and bucket labels. NULL inputs fall into the last label, as the data model has it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Upper limits (inclusive) and the labels they give; the last label takes the rest.
THRESHOLD_LIMITS = (25, 50, 100, 250)
THRESHOLD_BANDS = ("±$25", "±$50", "±$100", "±$250", "Outside ±$250")
MONEYNESS_LIMITS = (5, 10, 25, 50)
MONEYNESS_BUCKETS = ("Very near", "Near", "Moderate", "Far", "Very far")
TIME_LIMITS = (1, 2, 3, 5, 7, 10)
TIME_BUCKETS = ("0-1m", "1-2m", "2-3m", "3-5m", "5-7m", "7-10m", "10-15m")
UNCERTAIN_RANGE = (20, 80)
UNCERTAINTY_BUCKETS = ("Uncertain 20-80c", "Mostly decided")


def cut(value: str | Column, limits: tuple, labels: tuple) -> Column:
    """First label whose upper limit is at or above ``value``; else the last label."""
    column = F.col(value) if isinstance(value, str) else value
    chosen = F.lit(labels[-1])
    for limit, label in reversed(list(zip(limits, labels))):
        chosen = F.when(column <= limit, F.lit(label)).otherwise(chosen)
    return chosen


def threshold_band(abs_distance: str | Column) -> Column:
    return cut(abs_distance, THRESHOLD_LIMITS, THRESHOLD_BANDS)


def moneyness_bucket(abs_z_bps: str | Column) -> Column:
    return cut(abs_z_bps, MONEYNESS_LIMITS, MONEYNESS_BUCKETS)


def time_bucket(minutes_to_close: str | Column) -> Column:
    return cut(minutes_to_close, TIME_LIMITS, TIME_BUCKETS)


def uncertainty_bucket(yes_cents: str | Column) -> Column:
    column = F.col(yes_cents) if isinstance(yes_cents, str) else yes_cents
    return F.when(column.between(*UNCERTAIN_RANGE), UNCERTAINTY_BUCKETS[0]).otherwise(UNCERTAINTY_BUCKETS[1])


def ordinal(label: str | Column, labels: tuple) -> Column:
    """1-based position of a label in its fixed list; NULL for an unknown one."""
    column = F.col(label) if isinstance(label, str) else label
    return F.nullif(F.array_position(F.array(*[F.lit(x) for x in labels]), column), F.lit(0))


def time_ordinal(label: str | Column = "time_to_close_bucket") -> Column:
    return ordinal(label, TIME_BUCKETS)


def moneyness_ordinal(label: str | Column = "moneyness_bucket") -> Column:
    return ordinal(label, MONEYNESS_BUCKETS)

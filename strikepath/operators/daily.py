"""Daily trade totals and their statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.functions.aggregates import rows, sum_or_zero
from strikepath.functions.clock import parse_time


def daily_totals(df: DataFrame, time: str, count: str, name: str | None = None) -> DataFrame:
    """Sum of ``count`` per calendar day; rows without a readable time are left out."""
    at = parse_time(time)
    return (
        df.where(at.isNotNull())
        .groupBy(F.to_date(at).alias("date"))
        .agg(sum_or_zero(count).alias(name or count))
    )


def total_stats(daily: DataFrame, count: str) -> DataFrame:
    """Days, total, mean, median, minimum and maximum. A frame of days is small by nature."""
    return daily.agg(
        rows().alias("n_days"),
        F.sum(count).alias("total"),
        F.avg(count).alias("mean"),
        F.percentile(count, 0.5).alias("median"),
        F.min(count).alias("min"),
        F.max(count).alias("max"),
    )

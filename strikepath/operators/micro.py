"""Per-second futures micro-structure and its rolling volatility."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from strikepath.functions.aggregates import exact_mean, sum_or_zero
from strikepath.functions.prices import log_return_bps
from strikepath.operators.lookback import with_lookback

MEAN_COLUMNS = ("spread", "spread_bps", "quote_spread")
SUM_COLUMNS = ("trade_count", "trade_size", "trade_volume")
VOL_ROWS = 60
VOL_MIN_RETURNS = 20
# Seconds of a week that one task works on; a week has 604,800.
VOL_SLOT_ROWS = 100_000


def per_second(panel: DataFrame, underlying: str = "underlying_series") -> DataFrame:
    """One row per week and second: mean price and spreads, summed activity."""
    measures = [exact_mean(underlying).alias("underlying")] if underlying in panel.columns else []
    measures += [exact_mean(c).alias(c) for c in MEAN_COLUMNS if c in panel.columns]
    measures += [sum_or_zero(c).alias(c) for c in SUM_COLUMNS if c in panel.columns]
    return panel.groupBy("week_id", "second").agg(*measures)


def local_volatility(df: DataFrame, window: WindowSpec) -> DataFrame:
    """1-row change, 1-row log return and its deviation over the last 60 rows."""
    recent = window.rowsBetween(-(VOL_ROWS - 1), 0)
    returns = F.col("underlying_return_1s_bps")
    enough = F.count(returns).over(recent) >= VOL_MIN_RETURNS
    return (
        df.withColumn("underlying_change_1s", F.col("underlying") - F.lag("underlying", 1).over(window))
        .withColumn(
            "underlying_return_1s_bps", log_return_bps("underlying", F.lag("underlying", 1).over(window))
        )
        .withColumn("local_vol_60s_bps", F.when(enough, F.stddev_samp(returns).over(recent)))
    )


def with_local_volatility(
    micro: DataFrame, slot_rows: int = VOL_SLOT_ROWS, sampled_from: DataFrame | None = None
) -> DataFrame:
    """Add change, return and local volatility along each week's seconds, which are cut into ranges.

    ``sampled_from`` is the panel that the frame was grouped from, or any frame with its weeks and seconds.
    """
    return with_lookback(micro, ("week_id",), "second", VOL_ROWS, local_volatility, slot_rows, sampled_from)


def spread_column(df: DataFrame) -> str:
    """The spread shown: basis points if there, else dollars, else the quote spread."""
    for name in ("spread_bps", "spread", "quote_spread"):
        if name in df.columns:
            return name
    raise ValueError("no spread column")


def volume_column(df: DataFrame) -> str:
    return "trade_volume" if "trade_volume" in df.columns else "trade_size"


def micro_kpis(micro: DataFrame) -> DataFrame:
    """Totals of trades and size, mean spread and mean local volatility per week."""
    return micro.groupBy("week_id").agg(
        sum_or_zero("trade_count").alias("total_trade_count"),
        sum_or_zero(volume_column(micro)).alias("total_trade_size"),
        F.avg(spread_column(micro)).alias("avg_spread"),
        F.avg("local_vol_60s_bps").alias("avg_local_vol"),
    )

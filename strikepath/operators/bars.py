"""15-minute futures bars, the leading symbol of each week, and 1-second trade bars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strikepath.functions import clock
from strikepath.functions.aggregates import first_by, last_by, last_known_by, rows, sum_or_zero, tick_order
from strikepath.functions.prices import change, return_pct

BAR_KEYS = ("window_start", "symbol", "week_start")


def ohlc_bars(micro: DataFrame, window_seconds: int = clock.WINDOW_SECONDS) -> DataFrame:
    """One bar per window, symbol and week.

    The regime text rides along as a grouping key of a first pass whose buffers
    are all fixed-width, so the large input goes through hash aggregation; only
    the few rows per bar that come out are merged on the text. Ticks of one moment
    are in the order of their files (``source_row``); without that, the lowest price
    opens and the highest closes, so that no order of tasks can show.
    """
    order = tick_order("timestamp", "mid_price", micro.columns)
    ticks = micro.where(F.col("timestamp").isNotNull() & F.col("mid_price").isNotNull()).withColumns(
        {"window_start": clock.floor_to("timestamp", window_seconds), "week_start": clock.week_start("timestamp")}
    )
    parts = ticks.groupBy(*BAR_KEYS, "vol_regime").agg(
        F.min("timestamp").alias("t0"),
        F.max("timestamp").alias("t1"),
        F.min(order).alias("o0"),
        F.max(order).alias("o1"),
        first_by("mid_price", order).alias("open"),
        last_by("mid_price", order).alias("close"),
        F.max("mid_price").alias("high"),
        F.min("mid_price").alias("low"),
        F.sum("spread").alias("spread_sum"),
        F.count("spread").alias("spread_n"),
        F.sum("spread_bps").alias("bps_sum"),
        F.count("spread_bps").alias("bps_n"),
        F.sum("rv_60s").alias("rv_sum"),
        F.count("rv_60s").alias("rv_n"),
        F.sum("trade_count").alias("trades"),
        F.sum("trade_volume").alias("volume"),
        F.count_if("event_large_move").alias("large"),
    )
    return (
        parts.groupBy(*BAR_KEYS)
        .agg(
            F.min("t0").alias("first_timestamp"),
            F.max("t1").alias("last_timestamp"),
            first_by("open", "o0").alias("futures_open"),
            last_by("close", "o1").alias("futures_close"),
            F.max("high").alias("futures_high"),
            F.min("low").alias("futures_low"),
            F.try_divide(F.sum("spread_sum"), F.sum("spread_n")).alias("spread_mean"),
            F.try_divide(F.sum("bps_sum"), F.sum("bps_n")).alias("spread_bps_mean"),
            sum_or_zero("trades").alias("trade_count_sum"),
            sum_or_zero("volume").alias("trade_volume_sum"),
            F.try_divide(F.sum("rv_sum"), F.sum("rv_n")).alias("rv_60s_mean"),
            F.sum("large").alias("large_move_rows"),
            last_known_by("vol_regime", "o1", "vol_regime").alias("vol_regime"),
        )
        .withColumns(
            {
                "futures_change": change("futures_close", "futures_open"),
                "futures_return_pct": return_pct("futures_close", "futures_open"),
            }
        )
    )


def symbol_counts(bars: DataFrame) -> DataFrame:
    """Bars per week and symbol."""
    return bars.groupBy("week_start", "symbol").agg(rows().alias("rows"))


def dominant_symbols(bars: DataFrame) -> DataFrame:
    """The symbol with most bars in each week; equal counts go to the first in the alphabet."""
    best = F.min(F.struct((-F.col("rows")).alias("neg"), F.col("symbol")))
    return (
        symbol_counts(bars)
        .groupBy("week_start")
        .agg(best.alias("best"))
        .select(
            "week_start",
            F.col("best.symbol").alias("dominant_symbol"),
            (-F.col("best.neg")).alias("dominant_symbol_rows"),
        )
    )


def keep_dominant(bars: DataFrame) -> DataFrame:
    """Only the bars of each week's leading symbol.

    Works on finished bars, at most 672 per symbol and week however many ticks
    there were, so one pass over a week's bars replaces a join that would have
    to read the ticks twice.
    """
    week = W.partitionBy("week_start")
    count = F.count(F.lit(1)).over(W.partitionBy("week_start", "symbol"))
    return (
        bars.withColumn("_neg", -count)
        .withColumn("_best", F.min(F.struct("_neg", "symbol")).over(week))
        .where(F.col("symbol") == F.col("_best.symbol"))
        .drop("_neg", "_best")
    )


def _ticks(trades: DataFrame, *needed: str) -> DataFrame:
    return trades.na.drop(subset=list(needed)).withColumn("second", clock.floor_second("ts_event"))


def trade_bars_by_symbol(trades: DataFrame) -> DataFrame:
    """One row per symbol and second that traded."""
    return (
        _ticks(trades, "ts_event", "price", "symbol")
        .groupBy("symbol", "second")
        .agg(
            last_by("price", tick_order("ts_event", "price", trades.columns)).alias("futures_last_trade_price_1s"),
            rows().alias("futures_trade_count_1s"),
            sum_or_zero("size").alias("futures_trade_size_1s"),
        )
        .withColumn("has_futures_trade_1s", F.col("futures_trade_count_1s") > 0)
    )


def trade_bars(trades: DataFrame) -> DataFrame:
    """One row per second that traded, over all symbols, with the last known symbol.

    The symbol is a key of the first pass for the same reason as in ``ohlc_bars``.
    """
    order = tick_order("ts_event", "price", trades.columns)
    parts = (
        _ticks(trades, "ts_event", "price")
        .groupBy("second", "symbol")
        .agg(
            F.max(order).alias("o1"),
            last_by("price", order).alias("last"),
            rows().alias("n"),
            F.sum("size").alias("volume"),
        )
    )
    return parts.groupBy("second").agg(
        last_by("last", "o1").alias("underlying_trade_price"),
        F.sum("n").alias("underlying_trade_count"),
        sum_or_zero("volume").alias("underlying_trade_size"),
        last_known_by("symbol", "o1", "symbol").alias("underlying_trade_symbol"),
    )

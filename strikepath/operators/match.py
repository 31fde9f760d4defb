"""Markets and labels against the bars of the leading symbol."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.functions import buckets, clock, prices
from strikepath.operators.skew import frequent_join

NEAR_DOLLARS = 100


def clean_markets(markets: DataFrame) -> DataFrame:
    """Markets that have a close, with prices in cents and the week they close in."""
    return markets.where(F.col("close_time").isNotNull()).withColumns(
        {
            "last_price_cents": prices.cents("last_price"),
            "yes_ask_cents": prices.cents("yes_ask"),
            "yes_bid_cents": prices.cents("yes_bid"),
            "spread_cents": prices.cents("spread"),
            "yes_mid_cents": prices.mid_cents("yes_bid", "yes_ask"),
            "week_start": clock.week_start("close_time"),
            "close_date": F.date_format("close_time", clock.ID_FORMAT),
        }
    )


def clean_labels(labels: DataFrame) -> DataFrame:
    """Label windows with their week and the lengths of their parts in seconds."""
    return labels.withColumns(
        {
            "week_start": clock.week_start("window_start"),
            "window_seconds": clock.whole_seconds("window_end", "window_start"),
            "seconds_from_decision_to_end": clock.whole_seconds("window_end", "decision_point"),
            "seconds_from_close_start_to_end": clock.whole_seconds("window_end", "close_start"),
        }
    )


def window_behavior(labels: DataFrame, leading_bars: DataFrame) -> DataFrame:
    """Every label window with the bar of the same window, if any."""
    return labels.join(leading_bars, ["window_start", "week_start"], "left").withColumns(
        {
            "window_direction": prices.window_direction("label"),
            # The label's own price change decides, not the bar's.
            "futures_direction": prices.futures_direction("price_change"),
        }
    )


def threshold_matches(markets: DataFrame, leading_bars: DataFrame, week_of: str = "window") -> DataFrame:
    """Every market with the bar that ends at its close, and its distance to the strike.

    A market closing at Monday 00:00 is filed under the new week while its bar
    lies in the old one. ``week_of="window"`` looks the bar up by its own week;
    ``week_of="close"`` uses the filing week, so such a market finds none.

    Many markets share a close, so the lookup key is skewed on the market side and
    is dealt out there; the bar side is unique per key.
    """
    keyed = markets.withColumn(
        "window_start", clock.floor_to(F.col("close_time") - F.expr("INTERVAL 15 MINUTES"))
    )
    week = clock.week_start("window_start") if week_of == "window" else F.col("week_start")
    distance = F.col("futures_close") - F.col("floor_strike")
    on = {"window_start": "window_start", "_key": "week_start"}
    return (
        frequent_join(keyed.withColumn("_key", week), leading_bars, on, ["ticker"])
        .drop("_key")
        .withColumns(
            {
                "distance_to_threshold": distance,
                "abs_distance_to_threshold": F.abs(distance),
                "distance_to_threshold_bps": prices.bps_of("futures_close", "floor_strike", "futures_close"),
                "threshold_band": buckets.threshold_band(F.abs(distance)),
            }
        )
    )


def strike_moneyness_bps(matches: DataFrame) -> DataFrame:
    """Distance in basis points of the strike itself, beside the one of the price."""
    return matches.withColumn(
        "moneyness_bps_strike", prices.bps_of("futures_close", "floor_strike", "floor_strike")
    )


def band_counts(matches: DataFrame) -> DataFrame:
    """Markets per week and distance band."""
    return matches.groupBy("week_start", "threshold_band").agg(F.count(F.lit(1)).alias("n_markets"))

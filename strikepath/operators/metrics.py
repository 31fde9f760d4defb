"""Week indexes and the long metric tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikepath.functions import buckets, clock
from strikepath.functions.aggregates import distinct_with_null, rows, sum_or_zero
from strikepath.operators.match import NEAR_DOLLARS
from strikepath.operators.panel import UNIT_FACTORS

NEAR_BPS = 10

# Metric names in report order.
MARKET_METRICS = (
    "kalshi_markets",
    "label_windows",
    "futures_15m_rows",
    "threshold_matches",
    "near_threshold_100_count",
    "avg_abs_15m_futures_change",
)
CONTRACT_METRICS = (
    "contract_behavior_rows",
    "contracts",
    "trade_seconds",
    "decision_contracts",
    "avg_minutes_before_decision",
    "near_moneyness_rows_abs_z_bps_10",
    "uncertain_20_80_rows",
)


def market_index(markets: DataFrame) -> DataFrame:
    """First and last close, markets and events of each week.

    Events are collapsed first: one distinct count over a pre-aggregated set.
    """
    per_event = markets.groupBy("week_start", "event_ticker").agg(
        F.min("close_time").alias("t0"), F.max("close_time").alias("t1"), rows().alias("n")
    )
    return per_event.groupBy("week_start").agg(
        F.min("t0").alias("kalshi_start"),
        F.max("t1").alias("kalshi_end"),
        F.sum("n").alias("n_kalshi_markets"),
        rows().alias("n_kalshi_events"),
    )


def label_index(labels: DataFrame) -> DataFrame:
    return labels.groupBy("week_start").agg(
        rows().alias("n_label_windows"), F.avg(F.abs("price_change")).alias("avg_abs_15m_futures_change")
    )


def bar_index(bars: DataFrame) -> DataFrame:
    return bars.groupBy("week_start").agg(
        rows().alias("n_futures_15m_rows"), sum_or_zero("large_move_rows").alias("n_large_move_rows_15m")
    )


def named_week(df: DataFrame, sep: str = " to ") -> DataFrame:
    return df.withColumns(
        {"week_id": clock.week_id("week_start"), "week_label": clock.week_label("week_start", sep)}
    )


def week_index(markets: DataFrame, labels: DataFrame, bars: DataFrame, sep: str = " to ") -> DataFrame:
    """One row per week known to any of the three tables.

    Each table comes as one row per week, so they meet in one grouping in place of a
    chain of full outer joins; what a table lacks stays NULL.
    """
    parts = [market_index(markets), label_index(labels), bar_index(bars)]
    columns = [c for part in parts for c in part.columns if c != "week_start"]
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    joined = combined.groupBy("week_start").agg(*[F.max(c).alias(c) for c in columns])
    return named_week(joined, sep)


def contract_week_index(features: DataFrame, sep: str = " to ") -> DataFrame:
    """Range, rows, contracts, trade seconds, decision rows and source periods per week.

    ``decision_rows`` counts seconds of decided contracts, not contracts.
    """
    per_contract = features.groupBy("week_start", "ticker", "data_source_period").agg(
        F.min("second").alias("t0"),
        F.max("second").alias("t1"),
        rows().alias("n"),
        F.count_if("has_trade_this_second").alias("trades"),
        F.count_if("decision_found").alias("decisions"),
    )
    index = per_contract.groupBy("week_start").agg(
        F.min("t0").alias("start_time"),
        F.max("t1").alias("end_time"),
        F.sum("n").alias("n_rows"),
        distinct_with_null("ticker").alias("n_contracts"),
        F.sum("trades").alias("trade_seconds"),
        F.sum("decisions").alias("decision_rows"),
        F.count_distinct("data_source_period").alias("n_source_periods"),
    )
    return named_week(index, sep)


def to_long(wide: DataFrame, names: Sequence[str], key: str = "week_id") -> DataFrame:
    """One (metric, value) row per name."""
    values = wide.select(key, *[F.col(n).cast("double").alias(n) for n in names])
    return values.unpivot(key, list(names), "metric", "value")


def market_metrics(markets: DataFrame, labels: DataFrame, bars: DataFrame, matches: DataFrame) -> DataFrame:
    """The market metric set of each week.

    Each table is reduced to one row per week before they meet, and they meet in
    one grouping instead of a chain of outer joins.
    """
    near = F.count_if(F.col("abs_distance_to_threshold") <= NEAR_DOLLARS)
    counted = [
        markets.groupBy("week_start").agg(rows().alias("kalshi_markets")),
        labels.groupBy("week_start").agg(
            rows().alias("label_windows"), F.avg(F.abs("price_change")).alias("avg_abs_15m_futures_change")
        ),
        bars.groupBy("week_start").agg(rows().alias("futures_15m_rows")),
        matches.groupBy("week_start").agg(
            rows().alias("threshold_matches"), near.alias("near_threshold_100_count")
        ),
    ]
    combined = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), counted)
    wide = combined.groupBy(clock.week_id("week_start").alias("week_id")).agg(
        *[sum_or_zero(name).alias(name) for name in MARKET_METRICS[:-1]],
        F.max(MARKET_METRICS[-1]).alias(MARKET_METRICS[-1]),
    )
    return to_long(wide, MARKET_METRICS)


def contract_metrics(features: DataFrame, price_unit: str = "dollars") -> DataFrame:
    """The contract metric set of each week.

    Rows are reduced to contracts first; the mean decision lead is then over
    contracts, each counted once with its earliest row.
    """
    at = "observed_at" if "observed_at" in features.columns else "second"
    low, high = buckets.UNCERTAIN_RANGE
    cents = F.col("kalshi_yes_price") * UNIT_FACTORS[price_unit]
    per_contract = features.groupBy("week_id", "ticker").agg(
        rows().alias("n"),
        F.count_if("has_trade_this_second").alias("trades"),
        F.min_by("decision_found", at).alias("decided"),
        F.min_by("minutes_before_close_at_decision", at).alias("lead"),
        F.count_if(F.col("abs_z_bps") <= NEAR_BPS).alias("near"),
        F.count_if(cents.between(low, high)).alias("uncertain"),
    )
    wide = per_contract.groupBy("week_id").agg(
        *[
            measure.alias(name)
            for name, measure in zip(
                CONTRACT_METRICS,
                (
                    F.sum("n"),
                    rows(),
                    F.sum("trades"),
                    F.count_if("decided"),
                    F.avg(F.when(F.col("decided"), F.col("lead"))),
                    F.sum("near"),
                    F.sum("uncertain"),
                ),
            )
        ]
    )
    return to_long(wide, CONTRACT_METRICS)


def metric(name: str, default: Column | float | None = None) -> Column:
    """Aggregate: the value of one metric of a long table, or ``default``."""
    found = F.max(F.when(F.col("metric") == name, F.col("value")))
    if default is None:
        return found
    return F.coalesce(found, default if isinstance(default, Column) else F.lit(default))


def complete_weeks(products: dict[str, DataFrame], root: str, sep: str = " - ") -> DataFrame:
    """Weeks that every one of the given products holds, with label and path.

    ``products`` maps a product name to any frame with a ``week_id``.
    """
    present = [df.select("week_id", F.lit(name).alias("product")).distinct() for name, df in products.items()]
    return named_complete(reduce(lambda a, b: a.unionByName(b), present), len(products), root, sep)


def named_complete(held: DataFrame, n_products: int, root: str, sep: str = " - ") -> DataFrame:
    """Weeks with ``n_products`` rows of (week_id, product), with label and path."""
    weeks = held.groupBy("week_id").agg(rows().alias("n"))
    return weeks.where((F.col("n") == n_products) & F.col("week_id").isNotNull()).select(
        "week_id",
        clock.week_label_from_id("week_id", sep).alias("week_label"),
        F.col("week_id").alias("week_start"),
        F.concat(F.lit(root.rstrip("/") + "/"), "week_id").alias("week_path"),
    )

"""The table behind each analysis panel.

Every view answers for all weeks, and the contract views for all contracts; a
reader narrows the result (``where week_id = …``), which prunes partitions of
the stored products.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from strikepath.functions import buckets, clock
from strikepath.functions.aggregates import exact_mean
from strikepath.operators import display, filters, micro, profile, stats
from strikepath.operators.lookback import with_lookback
from strikepath.operators.metrics import metric
from strikepath.operators.panel import order_column
from strikepath.operators.skew import own_exchange
from strikepath.roles import keep_existing
from pyspark.sql import Window as W

WEEK = "week_id"
CONTRACT = ("week_id", "ticker")


def week_kpis(contract_metrics: DataFrame, market_metrics: DataFrame) -> DataFrame:
    """Six headline figures; contracts fall back to listed markets, then to 0."""
    both = contract_metrics.unionByName(market_metrics)
    return both.groupBy(WEEK).agg(
        metric("contracts", metric("kalshi_markets", 0.0)).alias("contracts"),
        metric("contract_behavior_rows", 0.0).alias("contract_rows"),
        metric("trade_seconds", 0.0).alias("trade_seconds"),
        metric("decision_contracts", 0.0).alias("decision_contracts"),
        metric("avg_minutes_before_decision").alias("avg_decision_minutes"),
        metric("near_moneyness_rows_abs_z_bps_10", 0.0).alias("near_money_rows"),
    )


def yes_change_histogram(contract_summary: DataFrame, bins: int = 50) -> DataFrame:
    shown = display.with_display_prices(contract_summary)
    return stats.histogram(shown, [WEEK], "yes_price_change_display", bins, per_week=True)


def outcomes(contract_summary: DataFrame) -> DataFrame:
    return stats.category_counts(contract_summary, [WEEK], "inferred_winner")


def underlying_path(sample: DataFrame, bars: DataFrame | None = None) -> DataFrame:
    """Mean underlying per second; a week without any value shows 15-minute closes by symbol."""
    series = display.with_underlying_series(display.with_underlying_columns(sample))
    path = (
        series.where(F.col("underlying_source_column").isNotNull())
        .groupBy(WEEK, "second")
        .agg(exact_mean("underlying_series").alias("value"))
        .withColumn("symbol", F.lit(None).cast("string"))
    )
    if bars is None:
        return path
    known = series.where(F.col("underlying_source_column").isNotNull()).select(WEEK).distinct()
    closes = bars.select(
        clock.week_id("week_start").alias(WEEK), F.col("window_start").alias("second"), "symbol",
        F.col("futures_close").alias("value"),
    ).join(F.broadcast(known), WEEK, "left_anti")  # one row per week
    return path.unionByName(closes)


def _decided(decisions: DataFrame) -> DataFrame:
    return decisions.where(F.col("decision_found")) if "decision_found" in decisions.columns else decisions


def decision_histogram(decisions: DataFrame, bins: int = 40) -> DataFrame:
    split = "inferred_winner" if "inferred_winner" in decisions.columns else None
    return stats.histogram(
        _decided(decisions), [WEEK], "minutes_before_close_at_decision", bins, split, per_week=True
    )


# Output columns in their given order.
METADATA = (
    "ticker",
    "contract_open_time",
    "contract_close_time",
    "selected_futures_symbol",
    "futures_symbol",
    "inferred_winner",
    "outcome_yes",
    "data_source_period",
)


def contract_metadata(evolution: DataFrame) -> DataFrame:
    """First row's attributes of every contract."""
    at = order_column(evolution)
    texts = [
        c
        for c in ("selected_futures_symbol", "futures_symbol", "inferred_winner", "data_source_period")
        if c in evolution.columns
    ]
    fixed = ("contract_open_time", "contract_close_time", "outcome_yes")
    parts = evolution.groupBy(*CONTRACT, *texts).agg(
        F.min(at).alias("t0"), *[F.min_by(c, at).alias(c) for c in fixed]
    )
    firsts = parts.groupBy(*CONTRACT).agg(*[F.min_by(c, "t0").alias(c) for c in (*texts, *fixed)])
    return keep_existing(firsts, WEEK, *METADATA)


def _prices(panel: DataFrame, cheaper: DataFrame | None) -> DataFrame:
    """What decides the unit of a week: its prices, from a frame that costs less than ``panel`` where there is one."""
    return keep_existing(panel if cheaper is None else cheaper, WEEK, "yes_price_cents", "no_price_cents")


def contract_moves(features: DataFrame, quotes: DataFrame | None = None) -> DataFrame:
    """1- and 5-row YES moves in cents of every contract; rows that have both.

    Taken over the whole path and not over a sample of it. ``quotes`` holds the
    same prices without the moves.
    """
    shown = display.with_display_prices(features, decide_on=_prices(features, quotes))
    return shown.where(F.col("yes_price_change_1s").isNotNull() & F.col("yes_price_change_5s").isNotNull()).withColumn(
        "abs_yes_price_change_5s_display", F.abs("yes_price_change_5s_display")
    )


def move_histogram(moves: DataFrame, bins: int = 60) -> DataFrame:
    return stats.histogram(moves, CONTRACT, "yes_price_change_5s_display", bins, whole=True)


def move_boxes(moves: DataFrame, bins: int = 60) -> DataFrame:
    """Box figures by time bucket; without buckets, a histogram of the absolute move."""
    if "time_to_close_bucket" not in moves.columns:
        return stats.histogram(moves, CONTRACT, "abs_yes_price_change_5s_display", bins, whole=True)
    return stats.box_stats(
        moves, (*CONTRACT, "time_to_close_bucket"), "abs_yes_price_change_5s_display", slot_rows=None
    )


# Output columns in their given order.
LARGEST_MOVES = (
    "second",
    "yes_price_change_5s_display",
    "abs_yes_price_change_5s_display",
    "yes_price_cents_display",
    "no_price_cents_display",
    "time_to_close_bucket",
    "moneyness_bucket",
    "z_bps",
    "abs_z_bps",
)


def largest_moves(moves: DataFrame, n: int, probability: float = 0.95) -> DataFrame:
    """Each contract's largest moves at or above its own 95th percentile."""
    big = stats.at_or_above_quantile(
        moves, CONTRACT, "abs_yes_price_change_5s_display", probability, "p95_move", slot_rows=None
    )
    at = order_column(moves)
    top = stats.top_per_group(big, CONTRACT, n, F.desc("abs_yes_price_change_5s_display"), at)
    return keep_existing(top, *CONTRACT, "rank", "p95_move", *LARGEST_MOVES)


def decision_markers(evolution: DataFrame, decisions: DataFrame) -> DataFrame:
    """Per contract: close time and the moment it was decided, if it was.

    The moment is the close less the stored lead, only where a decision was found.
    """
    at = order_column(evolution)
    closes = evolution.groupBy(*CONTRACT).agg(
        F.min_by("contract_close_time", F.when(F.col("contract_close_time").isNotNull(), F.col(at))).alias("close_marker")
    )
    found = _decided(decisions).select(*CONTRACT, F.col("minutes_before_close_at_decision").alias("lead"))
    return closes.join(found, list(CONTRACT), "left").select(
        *CONTRACT, "close_marker", clock.minus_minutes("close_marker", "lead").alias("decision_marker")
    )


def decision_zone(df: DataFrame) -> DataFrame:
    """Bounds of the stretch from 7 to 2 minutes before the close, and a flag."""
    return df.withColumns(
        {
            "zone_start": clock.minus_minutes("close_marker", 7),
            "zone_end": clock.minus_minutes("close_marker", 2),
        }
    ).withColumn("in_zone", F.col("second").between(F.col("zone_start"), F.col("zone_end")))


def combined_path(evolution: DataFrame, decisions: DataFrame) -> DataFrame:
    """YES, NO and underlying per second of every contract, with its markers.

    All that a contract or its week decides comes from one grouped pass over the
    panel, which its rows then meet once.
    """
    base = display.with_underlying_columns(evolution)
    found = _decided(decisions).select(*CONTRACT, F.col("minutes_before_close_at_decision").alias("lead"))
    facts = display.path_facts(base, order_column(evolution)).join(found, list(CONTRACT), "left")
    facts = facts.withColumn("decision_marker", clock.minus_minutes("close_marker", "lead")).drop("lead")
    known = [c for c in facts.columns if c in base.columns and c not in CONTRACT]
    shown = display.in_cents(base.drop(*known).join(own_exchange(facts, "ticker"), list(CONTRACT), "left"))
    return decision_zone(shown).select(
        *CONTRACT,
        "second",
        F.col("yes_price_cents_display").alias("yes"),
        F.col("no_price_cents_display").alias("no"),
        display.chosen_series(base).alias("underlying"),
        "start_underlying",
        "close_marker",
        "decision_marker",
        "in_zone",
    )


def distance_path(evolution: DataFrame) -> DataFrame:
    """Distance to the strike per second of every contract, with its near band."""
    shown = display.with_distance_series(evolution)
    return shown.where(F.col("distance_column").isNotNull()).select(
        *CONTRACT, "second", "distance", "distance_label", "band", "in_band"
    )


def micro_frame(panel: DataFrame) -> DataFrame:
    """Per-second micro-structure with rolling volatility, over the full panel.

    On a sample the 60 rows of the volatility window would not be neighbours.
    """
    series = display.with_underlying_series(display.with_underlying_columns(panel))
    return micro.with_local_volatility(micro.per_second(series), sampled_from=panel)


def micro_series(frame: DataFrame) -> DataFrame:
    return keep_existing(
        frame, WEEK, "second", "underlying", micro.spread_column(frame), "trade_count",
        micro.volume_column(frame), "local_vol_60s_bps",
    )


def spread_vs_volatility(frame: DataFrame) -> DataFrame:
    spread = micro.spread_column(frame)
    return frame.na.drop(subset=[spread, "local_vol_60s_bps"]).select(
        WEEK, "second", "local_vol_60s_bps", F.col(spread).alias("spread")
    )


def decision_shares(decisions: DataFrame) -> DataFrame:
    return stats.category_shares(_decided(decisions), [WEEK], "inferred_winner")


def decision_statistics(decisions: DataFrame) -> DataFrame:
    return stats.describe(_decided(decisions), [WEEK], "minutes_before_close_at_decision", ["ticker"])


# Output columns in their given order.
DECISION_TABLE = (
    "ticker",
    "contract_open_time",
    "contract_close_time",
    "inferred_winner",
    "decision_time",
    "minutes_before_close_at_decision",
    "data_source_period",
)


def decision_table(decisions: DataFrame, n: int) -> DataFrame:
    """Each week's contracts that were decided longest before their close."""
    top = stats.top_per_group(
        _decided(decisions), [WEEK], n, F.desc_nulls_last("minutes_before_close_at_decision"), "ticker"
    )
    return keep_existing(top, WEEK, "rank", *DECISION_TABLE)


def heatmap_matrix(heatmap: DataFrame) -> DataFrame:
    """Moneyness rows by time columns of the mean absolute 5-row move, in cents."""
    shown = display.with_display_prices(heatmap)
    return stats.pivot_mean(
        shown.withColumn("moneyness_order", buckets.moneyness_ordinal()),
        [WEEK, "moneyness_order", "moneyness_bucket"],
        "time_to_close_bucket",
        buckets.TIME_BUCKETS,
        "mean_abs_yes_price_change_5s_display",
    )


def distance_histogram(sample: DataFrame, bins: int = 60, **chosen: str) -> DataFrame:
    kept = filters.apply_filters(sample, **chosen)
    return stats.histogram(kept, [WEEK], "abs_z_bps", bins, "time_to_close_bucket", per_week=True)


def distance_vs_response(sample: DataFrame, quotes: DataFrame | None = None, **chosen: str) -> DataFrame:
    """Distance and absolute 5-row response of every sampled row that has both."""
    shown = display.with_display_prices(filters.apply_filters(sample, **chosen), decide_on=_prices(sample, quotes))
    return shown.na.drop(subset=["abs_z_bps", "abs_yes_price_change_5s_display"]).select(
        *CONTRACT, "second", "minutes_to_close", "yes_price_cents_display", "abs_z_bps",
        "abs_yes_price_change_5s_display", "time_to_close_bucket",
    )


def move_pairs(sample: DataFrame, quotes: DataFrame | None = None, **chosen: str) -> DataFrame:
    """5-row underlying move against 5-row YES move.

    Both moves come from the full panel, computed before sampling and filtering,
    so they span five neighbouring rows.
    """
    shown = display.with_display_prices(filters.apply_filters(sample, **chosen), decide_on=_prices(sample, quotes))
    return shown.na.drop(subset=["underlying_change_5s", "yes_price_change_5s_display"]).select(
        *CONTRACT, "second", "abs_z_bps", "minutes_to_close", "underlying_change_5s",
        "yes_price_change_5s_display", "time_to_close_bucket",
    )


def filtered_move_pairs(panel: DataFrame, quotes: DataFrame | None = None, **chosen: str) -> DataFrame:
    """The same pairs with the underlying move taken over five of the rows that the filter keeps.

    ``quotes`` holds the panel's rows without moves: units, series and ranges are decided on it.
    """
    cheaper = display.with_underlying_columns(filters.apply_filters(panel if quotes is None else quotes, **chosen))
    series = display.with_underlying_series(display.with_underlying_columns(filters.apply_filters(panel, **chosen)), cheaper)
    shown = display.with_display_prices(series, decide_on=keep_existing(cheaper, WEEK, "yes_price_cents"))

    def moved(df: DataFrame, window: WindowSpec) -> DataFrame:
        move = F.col("underlying_series") - F.lag("underlying_series", 5).over(window)
        return df.withColumn("selected_underlying_change_5s", move)

    order = (order_column(panel), "underlying_series")
    sampled = display.with_underlying_series(cheaper)
    return (
        with_lookback(shown, CONTRACT, order, 5, moved, sampled_from=sampled)
        .na.drop(subset=["selected_underlying_change_5s", "yes_price_change_5s_display"])
        .select(
            *CONTRACT, "second", "selected_underlying_change_5s", "yes_price_change_5s_display",
            "time_to_close_bucket",
        )
    )


def sensitivity_curve(bins: DataFrame) -> DataFrame:
    """Mean absolute 5-row move by moneyness, one line per time bucket, in bucket order."""
    shown = display.with_display_prices(bins).withColumns(
        {"moneyness_order": buckets.moneyness_ordinal(), "time_order": buckets.time_ordinal()}
    )
    return shown.select(
        WEEK, "moneyness_order", "moneyness_bucket", "time_order", "time_to_close_bucket",
        "mean_abs_yes_price_change_5s_display",
    ).orderBy(WEEK, "time_order", "moneyness_order")


# Output columns in their given order.
PREVIEW_COLUMNS = (
    "second",
    "underlying_value",
    "underlying_modeling",
    "underlying_trade_price",
    "underlying_quote_mid",
    "best_bid",
    "best_ask",
    "spread",
    "spread_bps",
    "quote_spread",
    "trade_count",
    "trade_size",
    "trade_volume",
    "yes_price_cents",
    "no_price_cents",
    "yes_price_cents_display",
    "no_price_cents_display",
    "z_bps",
    "abs_z_bps",
    "time_to_close_bucket",
    "moneyness_bucket",
)


def evolution_preview(evolution: DataFrame, n: int) -> DataFrame:
    """First rows of every contract."""
    top = stats.top_per_group(evolution, CONTRACT, n, order_column(evolution))
    shown = display.with_display_prices(display.with_underlying_columns(top), decide_on=evolution)
    return keep_existing(shown, *CONTRACT, "rank", *PREVIEW_COLUMNS)


def product_preview(product: DataFrame, n: int, *order) -> DataFrame:
    """First rows of a product per week."""
    return stats.top_per_group(product, [WEEK], n, *order)


def price_audit(evolution: DataFrame, sample: DataFrame) -> DataFrame:
    return profile.series_audit(
        {
            "contract_evolution_1s": display.with_underlying_columns(evolution),
            "contract_plot_sample": display.with_underlying_columns(sample),
        }
    )


def filter_options(sample: DataFrame) -> DataFrame:
    """Every value of the three filters, per week."""
    parts = [
        filters.options(sample, column, WEEK).withColumn("filter", F.lit(name))
        for name, column in filters.FILTER_COLUMNS.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).orderBy(WEEK, "filter", "option")

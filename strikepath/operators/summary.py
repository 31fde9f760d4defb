"""Weekly products of the contract panel. Each is one grouped pass over the features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.functions.aggregates import exact_mean, first_by, last_by, rows, sum_or_zero
from strikepath.operators.panel import order_column
from strikepath.roles import EVOLUTION_COLUMNS, keep_existing

# First values of the contract; text ones are keys of the first pass (see bars.ohlc_bars).
FIRST_FIXED = (
    "contract_open_time",
    "contract_close_time",
    "outcome_yes",
    "decision_found",
    "decision_time",
    "minutes_before_close_at_decision",
)
# Output columns in their given order.
DECISION_TIME_COLUMNS = (
    "ticker",
    "contract_open_time",
    "contract_close_time",
    "inferred_winner",
    "outcome_yes",
    "decision_found",
    "decision_time",
    "minutes_before_close_at_decision",
    "data_source_period",
)
CONTRACT = ("week_id", "ticker")


def contract_summary(features: DataFrame) -> DataFrame:
    """One row per contract: first attributes, first/last/extreme prices, sums and |z|."""
    at = order_column(features)
    texts = ("inferred_winner", "selected_futures_symbol")
    parts = features.groupBy(*CONTRACT, *texts).agg(
        F.min(at).alias("t0"),
        F.max(at).alias("t1"),
        *[first_by(c, at).alias(c) for c in FIRST_FIXED],
        first_by("underlying_value", at).alias("u0"),
        last_by("underlying_value", at).alias("u1"),
        first_by("kalshi_yes_price", at).alias("y0"),
        last_by("kalshi_yes_price", at).alias("y1"),
        F.max("kalshi_yes_price").alias("y_max"),
        F.min("kalshi_yes_price").alias("y_min"),
        F.sum("trade_count").alias("trades"),
        F.sum("trade_size").alias("size"),
        F.min("abs_z_bps").alias("z_min"),
        F.sum("abs_z_bps").alias("z_sum"),
        F.count("abs_z_bps").alias("z_n"),
    )
    return (
        parts.groupBy(*CONTRACT)
        .agg(
            *[first_by(c, "t0").alias(c) for c in FIRST_FIXED[:2]],
            first_by("inferred_winner", "t0").alias("inferred_winner"),
            *[first_by(c, "t0").alias(c) for c in FIRST_FIXED[2:]],
            first_by("selected_futures_symbol", "t0").alias("selected_futures_symbol"),
            first_by("u0", "t0").alias("underlying_open"),
            last_by("u1", "t1").alias("underlying_close"),
            first_by("y0", "t0").alias("yes_open_cents"),
            last_by("y1", "t1").alias("yes_close_cents"),
            F.max("y_max").alias("yes_max_cents"),
            F.min("y_min").alias("yes_min_cents"),
            sum_or_zero("trades").alias("total_trade_count"),
            sum_or_zero("size").alias("total_trade_size"),
            F.min("z_min").alias("min_abs_z_bps"),
            F.try_divide(F.sum("z_sum"), F.sum("z_n")).alias("mean_abs_z_bps"),
        )
        .withColumns(
            {
                "underlying_change": F.col("underlying_close") - F.col("underlying_open"),
                "yes_price_change": F.col("yes_close_cents") - F.col("yes_open_cents"),
            }
        )
    )


def decision_times(features: DataFrame) -> DataFrame:
    """One row per contract with its decision attributes, from its earliest row."""
    at = order_column(features)
    texts = [c for c in ("inferred_winner", "data_source_period") if c in features.columns]
    fixed = [c for c in FIRST_FIXED if c in features.columns]
    parts = features.groupBy(*CONTRACT, *texts).agg(
        F.min(at).alias("t0"), *[first_by(c, at).alias(c) for c in fixed]
    )
    firsts = parts.groupBy(*CONTRACT).agg(*[first_by(c, "t0").alias(c) for c in (*texts, *fixed)])
    return keep_existing(firsts, "week_id", *DECISION_TIME_COLUMNS)


def sensitivity_bins(features: DataFrame) -> DataFrame:
    """Mean 5-row moves per time and moneyness bucket, rows that have both moves."""
    return (
        features.where(F.col("yes_price_change_5s").isNotNull() & F.col("underlying_change_5s").isNotNull())
        .groupBy("week_id", "time_to_close_bucket", "moneyness_bucket")
        .agg(
            rows().alias("n_rows"),
            exact_mean("abs_yes_price_change_5s").alias("mean_abs_yes_price_change_5s"),
            exact_mean("yes_price_change_5s").alias("mean_yes_price_change_5s"),
            exact_mean("underlying_change_5s").alias("mean_underlying_change_5s"),
            exact_mean("abs_underlying_change_5s").alias("mean_abs_underlying_change_5s"),
            F.count_if("has_trade_this_second").alias("trade_seconds"),
        )
    )


def threshold_heatmap(features: DataFrame) -> DataFrame:
    """Mean absolute 5-row YES move per time and moneyness bucket."""
    return (
        features.where(F.col("abs_yes_price_change_5s").isNotNull())
        .groupBy("week_id", "time_to_close_bucket", "moneyness_bucket")
        .agg(
            rows().alias("n_rows"),
            exact_mean("abs_yes_price_change_5s").alias("mean_abs_yes_price_change_5s"),
            exact_mean("kalshi_yes_price").alias("mean_yes_price_cents"),
            exact_mean("abs_z_bps").alias("mean_abs_z_bps"),
        )
    )


def event_window_response(features: DataFrame, by_bucket: bool = True) -> DataFrame:
    """Mean path over the contract's life, per bucket or over all buckets."""
    keys = ("time_to_close_bucket", "moneyness_bucket") if by_bucket else ()
    return features.groupBy("week_id", "relative_second", *keys).agg(
        rows().alias("n_rows"),
        exact_mean("underlying_diff").alias("mean_underlying_diff"),
        exact_mean("underlying_bps_from_open").alias("mean_underlying_bps_from_open"),
        exact_mean("kalshi_yes_price").alias("mean_yes_price_cents"),
        exact_mean("kalshi_no_price").alias("mean_no_price_cents"),
        exact_mean("abs_z_bps").alias("mean_abs_z_bps"),
        F.count_if("has_trade_this_second").alias("trade_seconds"),
    )


def contract_evolution(features: DataFrame) -> DataFrame:
    """The panel columns kept for following single contracts."""
    return keep_existing(features, "week_id", *EVOLUTION_COLUMNS)


def distinct_counts(df: DataFrame, keys: Sequence[str], columns: Sequence[str], null_counts: Sequence[str] = ()) -> DataFrame:
    """Exact numbers of distinct values of several columns per group, as ``n_<column>``.

    Rows are reduced to the combinations that occur before anything is repeated per
    column, and each column's values are then reduced again, so every step merges
    in the map tasks and no group's values meet in one task. NULL is one more
    value for the columns in ``null_counts`` and none for the others.
    """
    combinations = df.groupBy(*keys, *columns).agg(rows().alias("_n")).where(F.col("_n") > 0)
    cells = F.array(*[F.struct(F.lit(c).alias("_column"), F.col(c).cast("string").alias("_value")) for c in columns])
    values = combinations.select(*keys, F.inline(cells)).groupBy(*keys, "_column", "_value").agg(rows().alias("_n"))
    counted = F.col("_value").isNotNull() | F.col("_column").isin(*null_counts)
    return values.groupBy(*keys).agg(*[F.count_if((F.col("_column") == c) & counted).alias(f"n_{c}") for c in columns])

"""The contract-by-second panel: short-horizon changes, buckets and their display forms."""

from __future__ import annotations

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F

from strikepath.functions import buckets, clock
from strikepath.operators.lookback import SLOT_ROWS, with_lookback

CONTRACT = ("week_start", "ticker")
LAGS = (1, 5)
UNIT_FACTORS = {"dollars": 100.0, "cents": 1.0, "as_is": 1.0}


def order_column(panel: DataFrame) -> str:
    """The finest time column: ``observed_at`` where kept, else ``second``."""
    return "observed_at" if "observed_at" in panel.columns else "second"


def with_week(panel: DataFrame) -> DataFrame:
    """Add the contract's week; rows without a close time belong to no week and go."""
    return panel.where(F.col("contract_close_time").isNotNull()).withColumn(
        "week_start", clock.week_start("contract_close_time")
    )


def _changes(df: DataFrame, window: WindowSpec) -> DataFrame:
    moves = {}
    for source, name in (("kalshi_yes_price", "yes_price"), ("underlying_value", "underlying")):
        for lag in LAGS:
            moves[f"{name}_change_{lag}s"] = F.col(source) - F.lag(source, lag).over(window)
    return df.withColumns(moves)


def with_changes(panel: DataFrame, slot_rows: int = SLOT_ROWS, sampled_from: DataFrame | None = None) -> DataFrame:
    """1- and 5-row changes of the YES price and the underlying, per contract.

    All four share one window, so one exchange and one sort. Rows of one moment are
    in order of the two values.
    """
    order = (order_column(panel), "kalshi_yes_price", "underlying_value")
    return with_lookback(panel, CONTRACT, order, max(LAGS), _changes, slot_rows, sampled_from)


def with_buckets(panel: DataFrame, price_unit: str = "dollars") -> DataFrame:
    """Moneyness, time-to-close and uncertainty labels.

    The 20-80 cent test is made in cents; ``price_unit="as_is"`` compares the
    stored number instead, as the original tables did.
    """
    factor = UNIT_FACTORS[price_unit]
    yes = F.col("kalshi_yes_price")
    return panel.withColumns(
        {
            "moneyness_bucket": buckets.moneyness_bucket("abs_z_bps"),
            "time_to_close_bucket": buckets.time_bucket("minutes_to_close"),
            "uncertainty_bucket": buckets.uncertainty_bucket(yes * factor if factor != 1.0 else yes),
        }
    )


def panel_features(
    panel: DataFrame,
    price_unit: str = "dollars",
    slot_rows: int = SLOT_ROWS,
    sampled_from: DataFrame | None = None,
) -> DataFrame:
    """The full feature table from which every weekly contract product is made."""
    cheaper = None if sampled_from is None else with_week(sampled_from)
    return with_buckets(with_changes(with_week(panel), slot_rows, cheaper), price_unit).withColumns(
        {
            "week_id": clock.week_id("week_start"),
            "yes_price_cents": F.col("kalshi_yes_price"),
            "no_price_cents": F.col("kalshi_no_price"),
            "abs_yes_price_change_5s": F.abs("yes_price_change_5s"),
            "abs_underlying_change_5s": F.abs("underlying_change_5s"),
        }
    )

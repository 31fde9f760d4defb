"""Attach actual trades to the panel."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.functions.aggregates import rows
from strikepath.functions.prices import share_pct
from strikepath.operators.skew import frequent_join

# Column names.
STRICT_COLUMNS = (
    "futures_last_trade_price_1s",
    "futures_trade_count_1s",
    "futures_trade_size_1s",
    "has_futures_trade_1s",
)
BY_SECOND_COLUMNS = (
    "underlying_trade_price",
    "underlying_trade_count",
    "underlying_trade_size",
    "underlying_trade_symbol",
    "has_underlying_trade_price",
)
SYMBOL_CANDIDATES = ("selected_futures_symbol", "futures_symbol", "symbol")


def symbol_column(df: DataFrame) -> str:
    for name in SYMBOL_CANDIDATES:
        if name in df.columns:
            return name
    raise ValueError("no futures symbol column")


def _telling_apart(panel: DataFrame) -> list[str]:
    """Columns that differ between the rows of one second."""
    return [c for c in ("ticker", "observed_at", "second") if c in panel.columns]


def attach_trades_strict(panel: DataFrame, bars: DataFrame) -> DataFrame:
    """Left join on (symbol, second); earlier results are dropped, so it can run again.

    ``bars`` has one row per key, so the panel cannot fan out. It comes grouped by
    that key, so rows of a busy second are dealt out here (``operators/skew.py``).
    """
    left = panel.drop(*STRICT_COLUMNS)
    right = bars.select("symbol", "second", *[c for c in STRICT_COLUMNS if c != "has_futures_trade_1s"])
    on = {symbol_column(left): "symbol", "second": "second"}
    return frequent_join(left, right, on, _telling_apart(left)).withColumns(
        {
            "futures_trade_count_1s": F.coalesce("futures_trade_count_1s", F.lit(0)),
            "futures_trade_size_1s": F.coalesce("futures_trade_size_1s", F.lit(0.0)),
            "has_futures_trade_1s": F.col("futures_last_trade_price_1s").isNotNull(),
        }
    )


def attach_trades_by_second(panel: DataFrame, bars: DataFrame, replace_strict: bool = False) -> DataFrame:
    """Left join on the second alone, whatever the symbol."""
    stale = BY_SECOND_COLUMNS + (STRICT_COLUMNS if replace_strict else ())
    left = panel.drop(*stale)
    return frequent_join(left, bars, {"second": "second"}, _telling_apart(left)).withColumn(
        "has_underlying_trade_price", F.col("underlying_trade_price").isNotNull()
    )


def with_trades_of_second(panel: DataFrame, bars: DataFrame) -> DataFrame:
    """The same for products that lie together by second (``sources/colocated.py``): a plain join, so that neither moves."""
    return panel.join(bars, "second", "left").withColumn(
        "has_underlying_trade_price", F.col("underlying_trade_price").isNotNull()
    )


def alias_strict_trades(panel: DataFrame) -> DataFrame:
    """Copy the strict columns that exist to the by-second names."""
    pairs = dict(zip(BY_SECOND_COLUMNS[:3], STRICT_COLUMNS[:3]))
    return panel.withColumns({new: F.col(old) for new, old in pairs.items() if old in panel.columns})


def match_rate(enriched: DataFrame, price: str, *keys: str) -> DataFrame:
    """Rows, rows that found a trade, and the percentage (0 when there are none)."""
    matched = F.count(price)
    return enriched.groupBy(*keys).agg(
        rows().alias("n_rows"), matched.alias("matched_rows"), share_pct(matched, rows()).alias("matched_pct")
    )


def known_values(datasets: dict[str, DataFrame], column: str) -> DataFrame:
    """Non-NULL count of one column per dataset and week."""
    parts = [
        df.groupBy("week_id").agg(F.count(column).alias("non_null")).select(F.lit(name).alias("dataset"), "*")
        for name, df in datasets.items()
        if column in df.columns
    ]
    combined = parts[0]
    for part in parts[1:]:
        combined = combined.unionByName(part)
    return combined

"""Attach trades to the panel products already written."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strikepath.operators import bars, enrich
from strikepath.sources.tables import read_product, rewrite_product

PRODUCTS = ("contract_evolution_1s", "contract_plot_sample")
ORDER = ("ticker", "second")


def by_second(panel: DataFrame, found: DataFrame) -> DataFrame:
    """Trades by second; strict columns of an earlier run, which would be stale, go."""
    return enrich.attach_trades_by_second(panel, found, replace_strict=True)


def build(spark: SparkSession, trades: DataFrame, root: str, strict: bool = False) -> DataFrame:
    """Rewrite both panel products with trade columns; return the match rate per week."""
    if strict:
        found, price = bars.trade_bars_by_symbol(trades), "futures_last_trade_price_1s"
        attach = enrich.attach_trades_strict
    else:
        found, price = bars.trade_bars(trades), "underlying_trade_price"
        attach = by_second
    for product in PRODUCTS:
        rewrite_product(spark, root, product, lambda panel: attach(panel, found), ORDER)
    return enrich.match_rate(read_product(spark, root, PRODUCTS[0]), price, "week_id")


def alias_build(spark: SparkSession, root: str) -> DataFrame:
    """Copy strict trade columns to the by-second names; return known prices per week."""
    for product in PRODUCTS:
        rewrite_product(spark, root, product, enrich.alias_strict_trades, ORDER)
    datasets = {p: read_product(spark, root, p) for p in PRODUCTS}
    return enrich.known_values(datasets, "underlying_trade_price")

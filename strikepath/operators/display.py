"""Data-dependent column choices, made per week as each week is its own dataset.

Every choice is a one-row-per-week aggregate joined back on the week, so plans
stay lazy and nothing is decided on the driver.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strikepath.functions.clock import parse_number
from strikepath.functions.prices import dollar_counters, dollars_by_counters, looks_like_dollars, merged_counters, quote_mid, quote_spread, snap

# Column names.
PRICE_COLUMNS = (
    "yes_price_cents",
    "no_price_cents",
    "yes_open_cents",
    "yes_close_cents",
    "yes_max_cents",
    "yes_min_cents",
    "mean_yes_price_cents",
    "mean_no_price_cents",
)
CHANGE_COLUMNS = (
    "yes_price_change",
    "yes_price_change_1s",
    "yes_price_change_5s",
    "abs_yes_price_change_5s",
    "mean_yes_price_change_5s",
    "mean_abs_yes_price_change_5s",
)
TRADE_PRICE_CANDIDATES = (
    "underlying_trade_price",
    "futures_trade_price",
    "trade_price",
    "last_trade_price",
    "trade_px",
    "last_price",
    "last_trade",
    "trade",
)
UNDERLYING_CANDIDATES = ("underlying_quote_mid", "underlying_modeling", "underlying_value")
DOLLAR_DISTANCES = (
    "distance_from_threshold_dollars",
    "threshold_distance_dollars",
    "underlying_distance_to_threshold",
    "distance_to_threshold",
    "threshold_distance",
)
DISTANCE_CANDIDATES = tuple((c, "Distance from threshold ($)", 50.0) for c in DOLLAR_DISTANCES) + (
    ("z_bps", "Distance from threshold (bps)", 10.0),
    ("abs_z_bps", "Absolute distance from threshold (bps)", 10.0),
)


def _present(df: DataFrame, names: Sequence[str]) -> list[str]:
    return [n for n in names if n in df.columns]


def per_week(df: DataFrame, facts: DataFrame) -> DataFrame:
    """Join one row of facts per week; the calendar bounds what is broadcast."""
    return df.join(F.broadcast(facts), "week_id", "left")


def unit_facts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Per week and column: is it in dollars?"""
    return df.groupBy("week_id").agg(*[looks_like_dollars(c).alias(c) for c in columns])


def price_multiplier(df: DataFrame, any_column: bool = False) -> DataFrame:
    """Per week: 100 if a price column is in dollars, else 1.

    ``any_column=True`` lets a change column decide too, as the original did; a
    table in cents whose moves are all small is then scaled by mistake.
    """
    columns = unit_columns(df, any_column)
    dollars = reduce(lambda a, b: a | b, [F.col(c) for c in columns])
    return unit_facts(df, columns).select("week_id", F.when(dollars, 100.0).otherwise(1.0).alias("multiplier"))


def with_display_prices(df: DataFrame, any_column: bool = False, decide_on: DataFrame | None = None) -> DataFrame:
    """Add ``<column>_display`` in cents for each price and change column.

    ``decide_on`` may be a cheaper frame with the same prices.
    """
    facts = price_multiplier(df if decide_on is None else decide_on, any_column)
    return in_cents(per_week(df, facts)).drop("multiplier")


def in_cents(df: DataFrame) -> DataFrame:
    """Add ``<column>_display`` for each price and change column by the row's ``multiplier``.

    A millionth of a cent is far below any price step; rounding there drops the
    noise of binary differences, so equal moves compare as equal.
    """
    names = _present(df, PRICE_COLUMNS + CHANGE_COLUMNS)
    return df.withColumns({f"{c}_display": snap(parse_number(c) * F.col("multiplier")) for c in names})


def path_facts(df: DataFrame, at: str) -> DataFrame:
    """Per contract: its unit's multiplier, its week's underlying series, the first value of that, and its close.

    One grouped pass; what a week decides is merged from its contracts.
    """
    names = _present(df, UNDERLYING_CANDIDATES)
    units = unit_columns(df)
    first = lambda value: F.min_by(value, F.when(value.isNotNull(), F.col(at)))
    parts = {f"_n_{n}": F.count(parse_number(n)) for n in names}
    parts |= {f"_s_{n}": first(parse_number(n)) for n in names}
    parts |= {f"_{c}_{k}": v for c in units for k, v in dollar_counters(c).items()}
    parts["close_marker"] = first(F.col("contract_close_time"))
    contracts = df.groupBy("week_id", "ticker").agg(*[v.alias(k) for k, v in parts.items()])
    dollars = [dollars_by_counters(merged_counters(lambda k, c=c: F.col(f"_{c}_{k}"))) for c in units]
    weeks = contracts.groupBy("week_id").agg(
        *[F.sum(f"_n_{n}").alias(f"_n_{n}") for n in names],
        F.when(reduce(lambda a, b: a | b, dollars, F.lit(False)), 100.0).otherwise(1.0).alias("multiplier"),
    )
    weeks = weeks.select("week_id", "multiplier", _first_filled(names).alias("underlying_source_column"))
    start = F.coalesce(*[F.when(F.col("underlying_source_column") == n, F.col(f"_s_{n}")) for n in names], F.lit(None).cast("double"))
    return per_week(contracts, weeks).select(
        "week_id", "ticker", "multiplier", "underlying_source_column", start.alias("start_underlying"), "close_marker"
    )


def chosen_series(df: DataFrame) -> Column:
    """The value of the row's ``underlying_source_column``."""
    return _value_of(F.col("underlying_source_column"), _present(df, UNDERLYING_CANDIDATES))


def unit_columns(df: DataFrame, any_column: bool = False) -> list[str]:
    """The columns that decide a table's unit: prices, or changes where it has no price."""
    price, change = _present(df, PRICE_COLUMNS), _present(df, CHANGE_COLUMNS)
    return price + change if any_column or not price else price


def _first_filled(names: Sequence[str], count: str = "_n_{}") -> Column:
    """First name whose week has any value (by its count column)."""
    return F.coalesce(*[F.when(F.col(count.format(n)) > 0, F.lit(n)) for n in names], F.lit(None).cast("string"))


def _value_of(choice: Column, names: Sequence[str]) -> Column:
    return F.coalesce(*[F.when(choice == n, parse_number(n)) for n in names], F.lit(None).cast("double"))


def chosen_column(df: DataFrame, candidates: Sequence[str], name: str) -> DataFrame:
    """Per week: the first candidate column that has any value."""
    present = _present(df, candidates)
    counts = df.groupBy("week_id").agg(*[F.count(parse_number(c)).alias(f"_n_{c}") for c in present])
    return counts.select("week_id", _first_filled(present).alias(name))


def with_underlying_columns(df: DataFrame) -> DataFrame:
    """Add the modelling value, the quote mid and spread, and the first usable trade price."""
    added = {}
    if "underlying_value" in df.columns:
        added["underlying_modeling"] = parse_number("underlying_value")
    if "best_bid" in df.columns and "best_ask" in df.columns:
        bid, ask = parse_number("best_bid"), parse_number("best_ask")
        added["underlying_quote_mid"] = quote_mid(bid, ask)
        if "quote_spread" not in df.columns:
            added["quote_spread"] = quote_spread(bid, ask)
    return with_trade_price(df.withColumns(added) if added else df)


def with_trade_price(df: DataFrame) -> DataFrame:
    """Set ``underlying_trade_price`` from the first candidate column with values."""
    present = _present(df, TRADE_PRICE_CANDIDATES)
    if not present:
        return df
    if present == ["underlying_trade_price"]:
        return df.withColumn("underlying_trade_price", parse_number("underlying_trade_price"))
    choice = chosen_column(df, present, "_trade_column")
    return (
        per_week(df, choice)
        .withColumn("underlying_trade_price", _value_of(F.col("_trade_column"), present))
        .drop("_trade_column")
    )


def with_underlying_series(df: DataFrame, decide_on: DataFrame | None = None) -> DataFrame:
    """Add ``underlying_series`` and its source: quote mid if the week has any, else a fallback."""
    names = _present(df, UNDERLYING_CANDIDATES)
    choice = chosen_column(df if decide_on is None else decide_on, names, "underlying_source_column")
    return per_week(df, choice).withColumn(
        "underlying_series", _value_of(F.col("underlying_source_column"), names)
    )


def with_distance_series(df: DataFrame, decide_on: DataFrame | None = None) -> DataFrame:
    """Add the distance to the strike (dollars if there are any, else bps), its band and a flag."""
    spec = {n: (label, band) for n, label, band in DISTANCE_CANDIDATES if n in df.columns}
    names = list(spec)
    choice = chosen_column(df if decide_on is None else decide_on, names, "distance_column")
    picked = F.col("distance_column")
    return (
        per_week(df, choice)
        .withColumns(
            {
                "distance": _value_of(picked, names),
                "distance_label": F.coalesce(*[F.when(picked == n, F.lit(spec[n][0])) for n in names]),
                "band": F.coalesce(*[F.when(picked == n, F.lit(spec[n][1])) for n in names]),
            }
        )
        .withColumn("in_band", F.abs("distance") <= F.col("band"))
    )

"""Role tables derived from the generic test tables.

The analytics read role tables (see ``roles``). Here ``events`` is reshaped into
each of them: an event is a futures quote, a user's week is a contract squeezed
into 15 model minutes, a signup is a listed market, a purchase is a trade.
Fields that come from upstream systems (decision time, winner, moneyness, label)
are made up from the same columns.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strikepath import roles
from strikepath.functions.aggregates import SOURCE_ROW, first_by, last_by, rows, tick_order
from strikepath.session import use_utc
from strikepath.sources import tables

WEEK_MICROS = 604_800_000_000
LIFE_SECONDS = 900
DECIDED_AT = 95
PERIOD_SPLIT = "2024-01-15"
#: Ticks of one moment are in the order of the file.
SOURCE_PLACE = T.StructField(SOURCE_ROW, T.LongType(), True)


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One source table, its zone-less timestamps read as UTC."""
    df = use_utc(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    zoneless = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in zoneless}) if zoneless else df


def _events(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Events with ``k`` and their week ``wk``; with their place in the file where asked."""
    events = load(spark, sf_dir, "events")
    return (tables.with_source_row(events) if placed else events).selectExpr(
        *([SOURCE_ROW] if placed else []),
        "event_id",
        "ts",
        "user_id",
        "event_type",
        "value",
        "cast(get_json_object(props, '$.k') AS int) AS k",
        "date_trunc('WEEK', ts) AS wk",
    )


def quotes(spark: SparkSession, sf_dir: str, placed: bool = False) -> DataFrame:
    """Events with the terms every role shares: ``k``, ``px``, ``wk``, ``w15``; with their place in the file where asked."""
    return _events(spark, sf_dir, placed).selectExpr(
        "*",
        "1e5 + value * 10 AS px",
        "timestamp_seconds(unix_seconds(ts) - pmod(unix_seconds(ts), 900)) AS w15",
    )


def micro_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = quotes(spark, sf_dir, placed=True).selectExpr(
        "ts AS timestamp",
        "event_type AS symbol",
        "px AS mid_price",
        "5 + k / 10 AS spread",
        "(5 + k / 10) / px * 1e4 AS spread_bps",
        "1 + k % 3 AS trade_count",
        "value AS trade_volume",
        "CASE WHEN k >= 10 THEN k / 100 END AS rv_60s",
        "CASE WHEN k < 10 THEN NULL WHEN k < 40 THEN 'low' WHEN k < 70 THEN 'mid' ELSE 'high' END AS vol_regime",
        "value > 150 AS event_large_move",
        "source_row",
    )
    return roles.conform(df, T.StructType([*roles.MICRO_1S.fields, SOURCE_PLACE]))


def markets(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = (
        quotes(spark, sf_dir)
        .where("event_type = 'signup'")
        .selectExpr(
            "concat('M', event_id) AS ticker",
            "concat('E', user_id) AS event_ticker",
            "'BTC above strike' AS title",
            "'15 minutes' AS subtitle",
            "w15 AS open_time",
            "w15 + INTERVAL 15 MINUTES AS close_time",
            "1e5 + 10 * k AS floor_strike",
            "'greater' AS strike_type",
            "k % 2 AS result_binary",
            "k / 100 AS last_price",
            "(k + 1) / 100 AS yes_ask",
            "(k - 1) / 100 AS yes_bid",
            "2e-2 AS spread",
            "value AS volume",
            "k * 2 AS open_interest",
            "value * 3 AS liquidity",
            "'day' AS session",
            "CASE WHEN k < 50 THEN 'low' ELSE 'high' END AS price_bucket",
        )
    )
    return roles.conform(df, roles.MARKETS)


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = (
        quotes(spark, sf_dir, placed=True)
        .where("event_type = 'click'")
        .groupBy(F.col("w15").alias("window_start"))
        .agg(
            first_by("px", tick_order("ts", "px", (SOURCE_ROW,))).alias("decision_price"),
            last_by("px", tick_order("ts", "px", (SOURCE_ROW,))).alias("close_price"),
            rows().alias("n"),
        )
        .selectExpr(
            "window_start",
            "window_start + INTERVAL 15 MINUTES AS window_end",
            "window_start + INTERVAL 10 MINUTES AS decision_point",
            "window_start + INTERVAL 14 MINUTES AS close_start",
            "decision_price",
            "close_price",
            "n = 1 AS has_gap",
            "close_price - decision_price AS price_change",
            "(close_price - decision_price) / decision_price * 100 AS price_change_pct",
            "cast(close_price - decision_price > 0 AS int) AS label",
        )
    )
    return roles.conform(df, roles.LABELS)


def _panel_base(events: DataFrame, *further: str) -> DataFrame:
    """Panel columns that come straight from one event, and ``further`` ones as they are."""
    return (
        events.selectExpr("*", "1e5 + value * 10 AS px", "unix_micros(ts) - unix_micros(wk) AS elapsed")
        .selectExpr("*", f"({WEEK_MICROS} - elapsed) * {LIFE_SECONDS}e0 / {WEEK_MICROS} AS left_s", "px - 100500 AS gap")
        .selectExpr(
            "concat('C', user_id, '-', date_format(wk, 'yyyyMMdd')) AS ticker",
            "date_trunc('SECOND', ts) AS second",
            f"(elapsed * {LIFE_SECONDS}) div {WEEK_MICROS} AS relative_second",
            "floor(left_s) AS seconds_to_close",
            "left_s / 60 AS minutes_to_close",
            "wk AS contract_open_time",
            "wk + INTERVAL 7 DAYS - INTERVAL 1 SECOND AS contract_close_time",
            "event_type AS selected_futures_symbol",
            "event_type AS futures_symbol",
            "'futures_mid' AS underlying_source",
            "px AS underlying_value",
            "100500e0 AS reference_underlying",
            "gap AS underlying_diff",
            "px / 100500 - 1 AS underlying_return_from_open",
            "gap / 100500 * 1e4 AS underlying_bps_from_open",
            "k / 1e4 AS underlying_return_1s",
            "ln(px / 100500) AS log_moneyness",
            "gap / 1000 AS z_moneyness",
            "gap / 100500 * 1e4 AS z_bps",
            "abs(gap / 100500 * 1e4) AS abs_z_bps",
            "left_s AS time_to_close_seconds",
            f"left_s / {LIFE_SECONDS} AS time_to_close_frac_15m",
            "k AS yes_state_cents",
            "100 - k AS no_state_cents",
            "k / 100 AS kalshi_yes_price",
            "1 - k / 100 AS kalshi_no_price",
            "least(greatest(k / 100, 1e-2), 99e-2) AS kalshi_yes_price_clipped",
            "1 + k % 3 AS trade_count",
            "value AS trade_size",
            "event_type = 'purchase' AS has_trade_this_second",
            "CASE user_id % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' END AS inferred_winner",
            "CASE user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS outcome_yes",
            "true AS has_underlying",
            "true AS underlying_path_complete",
            "true AS has_futures_observation",
            "k % 10 AS seconds_since_last_futures_update",
            "k % 10 > 5 AS is_futures_stale",
            "px - (5 + k / 10) / 2 AS best_bid",
            "px + (5 + k / 10) / 2 AS best_ask",
            "5 + k / 10 AS spread",
            "(5 + k / 10) / px * 1e4 AS spread_bps",
            "true AS is_valid_spread",
            f"CASE WHEN ts < timestamp '{PERIOD_SPLIT}' THEN 'early' ELSE 'late' END AS data_source_period",
            "ts AS observed_at",
            "wk",
            *further,
        )
    )


OBSERVED_AT = T.StructField("observed_at", T.TimestampType(), True)
PANEL = T.StructType([*roles.CONTRACT_1S.fields, OBSERVED_AT])
DECISION_COLUMNS = ("decision_found", "decision_time", "minutes_before_close_at_decision", "is_after_decision")
QUOTE_PANEL = T.StructType([f for f in PANEL.fields if f.name not in DECISION_COLUMNS])


def contract_quotes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The panel without its decision columns: one scan, no join."""
    return roles.conform(_panel_base(_events(spark, sf_dir)), QUOTE_PANEL)


def contract_1s(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole panel. ``observed_at`` orders rows that share a second.

    Events meet their decision as they are read and get the panel's columns after
    it, so the exchange carries six short columns and not fifty. Events without a
    user or a time match nothing and are dealt over all tasks. The decisions have
    an exchange of their own, which lets adaptive execution split a large contract.
    """
    keyless = F.col("user_id").isNull() | F.col("wk").isNull()
    events = _events(spark, sf_dir).withColumn(
        "deal", F.when(keyless, F.xxhash64("event_id", "user_id", "ts", "value", "event_type")).otherwise(0)
    )
    decided = (
        events.where(F.col("k") >= DECIDED_AT)
        .groupBy("user_id", "wk")
        .agg(F.min("ts").alias("decision_time"), F.min("deal").alias("deal"))
    )
    df = (
        _panel_base(events.join(decided, ["user_id", "wk", "deal"], "left"), "decision_time")
        .selectExpr(
            "*",
            "decision_time IS NOT NULL AS decision_found",
            f"({WEEK_MICROS} - (unix_micros(decision_time) - unix_micros(wk))) * {LIFE_SECONDS}e0 / {WEEK_MICROS} / 60"
            " AS minutes_before_close_at_decision",
            "coalesce(observed_at >= decision_time, false) AS is_after_decision",
        )
    )
    return roles.conform(df, PANEL)


def trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = (
        quotes(spark, sf_dir, placed=True)
        .where("event_type = 'purchase'")
        .selectExpr("ts AS ts_event", "px AS price", "1 + k % 5 AS size", "event_type AS symbol", "source_row")
    )
    return roles.conform(df, T.StructType([*roles.TRADES.fields, SOURCE_PLACE]))

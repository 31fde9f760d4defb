"""Column contracts of the role tables and the projection that enforces them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

STRING, DOUBLE, LONG, INT = T.StringType(), T.DoubleType(), T.LongType(), T.IntegerType()
BOOL, TIME, DATE = T.BooleanType(), T.TimestampType(), T.DateType()


def schema(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


# The column names and types of the data model.
MICRO_1S = schema(
    ("timestamp", TIME),
    ("symbol", STRING),
    ("mid_price", DOUBLE),
    ("spread", DOUBLE),
    ("spread_bps", DOUBLE),
    ("trade_count", LONG),
    ("trade_volume", DOUBLE),
    ("rv_60s", DOUBLE),
    ("vol_regime", STRING),
    ("event_large_move", BOOL),
)

MARKETS = schema(
    ("ticker", STRING),
    ("event_ticker", STRING),
    ("title", STRING),
    ("subtitle", STRING),
    ("open_time", TIME),
    ("close_time", TIME),
    ("floor_strike", DOUBLE),
    ("strike_type", STRING),
    ("result_binary", INT),
    ("last_price", DOUBLE),
    ("yes_ask", DOUBLE),
    ("yes_bid", DOUBLE),
    ("spread", DOUBLE),
    ("volume", DOUBLE),
    ("open_interest", DOUBLE),
    ("liquidity", DOUBLE),
    ("session", STRING),
    ("price_bucket", STRING),
)

LABELS = schema(
    ("window_start", TIME),
    ("window_end", TIME),
    ("decision_point", TIME),
    ("close_start", TIME),
    ("decision_price", DOUBLE),
    ("close_price", DOUBLE),
    ("has_gap", BOOL),
    ("price_change", DOUBLE),
    ("price_change_pct", DOUBLE),
    ("label", INT),
)

CONTRACT_1S = schema(
    ("ticker", STRING),
    ("second", TIME),
    ("relative_second", LONG),
    ("seconds_to_close", LONG),
    ("minutes_to_close", DOUBLE),
    ("contract_open_time", TIME),
    ("contract_close_time", TIME),
    ("selected_futures_symbol", STRING),
    ("futures_symbol", STRING),
    ("underlying_source", STRING),
    ("underlying_value", DOUBLE),
    ("reference_underlying", DOUBLE),
    ("underlying_diff", DOUBLE),
    ("underlying_return_from_open", DOUBLE),
    ("underlying_bps_from_open", DOUBLE),
    ("underlying_return_1s", DOUBLE),
    ("log_moneyness", DOUBLE),
    ("z_moneyness", DOUBLE),
    ("z_bps", DOUBLE),
    ("abs_z_bps", DOUBLE),
    ("time_to_close_seconds", DOUBLE),
    ("time_to_close_frac_15m", DOUBLE),
    ("yes_state_cents", DOUBLE),
    ("no_state_cents", DOUBLE),
    ("kalshi_yes_price", DOUBLE),
    ("kalshi_no_price", DOUBLE),
    ("kalshi_yes_price_clipped", DOUBLE),
    ("trade_count", LONG),
    ("trade_size", DOUBLE),
    ("has_trade_this_second", BOOL),
    ("inferred_winner", STRING),
    ("outcome_yes", INT),
    ("decision_found", BOOL),
    ("decision_time", TIME),
    ("minutes_before_close_at_decision", DOUBLE),
    ("is_after_decision", BOOL),
    ("has_underlying", BOOL),
    ("underlying_path_complete", BOOL),
    ("has_futures_observation", BOOL),
    ("seconds_since_last_futures_update", DOUBLE),
    ("is_futures_stale", BOOL),
    ("best_bid", DOUBLE),
    ("best_ask", DOUBLE),
    ("spread", DOUBLE),
    ("spread_bps", DOUBLE),
    ("is_valid_spread", BOOL),
    ("data_source_period", STRING),
)

TRADES = schema(("ts_event", TIME), ("price", DOUBLE), ("size", DOUBLE), ("symbol", STRING))

WEEK_INDEX = schema(("week_id", STRING), ("week_label", STRING), ("week_start", DATE), ("week_path", STRING))

METRICS = schema(("metric", STRING), ("value", DOUBLE))

EVOLUTION_COLUMNS = (
    "ticker",
    "second",
    "relative_second",
    "seconds_to_close",
    "minutes_to_close",
    "contract_open_time",
    "contract_close_time",
    "selected_futures_symbol",
    "underlying_value",
    "reference_underlying",
    "underlying_diff",
    "underlying_return_1s",
    "z_bps",
    "abs_z_bps",
    "moneyness_bucket",
    "yes_price_cents",
    "no_price_cents",
    "yes_price_change_1s",
    "yes_price_change_5s",
    "underlying_change_1s",
    "underlying_change_5s",
    "has_trade_this_second",
    "trade_count",
    "trade_size",
    "inferred_winner",
    "outcome_yes",
    "decision_found",
    "decision_time",
    "minutes_before_close_at_decision",
    "is_after_decision",
    "best_bid",
    "best_ask",
    "spread",
    "spread_bps",
    "time_to_close_bucket",
    "uncertainty_bucket",
    "data_source_period",
)


def conform(df: DataFrame, contract: T.StructType, required: tuple[str, ...] | None = None) -> DataFrame:
    """Project ``df`` onto ``contract``: bad values become NULL, NaN becomes NULL.

    A missing column is an error when it is required (by default every one is);
    otherwise it is added as a typed NULL.
    """
    needed = set(contract.names if required is None else required)
    missing = sorted(name for name in needed if name not in df.columns)
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")
    present = {field.name: field.dataType for field in df.schema}
    return df.selectExpr(*[_cell(field, present.get(field.name)) for field in contract])


def _cell(field: T.StructField, found: T.DataType | None) -> str:
    name, kind = f"`{field.name}`", field.dataType.simpleString()
    if found is None:
        return f"cast(NULL AS {kind}) AS {name}"
    value = name if found == field.dataType else f"try_cast({name} AS {kind})"
    # Whole numbers cannot become NaN.
    if isinstance(field.dataType, T.DoubleType) and not isinstance(found, T.IntegralType):
        value = f"CASE WHEN NOT isnan({value}) THEN {value} END"
    return f"{value} AS {name}"


def keep_existing(df: DataFrame, *names: str) -> DataFrame:
    """Project the named columns that the frame has, in the order asked for."""
    return df.select(*[name for name in names if name in df.columns])

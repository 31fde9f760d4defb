"""SQL for every deterministic query, written for DuckDB over the same parquet tables.

``VIEWS`` holds the role tables and shared steps as named sub-queries; a query
text is prefixed with those it names. ``pick`` writes the final column list in
the output form of ``present``: ``:i`` bigint, ``:d`` double at six places,
``:t`` timestamp, ``:day`` date as text, no mark for text and booleans.
"""

from __future__ import annotations

import re

from strikepath.catalog.present import SPARSE_COUNTS
from strikepath.roles import EVOLUTION_COLUMNS

ORACLE_SQL: dict[str, str] = {}

VIEWS: dict[str, str] = {
    "ev": """
        SELECT event_id, ts, user_id, event_type, value,
               CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS INTEGER) AS k,
               100000e0 + value * 10 AS px, date_trunc('week', ts) AS wk,
               time_bucket(INTERVAL 15 MINUTE, ts) AS w15
        FROM events""",
    "micro": """
        SELECT ts, event_type AS symbol, px AS mid_price, 5 + k / 10e0 AS spread,
               (5 + k / 10e0) / px * 1e4 AS spread_bps, 1 + k % 3 AS trade_count, value AS trade_volume,
               CASE WHEN k >= 10 THEN k / 100e0 END AS rv_60s,
               CASE WHEN k < 10 THEN NULL WHEN k < 40 THEN 'low' WHEN k < 70 THEN 'mid' ELSE 'high' END AS vol_regime,
               value > 150 AS event_large_move
        FROM ev""",
    "mk": """
        SELECT 'M' || event_id AS ticker, 'E' || user_id AS event_ticker, 'BTC above strike' AS title,
               '15 minutes' AS subtitle, w15 AS open_time, w15 + INTERVAL 15 MINUTE AS close_time,
               100000e0 + 10 * k AS floor_strike, 'greater' AS strike_type, k % 2 AS result_binary,
               k / 100e0 AS last_price, (k + 1) / 100e0 AS yes_ask, (k - 1) / 100e0 AS yes_bid, 0.02e0 AS spread,
               value AS volume, k * 2e0 AS open_interest, value * 3 AS liquidity, 'day' AS session,
               CASE WHEN k < 50 THEN 'low' ELSE 'high' END AS price_bucket,
               k / 100e0 * 100 AS last_price_cents, (k + 1) / 100e0 * 100 AS yes_ask_cents,
               (k - 1) / 100e0 * 100 AS yes_bid_cents, 0.02e0 * 100 AS spread_cents,
               ((k + 1) / 100e0 + (k - 1) / 100e0) / 2 * 100 AS yes_mid_cents,
               date_trunc('week', w15 + INTERVAL 15 MINUTE) AS week_start,
               strftime(w15 + INTERVAL 15 MINUTE, '%Y-%m-%d') AS close_date
        FROM ev WHERE event_type = 'signup'""",
    "lab": """
        SELECT w15 AS window_start, w15 + INTERVAL 15 MINUTE AS window_end, w15 + INTERVAL 10 MINUTE AS decision_point,
               w15 + INTERVAL 14 MINUTE AS close_start, arg_min(px, ts) AS decision_price, arg_max(px, ts) AS close_price,
               count(*) = 1 AS has_gap, arg_max(px, ts) - arg_min(px, ts) AS price_change,
               (arg_max(px, ts) - arg_min(px, ts)) / arg_min(px, ts) * 100 AS price_change_pct,
               CASE WHEN arg_max(px, ts) - arg_min(px, ts) > 0 THEN 1 ELSE 0 END AS label,
               date_trunc('week', w15) AS week_start, 900 AS window_seconds, 300 AS seconds_from_decision_to_end,
               60 AS seconds_from_close_start_to_end
        FROM ev WHERE event_type = 'click' GROUP BY w15""",
    "decided": """
        SELECT user_id, wk, min(ts) AS decision_time FROM ev WHERE k >= 95 GROUP BY user_id, wk""",
    "panel": """
        SELECT 'C' || e.user_id || '-' || strftime(e.wk, '%Y%m%d') AS ticker, date_trunc('second', e.ts) AS second,
               e.ts AS observed_at,
               ((epoch_us(e.ts) - epoch_us(e.wk)) * 900) // 604800000000 AS relative_second,
               floor(left_s) AS seconds_to_close, left_s / 60 AS minutes_to_close,
               e.wk AS contract_open_time, e.wk + INTERVAL 7 DAY - INTERVAL 1 SECOND AS contract_close_time,
               event_type AS selected_futures_symbol, event_type AS futures_symbol, 'futures_mid' AS underlying_source,
               px AS underlying_value, 100500e0 AS reference_underlying, px - 100500 AS underlying_diff,
               px / 100500 - 1 AS underlying_return_from_open, (px - 100500) / 100500 * 1e4 AS underlying_bps_from_open,
               k / 1e4 AS underlying_return_1s, ln(px / 100500) AS log_moneyness, (px - 100500) / 1000 AS z_moneyness,
               (px - 100500) / 100500 * 1e4 AS z_bps, abs((px - 100500) / 100500 * 1e4) AS abs_z_bps,
               left_s AS time_to_close_seconds, left_s / 900 AS time_to_close_frac_15m,
               k AS yes_state_cents, 100 - k AS no_state_cents,
               k / 100e0 AS kalshi_yes_price, 1 - k / 100e0 AS kalshi_no_price,
               least(greatest(k / 100e0, 0.01e0), 0.99e0) AS kalshi_yes_price_clipped,
               1 + k % 3 AS trade_count, value AS trade_size, event_type = 'purchase' AS has_trade_this_second,
               CASE e.user_id % 3 WHEN 0 THEN 'YES' WHEN 1 THEN 'NO' END AS inferred_winner,
               CASE e.user_id % 3 WHEN 0 THEN 1 WHEN 1 THEN 0 END AS outcome_yes,
               decision_time IS NOT NULL AS decision_found, decision_time,
               (604800000000 - (epoch_us(decision_time) - epoch_us(e.wk))) * 900e0 / 604800000000 / 60
                   AS minutes_before_close_at_decision,
               coalesce(e.ts >= decision_time, false) AS is_after_decision,
               true AS has_underlying, true AS underlying_path_complete, true AS has_futures_observation,
               k % 10 AS seconds_since_last_futures_update, k % 10 > 5 AS is_futures_stale,
               px - (5 + k / 10e0) / 2 AS best_bid, px + (5 + k / 10e0) / 2 AS best_ask,
               5 + k / 10e0 AS spread, (5 + k / 10e0) / px * 1e4 AS spread_bps, true AS is_valid_spread,
               CASE WHEN e.ts < TIMESTAMP '2024-01-15' THEN 'early' ELSE 'late' END AS data_source_period
        FROM (SELECT *, (604800000000 - (epoch_us(ts) - epoch_us(wk))) * 900e0 / 604800000000 AS left_s FROM ev) e
        LEFT JOIN decided d ON e.user_id = d.user_id AND e.wk = d.wk""",
    "trd": """
        SELECT ts AS ts_event, px AS price, 1 + k % 5 AS size, event_type AS symbol FROM ev WHERE event_type = 'purchase'""",
    "bars": """
        SELECT time_bucket(INTERVAL 15 MINUTE, ts) AS window_start, symbol, date_trunc('week', ts) AS week_start,
               min(ts) AS first_timestamp, max(ts) AS last_timestamp,
               arg_min(mid_price, ts) AS futures_open, arg_max(mid_price, ts) AS futures_close,
               max(mid_price) AS futures_high, min(mid_price) AS futures_low,
               avg(spread) AS spread_mean, avg(spread_bps) AS spread_bps_mean,
               sum(trade_count) AS trade_count_sum, sum(trade_volume) AS trade_volume_sum,
               avg(rv_60s) AS rv_60s_mean, count(*) FILTER (event_large_move) AS large_move_rows,
               arg_max(vol_regime, ts) AS vol_regime,
               arg_max(mid_price, ts) - arg_min(mid_price, ts) AS futures_change,
               (arg_max(mid_price, ts) - arg_min(mid_price, ts)) / arg_min(mid_price, ts) * 100 AS futures_return_pct
        FROM micro GROUP BY 1, 2, 3""",
    "sym": "SELECT week_start, symbol, count(*) AS rows FROM bars GROUP BY 1, 2",
    "dom": """
        SELECT week_start, symbol AS dominant_symbol, rows AS dominant_symbol_rows FROM sym
        QUALIFY row_number() OVER (PARTITION BY week_start ORDER BY rows DESC, symbol) = 1""",
    "lead_bars": """
        SELECT b.* FROM bars b JOIN dom d ON b.week_start = d.week_start AND b.symbol = d.dominant_symbol""",
    "behavior": """
        SELECT l.*, b.* EXCLUDE (window_start, week_start),
               CASE WHEN l.label = 1 THEN 'Up / YES-like' ELSE 'Down / NO-like' END AS window_direction,
               CASE WHEN l.price_change >= 0 THEN 'Up' ELSE 'Down' END AS futures_direction
        FROM lab l LEFT JOIN lead_bars b ON l.window_start = b.window_start AND l.week_start = b.week_start""",
    "keyed": """
        SELECT *, time_bucket(INTERVAL 15 MINUTE, close_time - INTERVAL 15 MINUTE) AS window_start FROM mk""",
    "tm": """
        SELECT m.*, b.* EXCLUDE (window_start, week_start),
               futures_close - floor_strike AS distance_to_threshold,
               abs(futures_close - floor_strike) AS abs_distance_to_threshold,
               (futures_close - floor_strike) / futures_close * 10000 AS distance_to_threshold_bps,
               CASE WHEN abs(futures_close - floor_strike) <= 25 THEN '±$25'
                    WHEN abs(futures_close - floor_strike) <= 50 THEN '±$50'
                    WHEN abs(futures_close - floor_strike) <= 100 THEN '±$100'
                    WHEN abs(futures_close - floor_strike) <= 250 THEN '±$250'
                    ELSE 'Outside ±$250' END AS threshold_band
        FROM keyed m LEFT JOIN lead_bars b
          ON m.window_start = b.window_start AND date_trunc('week', m.window_start) = b.week_start""",
    "feat": """
        SELECT *, date_trunc('week', contract_close_time) AS week_start,
               strftime(date_trunc('week', contract_close_time), '%Y-%m-%d') AS week_id,
               kalshi_yes_price AS yes_price_cents, kalshi_no_price AS no_price_cents,
               kalshi_yes_price - lag(kalshi_yes_price, 1) OVER c AS yes_price_change_1s,
               kalshi_yes_price - lag(kalshi_yes_price, 5) OVER c AS yes_price_change_5s,
               underlying_value - lag(underlying_value, 1) OVER c AS underlying_change_1s,
               underlying_value - lag(underlying_value, 5) OVER c AS underlying_change_5s,
               abs(kalshi_yes_price - lag(kalshi_yes_price, 5) OVER c) AS abs_yes_price_change_5s,
               abs(underlying_value - lag(underlying_value, 5) OVER c) AS abs_underlying_change_5s,
               CASE WHEN abs_z_bps <= 5 THEN 'Very near' WHEN abs_z_bps <= 10 THEN 'Near'
                    WHEN abs_z_bps <= 25 THEN 'Moderate' WHEN abs_z_bps <= 50 THEN 'Far' ELSE 'Very far' END
                   AS moneyness_bucket,
               CASE WHEN minutes_to_close <= 1 THEN '0-1m' WHEN minutes_to_close <= 2 THEN '1-2m'
                    WHEN minutes_to_close <= 3 THEN '2-3m' WHEN minutes_to_close <= 5 THEN '3-5m'
                    WHEN minutes_to_close <= 7 THEN '5-7m' WHEN minutes_to_close <= 10 THEN '7-10m'
                    ELSE '10-15m' END AS time_to_close_bucket,
               CASE WHEN kalshi_yes_price * 100 BETWEEN 20 AND 80 THEN 'Uncertain 20-80c' ELSE 'Mostly decided' END
                   AS uncertainty_bucket,
               CASE WHEN kalshi_yes_price BETWEEN 20 AND 80 THEN 'Uncertain 20-80c' ELSE 'Mostly decided' END
                   AS uncertainty_as_is
        FROM panel
        WINDOW c AS (PARTITION BY ticker ORDER BY observed_at)""",
    "dec": """
        SELECT week_id, ticker, contract_open_time, contract_close_time, inferred_winner, outcome_yes, decision_found,
               decision_time, minutes_before_close_at_decision, data_source_period
        FROM feat QUALIFY row_number() OVER (PARTITION BY week_id, ticker ORDER BY observed_at) = 1""",
    "yes_dec": "SELECT * FROM dec WHERE decision_found",
    "csum": """
        SELECT week_id, ticker, arg_min_null(contract_open_time, observed_at) AS contract_open_time,
               arg_min_null(contract_close_time, observed_at) AS contract_close_time,
               arg_min_null(inferred_winner, observed_at) AS inferred_winner,
               arg_min_null(outcome_yes, observed_at) AS outcome_yes,
               arg_min_null(decision_found, observed_at) AS decision_found,
               arg_min_null(decision_time, observed_at) AS decision_time,
               arg_min_null(minutes_before_close_at_decision, observed_at) AS minutes_before_close_at_decision,
               arg_min_null(selected_futures_symbol, observed_at) AS selected_futures_symbol,
               arg_min_null(underlying_value, observed_at) AS underlying_open,
               arg_max_null(underlying_value, observed_at) AS underlying_close,
               arg_min_null(kalshi_yes_price, observed_at) AS yes_open_cents,
               arg_max_null(kalshi_yes_price, observed_at) AS yes_close_cents,
               max(kalshi_yes_price) AS yes_max_cents, min(kalshi_yes_price) AS yes_min_cents,
               sum(trade_count) AS total_trade_count, sum(trade_size) AS total_trade_size,
               min(abs_z_bps) AS min_abs_z_bps, avg(abs_z_bps) AS mean_abs_z_bps,
               arg_max_null(underlying_value, observed_at) - arg_min_null(underlying_value, observed_at)
                   AS underlying_change,
               arg_max_null(kalshi_yes_price, observed_at) - arg_min_null(kalshi_yes_price, observed_at)
                   AS yes_price_change
        FROM feat GROUP BY week_id, ticker""",
    "bins": """
        SELECT week_id, time_to_close_bucket, moneyness_bucket, count(*) AS n_rows,
               CAST(sum(CAST(CAST(abs_yes_price_change_5s AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(abs_yes_price_change_5s) AS mean_abs_yes_price_change_5s,
               CAST(sum(CAST(CAST(yes_price_change_5s AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(yes_price_change_5s) AS mean_yes_price_change_5s,
               CAST(sum(CAST(CAST(underlying_change_5s AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(underlying_change_5s) AS mean_underlying_change_5s,
               CAST(sum(CAST(CAST(abs_underlying_change_5s AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(abs_underlying_change_5s) AS mean_abs_underlying_change_5s,
               count(*) FILTER (has_trade_this_second) AS trade_seconds
        FROM feat WHERE yes_price_change_5s IS NOT NULL AND underlying_change_5s IS NOT NULL GROUP BY 1, 2, 3""",
    "heat": """
        SELECT week_id, time_to_close_bucket, moneyness_bucket, count(*) AS n_rows,
               CAST(sum(CAST(CAST(abs_yes_price_change_5s AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(abs_yes_price_change_5s) AS mean_abs_yes_price_change_5s,
               CAST(sum(CAST(CAST(kalshi_yes_price AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(kalshi_yes_price) AS mean_yes_price_cents, CAST(sum(CAST(CAST(abs_z_bps AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(abs_z_bps) AS mean_abs_z_bps
        FROM feat WHERE abs_yes_price_change_5s IS NOT NULL GROUP BY 1, 2, 3""",
    "sec_trades": """
        SELECT date_trunc('second', ts_event) AS second, arg_max(price, ts_event) AS underlying_trade_price,
               count(*) AS underlying_trade_count, sum(size) AS underlying_trade_size,
               arg_max(symbol, ts_event) AS underlying_trade_symbol
        FROM trd GROUP BY 1""",
    "sym_trades": """
        SELECT symbol, date_trunc('second', ts_event) AS second, arg_max(price, ts_event) AS futures_last_trade_price_1s,
               count(*) AS futures_trade_count_1s, sum(size) AS futures_trade_size_1s
        FROM trd GROUP BY 1, 2""",
    "strict": """
        SELECT f.*, s.futures_last_trade_price_1s, coalesce(s.futures_trade_count_1s, 0) AS futures_trade_count_1s,
               coalesce(s.futures_trade_size_1s, 0) AS futures_trade_size_1s,
               s.futures_last_trade_price_1s IS NOT NULL AS has_futures_trade_1s
        FROM feat f LEFT JOIN sym_trades s ON f.selected_futures_symbol = s.symbol AND f.second = s.second""",
    "bysec": """
        SELECT f.*, s.underlying_trade_price, s.underlying_trade_count, s.underlying_trade_size,
               s.underlying_trade_symbol, s.underlying_trade_price IS NOT NULL AS has_underlying_trade_price
        FROM feat f LEFT JOIN sec_trades s ON f.second = s.second""",
    "unit": """
        SELECT week_id, CASE WHEN quantile_cont(abs(yes_price_cents), 0.99) <= 1.5
                               OR quantile_cont(abs(no_price_cents), 0.99) <= 1.5 THEN 100e0 ELSE 1e0 END AS m
        FROM feat GROUP BY 1""",
    "moved": """
        SELECT f.*, floor((yes_price_cents * m) * 1e6 + 0.5e0) / 1e6 AS yes_price_cents_display,
               floor((no_price_cents * m) * 1e6 + 0.5e0) / 1e6 AS no_price_cents_display,
               floor((yes_price_change_1s * m) * 1e6 + 0.5e0) / 1e6 AS yes_price_change_1s_display,
               floor((yes_price_change_5s * m) * 1e6 + 0.5e0) / 1e6 AS yes_price_change_5s_display,
               abs(floor((yes_price_change_5s * m) * 1e6 + 0.5e0) / 1e6) AS abs_yes_price_change_5s_display
        FROM feat f JOIN unit USING (week_id)""",
    "both_moved": """
        SELECT * FROM moved WHERE yes_price_change_1s IS NOT NULL AND yes_price_change_5s IS NOT NULL""",
    "per_sec": """
        SELECT week_id, second, CAST(sum(CAST(CAST((best_bid + best_ask) / 2 AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count((best_bid + best_ask) / 2) AS underlying, CAST(sum(CAST(CAST(spread AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(spread) AS spread,
               CAST(sum(CAST(CAST(spread_bps AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(spread_bps) AS spread_bps, CAST(sum(CAST(CAST(best_ask - best_bid AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(best_ask - best_bid) AS quote_spread,
               sum(trade_count) AS trade_count, sum(trade_size) AS trade_size
        FROM feat GROUP BY 1, 2""",
    "returns": """
        SELECT *, underlying - lag(underlying) OVER w AS underlying_change_1s,
               ln(underlying / lag(underlying) OVER w) * 10000 AS underlying_return_1s_bps
        FROM per_sec WINDOW w AS (PARTITION BY week_id ORDER BY second)""",
    "vol": """
        SELECT *, CASE WHEN count(underlying_return_1s_bps) OVER w >= 20
                       THEN stddev_samp(underlying_return_1s_bps) OVER w END AS local_vol_60s_bps
        FROM returns WINDOW w AS (PARTITION BY week_id ORDER BY second ROWS BETWEEN 59 PRECEDING AND CURRENT ROW)""",
    "market_long": """
        WITH w AS (SELECT week_start FROM mk UNION SELECT week_start FROM lab UNION SELECT week_start FROM lead_bars),
        wide AS (
            SELECT strftime(w.week_start, '%Y-%m-%d') AS week_id,
                   (SELECT count(*) FROM mk x WHERE x.week_start = w.week_start) AS kalshi_markets,
                   (SELECT count(*) FROM lab x WHERE x.week_start = w.week_start) AS label_windows,
                   (SELECT count(*) FROM lead_bars x WHERE x.week_start = w.week_start) AS futures_15m_rows,
                   (SELECT count(*) FROM tm x WHERE x.week_start = w.week_start) AS threshold_matches,
                   (SELECT count(*) FROM tm x WHERE x.week_start = w.week_start
                      AND x.abs_distance_to_threshold <= 100) AS near_threshold_100_count,
                   (SELECT avg(abs(price_change)) FROM lab x WHERE x.week_start = w.week_start)
                       AS avg_abs_15m_futures_change
            FROM w)
        SELECT week_id, 'kalshi_markets' AS metric, CAST(kalshi_markets AS DOUBLE) AS value FROM wide
        UNION ALL SELECT week_id, 'label_windows', label_windows FROM wide
        UNION ALL SELECT week_id, 'futures_15m_rows', futures_15m_rows FROM wide
        UNION ALL SELECT week_id, 'threshold_matches', threshold_matches FROM wide
        UNION ALL SELECT week_id, 'near_threshold_100_count', near_threshold_100_count FROM wide
        UNION ALL SELECT week_id, 'avg_abs_15m_futures_change', avg_abs_15m_futures_change FROM wide""",
    "contract_wide": """
        SELECT week_id, count(*) AS contract_behavior_rows, count(DISTINCT ticker) AS contracts,
               count(*) FILTER (has_trade_this_second) AS trade_seconds,
               (SELECT count(*) FROM yes_dec y WHERE y.week_id = f.week_id) AS decision_contracts,
               (SELECT avg(minutes_before_close_at_decision) FROM yes_dec y WHERE y.week_id = f.week_id)
                   AS avg_minutes_before_decision,
               count(*) FILTER (abs_z_bps <= 10) AS near_moneyness_rows_abs_z_bps_10,
               count(*) FILTER (uncertainty_bucket = 'Uncertain 20-80c') AS uncertain_20_80_rows,
               count(*) FILTER (uncertainty_as_is = 'Uncertain 20-80c') AS uncertain_as_is
        FROM feat f GROUP BY week_id""",
    "decision_marks": """
        SELECT f.week_id, f.ticker, min(f.contract_close_time) AS close_marker,
               make_timestamp(epoch_us(min(f.contract_close_time))
                 - CAST(floor(min(y.minutes_before_close_at_decision) * 60000000 + 0.5e0) AS BIGINT)) AS decision_marker
        FROM feat f LEFT JOIN yes_dec y ON f.ticker = y.ticker GROUP BY 1, 2""",
    "six": """
        SELECT week_id FROM feat GROUP BY week_id
        HAVING week_id IS NOT NULL AND bool_or(abs_yes_price_change_5s IS NOT NULL)
           AND bool_or(yes_price_change_5s IS NOT NULL AND underlying_change_5s IS NOT NULL)""",
}

CONTRACT_METRIC_NAMES = (
    "contract_behavior_rows",
    "contracts",
    "trade_seconds",
    "decision_contracts",
    "avg_minutes_before_decision",
    "near_moneyness_rows_abs_z_bps_10",
)


def snapped(value: str) -> str:
    """Millionths, halves up; NaN, infinities and numbers from a billion on as they are."""
    return f"CASE WHEN abs({value}) < 1e9 THEN floor({value} * 1e6 + 0.5e0) / 1e6 ELSE {value} END"


def pick(columns: str, source: str, tail: str = "", distinct: bool = False) -> str:
    """SELECT with the output casts; ``name=expression`` pairs are not split on spaces, use ``;``."""
    parts = columns.split(";") if ";" in columns or "=" in columns else columns.split()
    cells = []
    for part in (p.strip() for p in parts if p.strip()):
        name, _, expression = part.partition("=")
        name, _, kind = name.strip().partition(":")
        value = expression.strip() or f'"{name}"'
        if kind == "i":
            value = f"CAST({value} AS {'DOUBLE' if name in SPARSE_COUNTS else 'BIGINT'})"
        elif kind == "day":
            value = f"strftime({value}, '%Y-%m-%d')"
        elif kind == "d":
            value = snapped(f"CAST({value} AS DOUBLE)")
        elif kind == "t":
            value = f"CAST({value} AS TIMESTAMP)"
        cells.append(f'{value} AS "{name}"')
    body = source if re.fullmatch(r"\w+", source) else f"({source}) q"
    return f"SELECT {'DISTINCT ' if distinct else ''}{', '.join(cells)} FROM {body} {tail}".strip()


def _needed(text: str, found: list[str]) -> list[str]:
    for name, body in VIEWS.items():
        if name not in found and re.search(rf"(?<!['.\w]){name}(?!['\w(])", text):
            _needed(body, found)
            if name not in found:
                found.append(name)
    return found


def register(name: str, text: str) -> None:
    order = _needed(text, [])
    views = ",\n".join(f"{view} AS ({VIEWS[view]})" for view in order)
    ORACLE_SQL[name] = f"WITH {views}\n{text}" if views else text


def contract_long(uncertain: str) -> str:
    rows = [f"SELECT week_id, '{m}' AS metric, {m} AS value FROM contract_wide" for m in CONTRACT_METRIC_NAMES]
    rows.append(f"SELECT week_id, 'uncertain_20_80_rows' AS metric, {uncertain} AS value FROM contract_wide")
    return " UNION ALL ".join(rows)


def histogram(
    source: str, keys: str, value: str, bins: int, split: str = "", where: str = "true", limits_where: str = ""
) -> str:
    by = ", ".join(keys.split())
    extra = f", {split}" if split else ""
    on = " AND ".join(f"x.{k} = r.{k}" for k in keys.split())
    xkeys = ", ".join(f"x.{k}" for k in keys.split()) + (f", x.{split}" if split else "")
    body = f"""
        SELECT {xkeys}, CASE WHEN hi > lo THEN least(floor((x.{value} - lo) / (hi - lo) * {bins}), {bins - 1}) ELSE 0 END AS bin,
               lo, hi, count(*) AS count
        FROM (SELECT * FROM {source} WHERE ({where}) AND {value} IS NOT NULL) x
        JOIN (SELECT {by}, min({value}) AS lo, max({value}) AS hi FROM {source} WHERE ({where}) GROUP BY {by}) r ON {on}
        GROUP BY ALL"""
    names = " ; ".join([*keys.split(), *([split] if split else [])])
    return pick(
        f"{names}; bin:i; bin_start:d = lo + (hi - lo) / {bins} * bin; bin_end:d = lo + (hi - lo) / {bins} * (bin + 1);"
        " count:i",
        body,
    )


def boxes(source: str, keys: str, value: str) -> str:
    by = ", ".join(keys.split())
    on = " AND ".join(f"x.{k} = r.{k}" for k in keys.split())
    body = f"""
        SELECT {', '.join('x.' + k for k in keys.split())}, n, q25, q50, q75,
               min({value}) FILTER ({value} >= q25 - (q75 - q25) * 1.5) AS whisker_low,
               max({value}) FILTER ({value} <= q75 + (q75 - q25) * 1.5) AS whisker_high,
               count(*) FILTER ({value} < q25 - (q75 - q25) * 1.5 OR {value} > q75 + (q75 - q25) * 1.5) AS n_outliers
        FROM (SELECT * FROM {source} WHERE {value} IS NOT NULL) x
        JOIN (SELECT {by}, count({value}) AS n, quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS q50,
                     quantile_cont({value}, 0.75) AS q75 FROM {source} GROUP BY {by}) r ON {on}
        GROUP BY ALL"""
    return pick(f"{keys} n:i q25:d q50:d q75:d whisker_low:d whisker_high:d n_outliers:i", body)


def described(source: str, keys: str, value: str) -> str:
    by = ", ".join(keys.split())
    body = f"""
        SELECT {by}, count({value}) AS count, avg({value}) AS mean, stddev_samp({value}) AS std, min({value}) AS min,
               quantile_cont({value}, 0.25) AS q25, quantile_cont({value}, 0.5) AS q50,
               quantile_cont({value}, 0.75) AS q75, max({value}) AS max
        FROM {source} GROUP BY {by}"""
    return pick(f"{keys} count:i mean:d std:d min:d q25:d q50:d q75:d max:d", body)


BAR = "window_start:t symbol week_start:t"
BAR_REST = (
    "symbol first_timestamp:t last_timestamp:t futures_open:d futures_close:d futures_high:d futures_low:d "
    "spread_mean:d spread_bps_mean:d trade_count_sum:i trade_volume_sum:d rv_60s_mean:d large_move_rows:i vol_regime "
    "futures_change:d futures_return_pct:d"
)
MARKET = (
    "ticker event_ticker title subtitle open_time:t close_time:t floor_strike:d strike_type result_binary:i last_price:d "
    "yes_ask:d yes_bid:d spread:d volume:d open_interest:d liquidity:d session price_bucket last_price_cents:d "
    "yes_ask_cents:d yes_bid_cents:d spread_cents:d yes_mid_cents:d week_start:t close_date"
)
LABEL = (
    "window_start:t window_end:t decision_point:t close_start:t decision_price:d close_price:d has_gap price_change:d "
    "price_change_pct:d label:i week_start:t window_seconds:i seconds_from_decision_to_end:i "
    "seconds_from_close_start_to_end:i"
)
PANEL = (
    "ticker second:t relative_second:i seconds_to_close:i minutes_to_close:d contract_open_time:t contract_close_time:t "
    "selected_futures_symbol futures_symbol underlying_source underlying_value:d reference_underlying:d "
    "underlying_diff:d underlying_return_from_open:d underlying_bps_from_open:d underlying_return_1s:d log_moneyness:d "
    "z_moneyness:d z_bps:d abs_z_bps:d time_to_close_seconds:d time_to_close_frac_15m:d yes_state_cents:d "
    "no_state_cents:d kalshi_yes_price:d kalshi_no_price:d kalshi_yes_price_clipped:d trade_count:i trade_size:d "
    "has_trade_this_second inferred_winner outcome_yes:i decision_found decision_time:t "
    "minutes_before_close_at_decision:d is_after_decision has_underlying underlying_path_complete "
    "has_futures_observation seconds_since_last_futures_update:d is_futures_stale best_bid:d best_ask:d spread:d "
    "spread_bps:d is_valid_spread data_source_period"
)
SUMMARY = (
    "week_id ticker contract_open_time:t contract_close_time:t inferred_winner outcome_yes:i decision_found "
    "decision_time:t minutes_before_close_at_decision:d selected_futures_symbol underlying_open:d underlying_close:d "
    "yes_open_cents:d yes_close_cents:d yes_max_cents:d yes_min_cents:d total_trade_count:i total_trade_size:d "
    "min_abs_z_bps:d mean_abs_z_bps:d underlying_change:d yes_price_change:d"
)
DECISION = (
    "week_id ticker contract_open_time:t contract_close_time:t inferred_winner outcome_yes:i decision_found "
    "decision_time:t minutes_before_close_at_decision:d data_source_period"
)
EVENT = (
    "n_rows:i mean_underlying_diff:d mean_underlying_bps_from_open:d mean_yes_price_cents:d mean_no_price_cents:d "
    "mean_abs_z_bps:d trade_seconds:i"
)
EVENT_SQL = """
    count(*) AS n_rows, CAST(sum(CAST(CAST(underlying_diff AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(underlying_diff) AS mean_underlying_diff,
    CAST(sum(CAST(CAST(underlying_bps_from_open AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(underlying_bps_from_open) AS mean_underlying_bps_from_open, CAST(sum(CAST(CAST(kalshi_yes_price AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(kalshi_yes_price) AS mean_yes_price_cents,
    CAST(sum(CAST(CAST(kalshi_no_price AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(kalshi_no_price) AS mean_no_price_cents, CAST(sum(CAST(CAST(abs_z_bps AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(abs_z_bps) AS mean_abs_z_bps,
    count(*) FILTER (has_trade_this_second) AS trade_seconds FROM feat"""
DAILY = "SELECT CAST(window_start AS DATE) AS date, sum(trade_count_sum) AS trade_count_sum FROM lead_bars GROUP BY 1"
INDEX = """
    SELECT week_start, kalshi_start, kalshi_end, n_kalshi_markets, n_kalshi_events, n_label_windows,
           avg_abs_15m_futures_change, n_futures_15m_rows, n_large_move_rows_15m,
           strftime(week_start, '%Y-%m-%d') AS week_id,
           strftime(week_start, '%b %d, %Y') || ' to ' || strftime(week_start + INTERVAL 6 DAY, '%b %d, %Y') AS week_label
    FROM (SELECT week_start, min(close_time) AS kalshi_start, max(close_time) AS kalshi_end, count(*) AS n_kalshi_markets,
                 count(DISTINCT event_ticker) AS n_kalshi_events FROM mk GROUP BY 1) a
    FULL JOIN (SELECT week_start, count(*) AS n_label_windows, avg(abs(price_change)) AS avg_abs_15m_futures_change
               FROM lab GROUP BY 1) b USING (week_start)
    FULL JOIN (SELECT week_start, count(*) AS n_futures_15m_rows, sum(large_move_rows) AS n_large_move_rows_15m
               FROM lead_bars GROUP BY 1) c USING (week_start)"""
BAD_QUOTES = """
    SELECT * REPLACE (CASE WHEN yes_state_cents % 17 <> 0 THEN best_bid END AS best_bid,
                      CASE WHEN yes_state_cents % 19 = 0
                           THEN (CASE WHEN yes_state_cents % 17 <> 0 THEN best_bid END) - 1 ELSE best_ask END AS best_ask)
    FROM feat"""
VALID = "coalesce(best_bid > 0 AND best_ask > 0 AND best_ask >= best_bid, false)"
LABEL_TEXT = "strftime({0}, '%b %d, %Y') || '{1}' || strftime({0} + INTERVAL 6 DAY, '%b %d, %Y')"

BINS = (
    "week_id time_to_close_bucket moneyness_bucket n_rows:i mean_abs_yes_price_change_5s:d mean_yes_price_change_5s:d "
    "mean_underlying_change_5s:d mean_abs_underlying_change_5s:d trade_seconds:i"
)
HEAT = (
    "week_id time_to_close_bucket moneyness_bucket n_rows:i mean_abs_yes_price_change_5s:d mean_yes_price_cents:d "
    "mean_abs_z_bps:d"
)
CONTRACT_INDEX = (
    "week_start:t start_time:t end_time:t n_rows:i n_contracts:i trade_seconds:i decision_rows:i n_source_periods:i "
    "week_id week_label"
)
CONTRACT_INDEX_SQL = f"""
    SELECT week_start, min(second) AS start_time, max(second) AS end_time, count(*) AS n_rows,
           count(DISTINCT ticker) AS n_contracts, count(*) FILTER (has_trade_this_second) AS trade_seconds,
           count(*) FILTER (decision_found) AS decision_rows,
           count(DISTINCT data_source_period) AS n_source_periods, any_value(week_id) AS week_id,
           {LABEL_TEXT.format("week_start", " to ")} AS week_label FROM feat GROUP BY week_start"""


def _sources() -> None:
    register("s01_scan_projection", pick("event_id:i ts:t value:d", "events"))
    register("s02_read_columns", pick("ts_event:t price:d size:d symbol", "trd"))
    register(
        "s03_week_read",
        pick("week_id; window_start:t; symbol; futures_close:d; trade_count_sum:i",
             "SELECT *, strftime(week_start, '%Y-%m-%d') AS week_id FROM lead_bars WHERE week_start = DATE '2024-01-08'"),
    )
    register(
        "s04_csv_read",
        pick(
            "week_id = strftime(week_start, '%Y-%m-%d'); week_label = " + LABEL_TEXT.format("week_start", " - ")
            + "; week_start:day; week_path = 'weeks/' || strftime(week_start, '%Y-%m-%d')",
            "dom",
        ),
    )
    register(
        "s05_weekly_write",
        pick("week_id ticker contract_close_time:t inferred_winner underlying_close:d total_trade_count:i", "csum"),
    )
    register("s06_csv_write", pick("date:day trade_count_sum:i", DAILY))
    register(
        "s07_rewrite_enriched",
        pick("week_id ticker observed_at:t underlying_trade_price:d has_underlying_trade_price", "bysec"),
    )
    register(
        "s08_union_sources",
        pick(
            "window_start:t; symbol; trade_count_sum:i; "
            "vol_regime = CASE WHEN window_start >= TIMESTAMP '2024-01-15' THEN vol_regime END",
            "bars",
        ),
    )
    register(
        "s09_first_source_per_week",
        pick(
            "week_id source n_rows:i trade_count:i",
            """
            WITH found AS (
                SELECT strftime(week_start, '%Y-%m-%d') AS week_id, 'futures_label_window_behavior' AS source, 0 AS p,
                       trade_count_sum AS c
                FROM behavior WHERE window_start IS NOT NULL AND trade_count_sum IS NOT NULL
                UNION ALL SELECT strftime(week_start, '%Y-%m-%d'), 'futures_15m_windows', 1, trade_count_sum FROM bars
                WHERE window_start IS NOT NULL AND trade_count_sum IS NOT NULL
                UNION ALL SELECT week_id, 'contract_evolution_1s', 2, futures_trade_count_1s FROM strict
                WHERE second IS NOT NULL AND has_futures_trade_1s
                UNION ALL SELECT week_id, 'contract_plot_sample', 3, underlying_trade_count FROM bysec
                WHERE second IS NOT NULL AND underlying_trade_count IS NOT NULL)
            SELECT week_id, source, count(*) AS n_rows, sum(c) AS trade_count FROM found
            WHERE (week_id, p) IN (SELECT week_id, min(p) FROM found GROUP BY 1) GROUP BY 1, 2""",
        ),
    )


def _projections() -> None:
    register("p01_fixed_projection", pick(PANEL, "panel"))
    register("p02_tolerant_projection", pick("ticker observed_at:t best_bid:d best_ask:d", "panel"))
    register("p03_computed_columns", pick(MARKET, "mk"))
    register(
        "p04_alias_columns", pick("ticker observed_at:t kalshi_yes_price:d yes_price_cents:d no_price_cents:d", "feat")
    )
    dropped = ("has_gap", "decision_point:t", "close_start:t")
    register("p05_drop_columns", pick(" ".join(c for c in LABEL.split() if c not in dropped), "lab"))
    register(
        "p06_not_null",
        pick("symbol n_rows:i", """SELECT symbol, count(*) AS n_rows FROM micro
             WHERE rv_60s IS NOT NULL AND vol_regime IS NOT NULL GROUP BY 1"""),
    )
    register(
        "p07_equality_filter",
        pick("ticker observed_at:t selected_futures_symbol data_source_period", "panel",
             "WHERE has_trade_this_second AND data_source_period = 'early'"),
    )
    register(
        "p08_threshold_counts",
        pick("week_start:t n_within_100:i n_markets:i", """SELECT week_start, count(*) AS n_markets,
             count(*) FILTER (abs_distance_to_threshold <= 100) AS n_within_100 FROM tm GROUP BY 1"""),
    )
    register(
        "p09_between_closed",
        pick("week_id uncertain_rows:i uncertain_rows_as_is:i", """SELECT week_id,
             count(*) FILTER (kalshi_yes_price * 100 BETWEEN 20 AND 80) AS uncertain_rows,
             count(*) FILTER (kalshi_yes_price BETWEEN 20 AND 80) AS uncertain_rows_as_is FROM feat GROUP BY 1"""),
    )
    register(
        "p10_filter_stack",
        pick("ticker observed_at:t time_to_close_bucket moneyness_bucket data_source_period", "feat",
             "WHERE time_to_close_bucket = '5-7m' AND data_source_period = 'late'"),
    )
    register(
        "p11_valid_quote",
        pick("week_id valid_rows:i invalid_rows:i", f"""SELECT week_id, count(*) FILTER ({VALID}) AS valid_rows,
             count(*) FILTER (NOT {VALID}) AS invalid_rows FROM ({BAD_QUOTES}) b GROUP BY 1"""),
    )
    register(
        "p12_outlier_rows",
        pick("week_id ticker observed_at:t underlying_value:d p95:d", """
             SELECT f.*, p95 FROM feat f JOIN (SELECT ticker, quantile_cont(underlying_value, 0.95) AS p95 FROM feat
             GROUP BY 1) q ON f.ticker = q.ticker WHERE underlying_value >= p95"""),
    )
    register("p13_complete_weeks", pick("week_id; week_path = 'data/app/weeks/' || week_id", "six"))


def _joins() -> None:
    register(
        "j01_dominant_symbol_join",
        pick("week_start:t window_start:t symbol futures_close:d dominant_symbol_rows:i",
             "SELECT b.*, dominant_symbol_rows FROM lead_bars b JOIN dom d ON b.week_start = d.week_start"),
    )
    register("j02_label_bar_join", pick(f"{LABEL} {BAR_REST} window_direction futures_direction", "behavior"))
    rest = " ".join(c for c in BAR_REST.split())
    register(
        "j03_threshold_match",
        pick(f"{MARKET} window_start:t {rest} distance_to_threshold:d abs_distance_to_threshold:d "
             "distance_to_threshold_bps:d threshold_band", "tm"),
    )
    register(
        "j03_threshold_match_filing_week",
        pick("ticker window_start:t week_start:t futures_close:d distance_to_threshold:d threshold_band", """
             SELECT m.*, futures_close, futures_close - floor_strike AS distance_to_threshold,
                    CASE WHEN abs(futures_close - floor_strike) <= 25 THEN '±$25'
                         WHEN abs(futures_close - floor_strike) <= 50 THEN '±$50'
                         WHEN abs(futures_close - floor_strike) <= 100 THEN '±$100'
                         WHEN abs(futures_close - floor_strike) <= 250 THEN '±$250'
                         ELSE 'Outside ±$250' END AS threshold_band
             FROM keyed m LEFT JOIN lead_bars b ON m.window_start = b.window_start AND m.week_start = b.week_start"""),
    )
    register(
        "j04_full_outer_index",
        pick("week_start:t kalshi_start:t kalshi_end:t n_kalshi_markets:i n_kalshi_events:i n_label_windows:i "
             "avg_abs_15m_futures_change:d n_futures_15m_rows:i n_large_move_rows_15m:i week_id week_label", INDEX),
    )
    register(
        "j05_strict_trade_join",
        pick("ticker observed_at:t selected_futures_symbol futures_last_trade_price_1s:d futures_trade_count_1s:i "
             "futures_trade_size_1s:d has_futures_trade_1s", "strict"),
    )
    register(
        "j06_second_trade_join",
        pick("ticker observed_at:t underlying_trade_price:d underlying_trade_count:i underlying_trade_size:d "
             "underlying_trade_symbol has_underlying_trade_price", "bysec"),
    )
    register(
        "j07_match_rate",
        pick("week_id n_rows:i matched_rows:i matched_pct:d", """SELECT week_id, count(*) AS n_rows,
             count(underlying_trade_price) AS matched_rows, count(underlying_trade_price) * 100e0 / count(*) AS matched_pct
             FROM bysec GROUP BY 1"""),
    )
    register("j08_decision_lookup", pick("week_id ticker close_marker:t decision_marker:t", "decision_marks"))


def _aggregates() -> None:
    register(
        "a01_ohlc_15m",
        pick(f"{BAR} first_timestamp:t last_timestamp:t futures_open:d futures_close:d futures_high:d futures_low:d",
             "bars"),
    )
    register(
        "a02_bar_measures",
        pick("window_start:t symbol spread_mean:d spread_bps_mean:d trade_count_sum:i trade_volume_sum:d rv_60s_mean:d "
             "large_move_rows:i", "bars"),
    )
    register("a03_last_known_regime", pick("window_start:t symbol vol_regime", "bars"))
    register("a04_row_counts", pick("week_start:t symbol rows:i", "sym"))
    register(
        "a05_distinct_with_null",
        pick("week_id n_winners:i n_symbols:i", """SELECT week_id,
             count(DISTINCT coalesce(inferred_winner, '?')) AS n_winners,
             count(DISTINCT selected_futures_symbol) AS n_symbols FROM feat GROUP BY 1"""),
    )
    register("a06_dominant_symbol", pick("week_start:t dominant_symbol dominant_symbol_rows:i", "dom"))
    register(
        "a07_distinct_known",
        pick("week_id n_winners:i",
             "SELECT week_id, count(DISTINCT inferred_winner) AS n_winners FROM feat GROUP BY 1"),
    )
    register(
        "a08_boolean_sums",
        pick("week_id trade_seconds:i decision_rows:i after_decision_rows:i", """SELECT week_id,
             sum(CAST(has_trade_this_second AS INT)) AS trade_seconds, sum(CAST(decision_found AS INT)) AS decision_rows,
             sum(CAST(is_after_decision AS INT)) AS after_decision_rows FROM feat GROUP BY 1"""),
    )
    register(
        "a09_market_index",
        pick("week_start:t kalshi_start:t kalshi_end:t n_kalshi_markets:i n_kalshi_events:i", """
             SELECT week_start, min(close_time) AS kalshi_start, max(close_time) AS kalshi_end,
                    count(*) AS n_kalshi_markets, count(DISTINCT event_ticker) AS n_kalshi_events FROM mk GROUP BY 1"""),
    )
    register(
        "a10_label_index",
        pick("week_start:t n_label_windows:i avg_abs_15m_futures_change:d", """SELECT week_start,
             count(*) AS n_label_windows, avg(abs(price_change)) AS avg_abs_15m_futures_change FROM lab GROUP BY 1"""),
    )
    register(
        "a11_bar_index",
        pick("week_start:t n_futures_15m_rows:i n_large_move_rows_15m:i", """SELECT week_start,
             count(*) AS n_futures_15m_rows, sum(large_move_rows) AS n_large_move_rows_15m FROM lead_bars GROUP BY 1"""),
    )
    register("a12_contract_week_index", pick(CONTRACT_INDEX, CONTRACT_INDEX_SQL))
    register("a13_contract_summary", pick(SUMMARY, "csum"))
    register("a14_decision_times", pick(DECISION, "dec"))
    register("a15_sensitivity_bins", pick(BINS, "bins"))
    register("a16_threshold_heatmap", pick(HEAT, "heat"))
    register(
        "a17_event_window_response",
        pick(f"week_id relative_second:i time_to_close_bucket moneyness_bucket {EVENT}",
             f"SELECT week_id, relative_second, time_to_close_bucket, moneyness_bucket, {EVENT_SQL} GROUP BY 1, 2, 3, 4"),
    )
    register(
        "a17_event_window_all_buckets",
        pick(f"week_id relative_second:i {EVENT}", f"SELECT week_id, relative_second, {EVENT_SQL} GROUP BY 1, 2"),
    )
    register(
        "a18_trade_bars_by_symbol",
        pick("symbol; second:t; futures_last_trade_price_1s:d; futures_trade_count_1s:i; futures_trade_size_1s:d; "
             "has_futures_trade_1s = futures_trade_count_1s > 0", "sym_trades"),
    )
    register(
        "a19_trade_bars",
        pick("second:t underlying_trade_price:d underlying_trade_count:i underlying_trade_size:d underlying_trade_symbol",
             "sec_trades"),
    )
    register("a20_daily_totals", pick("date:day trade_count_sum:i", DAILY))
    register(
        "a20_daily_line_quantity",
        pick("date:day l_quantity:d", """SELECT CAST(l_shipdate AS DATE) AS date, sum(l_quantity) AS l_quantity
             FROM lineitem WHERE l_shipdate IS NOT NULL GROUP BY 1"""),
    )
    register(
        "a21_daily_statistics",
        pick("n_days:i total:i mean:d median:d min:i max:i", f"""SELECT count(*) AS n_days,
             sum(trade_count_sum) AS total, avg(trade_count_sum) AS mean, quantile_cont(trade_count_sum, 0.5) AS median,
             min(trade_count_sum) AS min, max(trade_count_sum) AS max FROM ({DAILY}) t"""),
    )
    register(
        "a22_two_level_daily",
        pick("date:day trade_count:i", """SELECT CAST(window_start AS DATE) AS date, sum(trade_count_sum) AS trade_count
             FROM bars GROUP BY 1"""),
    )
    register("a23_market_metrics", pick("week_id metric value:d", "market_long"))
    register("a24_contract_metrics", pick("week_id metric value:d", contract_long("uncertain_20_80_rows")))
    register("a24_contract_metrics_as_is", pick("week_id metric value:d", contract_long("uncertain_as_is")))
    register(
        "a25_per_second_frame",
        pick("week_id second:t underlying:d spread:d spread_bps:d quote_spread:d trade_count:i trade_size:d", "per_sec"),
    )
    register(
        "a26_underlying_per_second",
        pick("week_id second:t underlying_value:d",
             "SELECT week_id, second, CAST(sum(CAST(CAST(underlying_value AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(underlying_value) AS underlying_value FROM feat GROUP BY 1, 2"),
    )
    register(
        "a27_category_counts",
        pick("week_id inferred_winner count:i", """SELECT week_id, coalesce(inferred_winner, 'Unknown') AS inferred_winner,
             count(*) AS count FROM feat GROUP BY 1, 2"""),
    )
    register("a28_describe", described("feat", "week_id", "underlying_value"))
    register("a28_describe_order_price", described("orders", "o_orderpriority", "o_totalprice"))
    quantiles = "count(abs_z_bps) AS n, quantile_cont(abs_z_bps, 0.95) AS p95, quantile_cont(abs_z_bps, 0.99) AS p99"
    register("a29_quantiles", pick("week_id n:i p95:d p99:d", f"SELECT week_id, {quantiles} FROM feat GROUP BY 1"))
    register(
        "a29_contract_p95",
        pick("week_id ticker n:i p95:d", f"SELECT week_id, ticker, {quantiles} FROM feat GROUP BY 1, 2"),
    )
    for name in ("a30_micro_kpis", "v12_micro_kpis"):
        register(
            name,
            pick("week_id total_trade_count:i total_trade_size:d avg_spread:d avg_local_vol:d", """SELECT week_id,
                 sum(trade_count) AS total_trade_count, sum(trade_size) AS total_trade_size,
                 avg(spread_bps) AS avg_spread, avg(local_vol_60s_bps) AS avg_local_vol FROM vol GROUP BY 1"""),
        )
    register("a31_histogram", histogram("feat", "week_id", "abs_z_bps", 60, "time_to_close_bucket"))
    register("a31_histogram_line_price", histogram("lineitem", "l_returnflag", "l_extendedprice", 50))
    register("a32_box_stats", boxes("feat", "week_id time_to_close_bucket", "trade_size"))
    cells = "; ".join(
        f"{t}:d = avg(trade_size) FILTER (time_to_close_bucket = '{t}')"
        for t in ("0-1m", "1-2m", "2-3m", "3-5m", "5-7m", "7-10m", "10-15m")
    )
    register("a33_pivot_mean", pick(f"week_id; moneyness_bucket; {cells}", "feat", "GROUP BY week_id, moneyness_bucket"))
    register(
        "a34_series_audit",
        pick("file; has_underlying_trade_price = false; non_null_underlying_trade_price:i = 0; has_quote_mid; "
             "non_null_quote_mid:i; has_modeling_underlying = has_quote_mid; non_null_modeling_underlying:i = "
             "non_null_quote_mid", """
             SELECT 'contract_evolution_1s' AS file, true AS has_quote_mid, count(*) AS non_null_quote_mid FROM feat
             UNION ALL SELECT 'contract_plot_sample', false, 0"""),
    )


def _windows() -> None:
    register("w01_lag1_changes", pick("ticker observed_at:t yes_price_change_1s:d underlying_change_1s:d", "feat"))
    register("w02_lag5_changes", pick("ticker observed_at:t yes_price_change_5s:d underlying_change_5s:d", "feat"))
    register(
        "w03_lag_all_rows",
        pick("week_id ticker second:t selected_underlying_change_5s:d yes_price_change_5s_display:d time_to_close_bucket",
             """SELECT * FROM (
                SELECT *, (best_bid + best_ask) / 2 - lag((best_bid + best_ask) / 2, 5)
                    OVER (PARTITION BY ticker ORDER BY observed_at) AS selected_underlying_change_5s
                FROM moved) x
                WHERE selected_underlying_change_5s IS NOT NULL AND yes_price_change_5s IS NOT NULL"""),
    )
    register(
        "w03_sampled_lag",
        pick("week_id ticker second:t selected_underlying_change_5s:d yes_price_change_5s_display:d time_to_close_bucket",
             """SELECT * FROM (
                SELECT *, (best_bid + best_ask) / 2 - lag((best_bid + best_ask) / 2, 5)
                    OVER (PARTITION BY ticker ORDER BY observed_at) AS selected_underlying_change_5s
                FROM moved WHERE time_to_close_bucket = '10-15m') x
                WHERE selected_underlying_change_5s IS NOT NULL AND yes_price_change_5s IS NOT NULL"""),
    )
    register(
        "w04_contract_path_moves",
        pick("ticker observed_at:t yes_price_change_1s_display:d yes_price_change_5s_display:d "
             "abs_yes_price_change_5s_display:d", "both_moved"),
    )
    register("w05_series_difference", pick("week_id second:t underlying_change_1s:d", "returns"))
    register("w06_log_return_bps", pick("week_id second:t underlying_return_1s_bps:d", "returns"))
    register("w07_local_vol_60", pick("week_id second:t local_vol_60s_bps:d", "vol"))
    register(
        "w08_first_known",
        pick("week_id ticker reference:d", """SELECT week_id, ticker,
             arg_min(underlying_value, observed_at) FILTER (has_trade_this_second) AS reference FROM feat GROUP BY 1, 2"""),
    )
    register(
        "w09_first_last_row",
        pick("week_id ticker underlying_open:d underlying_close:d", "csum"),
    )
    register(
        "w10_rank_one",
        pick("week_start:t; symbol = dominant_symbol; rows:i = dominant_symbol_rows", "dom"),
    )


def _orders() -> None:
    register("o01_multi_key_sort", pick("week_start:t window_start:t symbol futures_close:d", "lead_bars",
                                        "ORDER BY week_start, window_start, symbol"))
    register("o02_mixed_sort", pick("week_start:t symbol rows:i", "sym", "ORDER BY week_start, rows DESC, symbol"))
    register(
        "o03_bucket_order",
        pick("time_to_close_bucket moneyness_bucket n_rows:i time_order:i moneyness_order:i", """
             SELECT time_to_close_bucket, moneyness_bucket, count(*) AS n_rows,
                    list_position(['0-1m','1-2m','2-3m','3-5m','5-7m','7-10m','10-15m'], time_to_close_bucket) AS time_order,
                    list_position(['Very near','Near','Moderate','Far','Very far'], moneyness_bucket) AS moneyness_order
             FROM feat GROUP BY 1, 2"""),
    )
    register(
        "o04_top25_moves",
        pick("week_id ticker rank:i observed_at:t abs_yes_price_change_5s_display:d", """
             SELECT *, row_number() OVER (PARTITION BY week_id, ticker
                 ORDER BY abs_yes_price_change_5s_display DESC, observed_at) AS rank FROM both_moved""",
             "WHERE rank <= 25"),
    )
    register(
        "o05_top200_decisions",
        pick("ticker decision_time:t minutes_before_close_at_decision:d", "yes_dec",
             "ORDER BY yes_dec.minutes_before_close_at_decision DESC, ticker LIMIT 200"),
    )
    register("o06_head_rows", pick("window_start:t symbol futures_close:d", "lead_bars",
                                   "ORDER BY lead_bars.window_start, symbol LIMIT 300"))
    register("o07_option_list", pick("option = ticker", "SELECT DISTINCT ticker FROM feat"))
    drawn = """(SELECT *, row_number() OVER (PARTITION BY week_id ORDER BY
                CAST('0x' || substr(md5('42|' || coalesce(ticker, '') || '|' || epoch_us(observed_at)), 1, 15) AS BIGINT),
                ticker, observed_at) AS nth FROM feat) x"""
    for name, cap in (("o08_capped_sample", 150_000), ("o08_capped_sample_small", 500)):
        register(name, pick("week_id ticker observed_at:t kalshi_yes_price:d", f"SELECT * FROM {drawn} WHERE nth <= {cap}"))
    register("u01_union_all", pick("ticker observed_at:t data_source_period", "feat"))
    register("u02_distinct_on_key", pick("week_id ticker inferred_winner outcome_yes:i data_source_period", "dec"))
    register("u03_distinct_values", pick("vol_regime", "micro", "WHERE vol_regime IS NOT NULL", distinct=True))


def _times() -> None:
    register("t01_microsecond_times", pick("event_id:i; ts:t; ts_us:i = epoch_us(ts)", "events"))
    register("t02_week_truncation", pick("o_orderkey:i; week_start:t = date_trunc('week', o_orderdate)", "orders"))
    register("t03_window_truncation", pick("event_id:i; window_start:t = time_bucket(INTERVAL 15 MINUTE, ts)", "events"))
    register("t04_second_floor", pick("event_id:i; second:t = date_trunc('second', ts)", "events"))
    register(
        "t05_time_shift",
        pick("event_id:i; earlier:t = ts - INTERVAL 15 MINUTE; "
             "earlier_by_value:t = make_timestamp(epoch_us(ts) - CAST(floor(value * 60000000 + 0.5e0) AS BIGINT))", "events"),
    )
    register(
        "t06_whole_seconds",
        pick("event_id:i; into_week:i = (epoch_us(ts) - epoch_us(date_trunc('week', ts))) // 1000000", "events"),
    )
    register("t07_date_format", pick("o_orderkey:i; close_date = strftime(o_orderdate, '%Y-%m-%d')", "orders"))
    register(
        "t08_week_label",
        pick("week_start:t; week_label = " + LABEL_TEXT.format("week_start", " to ") + "; index_label = "
             + LABEL_TEXT.format("week_start", " - "),
             "SELECT DISTINCT date_trunc('week', l_shipdate) AS week_start FROM lineitem"),
    )
    register(
        "t09_label_from_id",
        pick("week_id; week_label = coalesce(" + LABEL_TEXT.format("try_cast(week_id AS DATE)", " - ") + ", week_id)", """
             SELECT DISTINCT CASE WHEN o_orderkey % 7 = 0 THEN o_orderpriority
                    ELSE strftime(date_trunc('week', o_orderdate), '%Y-%m-%d') END AS week_id FROM orders"""),
    )
    register("t10_coercing_parse", pick("event_id:i; ts_event:t = CASE WHEN event_id % 11 <> 0 THEN ts END", "events"))
    register(
        "t11_calendar_date",
        pick("date:day n_rows:i", "SELECT CAST(l_shipdate AS DATE) AS date, count(*) AS n_rows FROM lineitem GROUP BY 1"),
    )
    register(
        "t12_decision_marker",
        pick("ticker; decision_marker:t = make_timestamp(epoch_us(contract_close_time) "
             "- CAST(floor(minutes_before_close_at_decision * 60000000 + 0.5e0) AS BIGINT))", "dec"),
    )
    register(
        "t13_decision_zone",
        pick("week_id ticker zone_start:t zone_end:t rows_in_zone:i", """
             SELECT week_id, ticker, contract_close_time - INTERVAL 7 MINUTE AS zone_start,
                    contract_close_time - INTERVAL 2 MINUTE AS zone_end,
                    count(*) FILTER (second BETWEEN contract_close_time - INTERVAL 7 MINUTE
                                     AND contract_close_time - INTERVAL 2 MINUTE) AS rows_in_zone
             FROM feat GROUP BY 1, 2, 3, 4"""),
    )


def _expressions() -> None:
    register("f01_cents", pick("ticker last_price_cents:d yes_ask_cents:d yes_bid_cents:d spread_cents:d", "mk"))
    register("f02_yes_mid", pick("ticker yes_mid_cents:d", "mk"))
    register(
        "f03_quote_mid_spread",
        pick(f"ticker; observed_at:t; underlying_quote_mid:d = CASE WHEN {VALID} THEN (best_bid + best_ask) / 2 END; "
             f"quote_spread:d = CASE WHEN {VALID} THEN best_ask - best_bid END", BAD_QUOTES),
    )
    register("f04_change_and_return", pick("window_start:t symbol futures_change:d futures_return_pct:d", "bars"))
    register("f05_strike_distance", pick("ticker distance_to_threshold:d abs_distance_to_threshold:d", "tm"))
    register("f06_distance_bps", pick("ticker distance_to_threshold_bps:d", "tm"))
    register(
        "f07_moneyness_of_strike",
        pick("ticker; moneyness_bps_strike:d = (futures_close - floor_strike) / floor_strike * 10000", "tm"),
    )
    register(
        "f08_threshold_band",
        pick("week_start:t threshold_band n_markets:i",
             "SELECT week_start, threshold_band, count(*) AS n_markets FROM tm GROUP BY 1, 2"),
    )
    for name, keys in (
        ("f09_moneyness_bucket", "moneyness_bucket"),
        ("f10_time_bucket", "time_to_close_bucket"),
        ("f11_uncertainty_bucket", "uncertainty_bucket uncertainty_as_is"),
    ):
        by = ", ".join(keys.split())
        register(name, pick(f"{keys} n_rows:i", f"SELECT {by}, count(*) AS n_rows FROM feat GROUP BY {by}"))
    register("f12_directions", pick("window_start:t window_direction futures_direction", "behavior"))
    register(
        "f13_absolute_value", pick("ticker observed_at:t abs_yes_price_change_5s:d abs_underlying_change_5s:d", "feat")
    )
    register("f14_natural_log", pick("ticker; observed_at:t; log_underlying:d = ln(underlying_value)", "panel"))
    register("f15_coercing_number", pick("event_id:i; number:d = CASE WHEN event_id % 13 <> 0 THEN value END", "events"))
    register(
        "f16_dollar_detection",
        pick("week_id; in_dollars; in_cents; empty = false; underlying_value = under", """SELECT week_id,
             quantile_cont(abs(kalshi_yes_price), 0.99) <= 1.5 AS in_dollars,
             quantile_cont(abs(yes_state_cents), 0.99) <= 1.5 AS in_cents,
             quantile_cont(abs(underlying_value), 0.99) <= 1.5 AS under FROM feat GROUP BY 1"""),
    )
    register(
        "f17_display_prices", pick("ticker observed_at:t yes_price_cents_display:d no_price_cents_display:d", "moved")
    )
    register(
        "f17_display_prices_any_column",
        pick("ticker; observed_at:t; yes_price_cents_display:d = yes_state_cents * any_m; "
             "yes_price_change_5s_display:d = yes_price_change_5s * any_m", """
             SELECT f.*, any_m FROM feat f JOIN (
                 SELECT week_id, CASE WHEN quantile_cont(abs(yes_state_cents), 0.99) <= 1.5
                     OR quantile_cont(abs(no_state_cents), 0.99) <= 1.5
                     OR quantile_cont(abs(yes_price_change_1s), 0.99) <= 1.5
                     OR quantile_cont(abs(yes_price_change_5s), 0.99) <= 1.5
                     OR quantile_cont(abs_yes_price_change_5s, 0.99) <= 1.5 THEN 100e0 ELSE 1e0 END AS any_m
                 FROM feat GROUP BY 1) u USING (week_id)"""),
    )
    register(
        "f18_underlying_series",
        pick("week_id; ticker; observed_at:t; underlying_series:d = CASE WHEN n > 0 THEN (CASE WHEN "
             "data_source_period = 'early' THEN (best_bid + best_ask) / 2 END) ELSE underlying_value END; "
             "underlying_source_column = CASE WHEN n > 0 THEN 'underlying_quote_mid' ELSE 'underlying_modeling' END",
             """SELECT f.*, n FROM feat f JOIN (SELECT week_id, count(*) FILTER (data_source_period = 'early') AS n
                FROM feat GROUP BY 1) c USING (week_id)"""),
    )
    register(
        "f19_trade_price_choice",
        pick("ticker; observed_at:t; underlying_trade_price:d = CASE WHEN n > 0 THEN (CASE WHEN "
             "data_source_period = 'late' THEN underlying_value + 1 END) ELSE underlying_value END",
             """SELECT f.*, n FROM feat f JOIN (SELECT week_id, count(*) FILTER (data_source_period = 'late') AS n
                FROM feat GROUP BY 1) c USING (week_id)"""),
    )
    register(
        "f20_distance_choice",
        pick("ticker; second:t; distance:d; distance_label = CASE WHEN n > 0 THEN 'Distance from threshold ($)' ELSE "
             "'Distance from threshold (bps)' END; band:d; in_band = abs(distance) <= band", """
             SELECT f.*, n, CASE WHEN n > 0 THEN (CASE WHEN data_source_period = 'late' THEN underlying_diff END)
                    ELSE z_bps END AS distance, CASE WHEN n > 0 THEN 50e0 ELSE 10e0 END AS band
             FROM feat f JOIN (SELECT week_id, count(*) FILTER (data_source_period = 'late') AS n
             FROM feat GROUP BY 1) c USING (week_id)"""),
    )
    register(
        "f21_post_join_fill",
        pick("week_id trade_count:i trade_size:d matched_rows:i", """SELECT week_id,
             sum(futures_trade_count_1s) AS trade_count, sum(futures_trade_size_1s) AS trade_size,
             count(*) FILTER (has_futures_trade_1s) AS matched_rows FROM strict GROUP BY 1"""),
    )
    register(
        "f22_bucket_ordinals",
        pick("ticker; observed_at:t; time_order:i = list_position(['0-1m','1-2m','2-3m','3-5m','5-7m','7-10m','10-15m'], "
             "time_to_close_bucket); moneyness_order:i = list_position(['Very near','Near','Moderate','Far','Very far'], "
             "moneyness_bucket)", "feat"),
    )
    register(
        "f23_metric_lookup",
        pick("week_id label_windows:d fallback:d default_value:d", """SELECT week_id,
             max(value) FILTER (metric = 'label_windows') AS label_windows,
             max(value) FILTER (metric = 'kalshi_markets') AS fallback, -1e0 AS default_value
             FROM market_long GROUP BY 1"""),
    )
    register(
        "f24_null_label",
        pick("ticker; winner = coalesce(inferred_winner, 'Unknown')", "panel", distinct=True),
    )
    label = LABEL_TEXT.format("week_start", " to ")
    register(
        "f25_concatenation",
        pick(f"week_id = strftime(week_start, '%Y-%m-%d'); display = {label} || '  (' || strftime(week_start, '%Y-%m-%d') "
             "|| ')'; week_path = 'data/app/weeks/' || strftime(week_start, '%Y-%m-%d')", "dom"),
    )


def _views() -> None:
    register(
        "v01_week_kpis",
        pick("week_id contracts:d contract_rows:d trade_seconds:d decision_contracts:d avg_decision_minutes:d "
             "near_money_rows:d", """SELECT m.week_id, coalesce(contracts, m.n) AS contracts,
             coalesce(contract_behavior_rows, 0) AS contract_rows, coalesce(trade_seconds, 0) AS trade_seconds,
             coalesce(decision_contracts, 0) AS decision_contracts,
             avg_minutes_before_decision AS avg_decision_minutes,
             coalesce(near_moneyness_rows_abs_z_bps_10, 0) AS near_money_rows
             FROM (SELECT week_id, max(value) FILTER (metric = 'kalshi_markets') AS n FROM market_long GROUP BY 1) m
             LEFT JOIN contract_wide USING (week_id)"""),
    )
    summed = """(SELECT c.week_id, floor((c.yes_price_change * m) * 1e6 + 0.5e0) / 1e6 AS yes_price_change_display FROM csum c JOIN (
        SELECT week_id, CASE WHEN least(quantile_cont(abs(yes_open_cents), 0.99), quantile_cont(abs(yes_close_cents), 0.99),
            quantile_cont(abs(yes_max_cents), 0.99), quantile_cont(abs(yes_min_cents), 0.99)) <= 1.5 THEN 100e0 ELSE 1e0
            END AS m FROM csum GROUP BY 1) u USING (week_id))"""
    register("v02_yes_change_histogram", histogram(summed, "week_id", "yes_price_change_display", 50))
    register(
        "v03_outcomes",
        pick("week_id inferred_winner count:i", """SELECT week_id, coalesce(inferred_winner, 'Unknown') AS inferred_winner,
             count(*) AS count FROM csum GROUP BY 1, 2"""),
    )
    register(
        "v04_underlying_path",
        pick("week_id; second:t; value:d = underlying; symbol = CAST(NULL AS VARCHAR)", "per_sec"),
    )
    register(
        "v04_underlying_path_fallback",
        pick("week_id second:t value:d symbol", """
             WITH has AS (SELECT DISTINCT week_id FROM feat WHERE data_source_period = 'early')
             SELECT week_id, second, CAST(sum(CAST(CAST(CASE WHEN data_source_period = 'early' THEN (best_bid + best_ask) / 2 END AS VARCHAR) AS DECIMAL(38,18))) AS DOUBLE) / count(CASE WHEN data_source_period = 'early' THEN (best_bid + best_ask) / 2 END) AS value,
                    CAST(NULL AS VARCHAR) AS symbol
             FROM feat WHERE week_id IN (SELECT week_id FROM has) GROUP BY 1, 2
             UNION ALL SELECT strftime(week_start, '%Y-%m-%d'), window_start, futures_close, symbol FROM lead_bars
             WHERE strftime(week_start, '%Y-%m-%d') NOT IN (SELECT week_id FROM has)"""),
    )
    register(
        "v05_decision_histogram",
        histogram("yes_dec", "week_id", "minutes_before_close_at_decision", 40, "inferred_winner"),
    )
    register(
        "v06_contract_metadata",
        pick("week_id ticker contract_open_time:t contract_close_time:t selected_futures_symbol futures_symbol "
             "inferred_winner outcome_yes:i data_source_period", """
             SELECT * FROM feat QUALIFY row_number() OVER (PARTITION BY week_id, ticker ORDER BY observed_at) = 1"""),
    )
    register("v07_move_histogram", histogram("both_moved", "week_id ticker", "yes_price_change_5s_display", 60))
    register("v08_move_boxes",
             boxes("both_moved", "week_id ticker time_to_close_bucket", "abs_yes_price_change_5s_display"))
    register(
        "v09_largest_moves",
        pick("week_id ticker rank:i p95_move:d second:t yes_price_change_5s_display:d abs_yes_price_change_5s_display:d "
             "yes_price_cents_display:d no_price_cents_display:d time_to_close_bucket moneyness_bucket z_bps:d abs_z_bps:d",
             """SELECT m.*, p95_move, row_number() OVER (PARTITION BY m.ticker
                    ORDER BY abs_yes_price_change_5s_display DESC, observed_at) AS rank
                FROM both_moved m JOIN (SELECT ticker, quantile_cont(abs_yes_price_change_5s_display, 0.95) AS p95_move
                FROM both_moved GROUP BY 1) q ON m.ticker = q.ticker
                WHERE abs_yes_price_change_5s_display >= p95_move""", "WHERE rank <= 25"),
    )
    register(
        "v10_combined_path",
        pick("week_id ticker second:t yes:d no:d underlying:d start_underlying:d close_marker:t decision_marker:t in_zone",
             """SELECT m.week_id, m.ticker, second, yes_price_cents_display AS yes, no_price_cents_display AS no,
                    (best_bid + best_ask) / 2 AS underlying, first_value((best_bid + best_ask) / 2) OVER (
                        PARTITION BY m.ticker ORDER BY observed_at) AS start_underlying, close_marker, decision_marker,
                    second BETWEEN close_marker - INTERVAL 7 MINUTE AND close_marker - INTERVAL 2 MINUTE AS in_zone
                FROM moved m JOIN decision_marks k ON m.ticker = k.ticker AND m.week_id = k.week_id"""),
    )
    register(
        "v11_distance_path",
        pick("week_id; ticker; second:t; distance:d = z_bps; distance_label = 'Distance from threshold (bps)'; "
             "band:d = 10; in_band = abs(z_bps) <= 10", "feat"),
    )
    register(
        "v13_micro_series",
        pick("week_id second:t underlying:d spread_bps:d trade_count:i trade_size:d local_vol_60s_bps:d", "vol"),
    )
    register(
        "v14_spread_vs_volatility",
        pick("week_id; second:t; local_vol_60s_bps:d; spread:d = spread_bps", "vol",
             "WHERE local_vol_60s_bps IS NOT NULL AND spread_bps IS NOT NULL"),
    )
    register(
        "v15_decision_shares",
        pick("week_id inferred_winner count:i share:d", """SELECT week_id,
             coalesce(inferred_winner, 'Unknown') AS inferred_winner, count(*) AS count,
             count(*) * 1e0 / sum(count(*)) OVER (PARTITION BY week_id) AS share FROM yes_dec GROUP BY 1, 2"""),
    )
    register("v16_decision_statistics", described("yes_dec", "week_id", "minutes_before_close_at_decision"))
    register(
        "v17_decision_table",
        pick("week_id rank:i ticker contract_open_time:t contract_close_time:t inferred_winner decision_time:t "
             "minutes_before_close_at_decision:d data_source_period", """
             SELECT *, row_number() OVER (PARTITION BY week_id ORDER BY minutes_before_close_at_decision DESC NULLS LAST,
                 ticker) AS rank FROM yes_dec""", "WHERE rank <= 200"),
    )
    cells = "; ".join(
        f"{t}:d = avg(mean_abs_yes_price_change_5s * m) FILTER (time_to_close_bucket = '{t}')"
        for t in ("0-1m", "1-2m", "2-3m", "3-5m", "5-7m", "7-10m", "10-15m")
    )
    scaled = """(SELECT {0}.*, m FROM {0} JOIN (SELECT week_id, CASE WHEN
        quantile_cont(abs({1}), 0.99) <= 1.5 THEN 100e0 ELSE 1e0 END AS m FROM {0} GROUP BY 1) u USING (week_id))"""
    order = "list_position(['Very near','Near','Moderate','Far','Very far'], moneyness_bucket)"
    register(
        "v18_heatmap_matrix",
        pick(f"week_id; moneyness_order:i = {order}; moneyness_bucket; {cells}",
             "SELECT * FROM " + scaled.format("heat", "mean_yes_price_cents"), "GROUP BY week_id, moneyness_bucket"),
    )
    register(
        "v19_distance_histogram",
        histogram("feat", "week_id", "abs_z_bps", 60, "time_to_close_bucket", "moneyness_bucket = 'Far'"),
    )
    register("v19_distance_histogram_all", histogram("feat", "week_id", "abs_z_bps", 60, "time_to_close_bucket"))
    register(
        "v20_distance_vs_response_all",
        pick("week_id ticker second:t minutes_to_close:d yes_price_cents_display:d abs_z_bps:d "
             "abs_yes_price_change_5s_display:d time_to_close_bucket", "moved", "WHERE abs_yes_price_change_5s IS NOT NULL"),
    )
    register(
        "v20_distance_vs_response",
        pick("week_id ticker second:t minutes_to_close:d yes_price_cents_display:d abs_z_bps:d "
             "abs_yes_price_change_5s_display:d time_to_close_bucket", "moved",
             "WHERE data_source_period = 'late' AND abs_yes_price_change_5s IS NOT NULL"),
    )
    register(
        "v21_move_pairs",
        pick("week_id ticker second:t abs_z_bps:d minutes_to_close:d underlying_change_5s:d yes_price_change_5s_display:d "
             "time_to_close_bucket", "moved", "WHERE underlying_change_5s IS NOT NULL AND yes_price_change_5s IS NOT NULL"),
    )
    register(
        "v22_sensitivity_curve",
        pick(f"week_id; moneyness_order:i = {order}; moneyness_bucket; time_order:i = list_position(['0-1m','1-2m','2-3m',"
             "'3-5m','5-7m','7-10m','10-15m'], time_to_close_bucket); time_to_close_bucket; "
             "mean_abs_yes_price_change_5s_display:d = mean_abs_yes_price_change_5s * m", """
             SELECT bins.*, m FROM bins JOIN (SELECT week_id, CASE WHEN
                 least(quantile_cont(abs(mean_abs_yes_price_change_5s), 0.99),
                       quantile_cont(abs(mean_yes_price_change_5s), 0.99)) <= 1.5 THEN 100e0 ELSE 1e0 END AS m
             FROM bins GROUP BY 1) u USING (week_id)"""),
    )
    ranked = "SELECT *, row_number() OVER (PARTITION BY week_id ORDER BY {}) AS rank FROM {}"
    register(
        "v23_preview_summary",
        pick(SUMMARY + " rank:i", ranked.format("contract_close_time, ticker", "csum"), "WHERE rank <= 200"),
    )
    register(
        "v23_preview_evolution",
        pick("week_id; ticker; rank:i; second:t; underlying_value:d; underlying_modeling:d = underlying_value; "
             "underlying_quote_mid:d = (best_bid + best_ask) / 2; best_bid:d; best_ask:d; spread:d; spread_bps:d; "
             "quote_spread:d = best_ask - best_bid; trade_count:i; trade_size:d; yes_price_cents:d; no_price_cents:d; "
             "yes_price_cents_display:d; no_price_cents_display:d; z_bps:d; abs_z_bps:d; time_to_close_bucket; "
             "moneyness_bucket",
             "SELECT *, row_number() OVER (PARTITION BY week_id, ticker ORDER BY observed_at) AS rank FROM moved",
             "WHERE rank <= 300"),
    )
    register(
        "v23_preview_decisions",
        pick(DECISION + " rank:i", ranked.format("contract_close_time, ticker", "dec"), "WHERE rank <= 200"),
    )
    register(
        "v23_preview_sample",
        pick("week_id ticker observed_at:t yes_price_change_5s:d moneyness_bucket time_to_close_bucket rank:i",
             ranked.format("ticker, observed_at", "feat"), "WHERE rank <= 200"),
    )
    register(
        "v24_price_audit",
        pick("file; has_underlying_trade_price = tp; non_null_underlying_trade_price:i = ntp; has_quote_mid = true; "
             "non_null_quote_mid:i = n; has_modeling_underlying = true; non_null_modeling_underlying:i = n", """
             SELECT 'contract_evolution_1s' AS file, true AS tp, count(underlying_trade_price) AS ntp, count(*) AS n FROM bysec
             UNION ALL SELECT 'contract_plot_sample', false, 0, count(*) FROM feat"""),
    )
    register(
        "v25_filter_options",
        pick("week_id option filter", """
             SELECT DISTINCT week_id, time_to_close_bucket AS option, 'time_to_close' AS filter FROM feat
             UNION ALL SELECT DISTINCT week_id, moneyness_bucket, 'moneyness' FROM feat
             UNION ALL SELECT DISTINCT week_id, data_source_period, 'source' FROM feat"""),
    )


def _profiles() -> None:
    register("d01_row_count", pick("n_rows:i = count(*)", "events"))
    times = ("second", "contract_open_time", "contract_close_time")
    register(
        "d02_time_ranges",
        pick("column min:t max:t", " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", min({c}) AS min, max({c}) AS max FROM feat" for c in times)),
    )
    register("d03_id_sample", pick("value = ticker", "SELECT DISTINCT ticker FROM feat", "ORDER BY ticker LIMIT 20"))
    register(
        "d03_distinct_counts",
        pick("column n_distinct:i", """SELECT 'ticker' AS "column", count(DISTINCT ticker) AS n_distinct FROM feat
             UNION ALL SELECT 'futures_symbol', count(DISTINCT futures_symbol) FROM feat"""),
    )
    numeric = (
        "underlying_value", "reference_underlying", "underlying_diff", "underlying_return_from_open",
        "underlying_bps_from_open", "underlying_return_1s", "yes_state_cents",
        "no_state_cents", "kalshi_yes_price", "kalshi_no_price", "kalshi_yes_price_clipped", "outcome_yes",
        "seconds_since_last_futures_update", "best_bid", "best_ask", "spread", "spread_bps", "yes_price_cents",
        "no_price_cents",
    )
    register(
        "d04_numeric_ranges",
        pick("column min:d max:d mean:d", " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max, "
            f"avg({c}) AS mean FROM feat" for c in numeric)),
    )
    register(
        "d05_duplicate_keys",
        pick("selected_futures_symbol second:t n_rows:i", """SELECT selected_futures_symbol, second, count(*) AS n_rows
             FROM panel GROUP BY 1, 2 HAVING count(*) > 1"""),
    )
    bounds = " UNION ALL ".join(
        f"""SELECT '{c}' AS "column", count(*) AS n_rows, count({c}) AS n_known, min({c}) AS min, max({c}) AS max FROM lineitem"""
        for c in ("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")
    )
    register("d01_file_statistics", pick("column n_rows:i n_known:i min:d max:d", bounds))
    pair = """SELECT '{0}' AS contract_column, '{1}' AS time_column, count(*) AS n_rows,
        count(*) FILTER ({0} IS NOT NULL AND {1} IS NOT NULL) AS n_known,
        count(*) FILTER ({0} IS NOT NULL AND {1} IS NOT NULL)
          - count(DISTINCT ({0}, {1})) FILTER ({0} IS NOT NULL AND {1} IS NOT NULL) AS extra FROM {2}"""
    for name, table, contracts, times in (
        ("d05_candidate_keys", "feat", ("ticker", "selected_futures_symbol", "futures_symbol"),
         ("second", "contract_open_time", "contract_close_time")),
        ("d05_candidate_keys_lines", "lineitem", ("l_orderkey", "l_partkey", "l_suppkey"), ("l_linenumber", "l_shipdate")),
    ):
        found = " UNION ALL ".join(pair.format(c, t, table) for c in contracts for t in times)
        register(name, pick(
            "contract_column time_column n_rows:i n_null:i duplicates verdict",
            f"""SELECT *, n_rows - n_known AS n_null, CASE WHEN near THEN CAST(extra AS DOUBLE) END AS duplicates,
                CASE WHEN near AND extra = 0 AND n_known = n_rows THEN 'key' WHEN near AND n_known > 0 THEN 'nearly' ELSE 'no' END AS verdict
                FROM (SELECT *, extra <= n_known * 0.09999999999999998e0 AS near FROM ({found}) p)""",
        ))
    coverage = """SELECT '{0}.parquet' AS file, count(*) AS n_rows, min({1}) AS first_time, max({1}) AS last_time,
        count(DISTINCT {2}) AS n_symbols FROM {0}"""
    for name, args in (
        ("d06_file_coverage", ("events", "ts", "event_type")),
        ("d06_file_coverage_lineitem", ("lineitem", "l_shipdate", "l_returnflag")),
    ):
        register(name, pick("file n_rows:i first_time:t last_time:t n_symbols:i", coverage.format(*args)))
    register(
        "d07_complete_week_index",
        pick("week_id; week_label = " + LABEL_TEXT.format("CAST(week_id AS DATE)", " - ")
             + "; week_start = week_id; week_path = 'data/app/weeks/' || week_id", "six"),
    )
    register(
        "d08_known_trade_prices",
        pick("dataset week_id non_null:i", """
             SELECT 'contract_evolution_1s' AS dataset, week_id, count(futures_last_trade_price_1s) AS non_null
             FROM strict GROUP BY 2
             UNION ALL SELECT 'contract_plot_sample', week_id, count(underlying_trade_price) FROM bysec GROUP BY 2"""),
    )


def content(product: str, columns: str, source: str) -> str:
    """Per week the rows, the columns and a digest over all values, as ``present.content`` has them."""
    parts = sorted(p.partition(":") for p in columns.split() if p != "week_id")
    texts = []
    for name, _, kind in parts:
        value = {
            "d": f"CAST({snapped(f'CAST({name} AS DOUBLE)')} AS DECIMAL(38,6))",
            "i": f"CAST({name} AS BIGINT)",
            "t": f"epoch_us(CAST({name} AS TIMESTAMP))",
        }.get(kind, name)
        texts.append(f"coalesce(CAST({value} AS VARCHAR), '~')")
    row = "md5(" + " || '|' || ".join(texts) + ")"
    names = ",".join(name for name, _, _ in parts)
    return (
        f"SELECT week_id, '{product}' AS product, count(*) AS n_rows, '{names}' AS columns, "
        f"CAST(sum(CAST('0x' || substr({row}, 1, 15) AS BIGINT)) AS VARCHAR) AS digest FROM {source} GROUP BY week_id"
    )


FEATURES = (
    PANEL + " observed_at:t week_start:t yes_price_change_1s:d yes_price_change_5s:d underlying_change_1s:d "
    "underlying_change_5s:d moneyness_bucket time_to_close_bucket uncertainty_bucket yes_price_cents:d no_price_cents:d "
    "abs_yes_price_change_5s:d abs_underlying_change_5s:d"
)
WEEKLY = "(SELECT *, strftime(week_start, '%Y-%m-%d') AS week_id FROM {}) x"
CONTENT = "product week_id n_rows:i columns digest"


def _builds() -> None:
    kinds = {c.partition(":")[0]: c for c in FEATURES.split()}
    evolution = " ".join(kinds[c] for c in EVOLUTION_COLUMNS)
    register(
        "e01_weekly_contract_build",
        pick(CONTENT, " UNION ALL ".join([
            content("contract_summary", SUMMARY, "csum"),
            content("contract_decision_times", DECISION, "dec"),
            content("sensitivity_bins", BINS, "bins"),
            content("threshold_heatmap", HEAT, "heat"),
            content("contract_event_window_response", f"relative_second:i time_to_close_bucket moneyness_bucket {EVENT}",
                    f"(SELECT week_id, relative_second, time_to_close_bucket, moneyness_bucket, {EVENT_SQL} GROUP BY 1, 2, 3, 4) x"),
            content("contract_plot_sample", FEATURES, "feat"),
            content("contract_evolution_1s", evolution, "feat"),
            content("contract_behavior_summary_metrics", "metric value:d", f"({contract_long('uncertain_20_80_rows')}) x"),
            content("contract_week_index", CONTRACT_INDEX, f"({CONTRACT_INDEX_SQL}) x"),
        ])),
    )
    register(
        "e02_weekly_market_build",
        pick(CONTENT, " UNION ALL ".join([
            content("kalshi_markets", MARKET, WEEKLY.format("mk")),
            content("labels_15m", LABEL, WEEKLY.format("lab")),
            content("futures_15m_windows", f"window_start:t week_start:t {BAR_REST}", WEEKLY.format("lead_bars")),
            content("futures_label_window_behavior", f"{LABEL} {BAR_REST} window_direction futures_direction",
                    WEEKLY.format("behavior")),
            content("kalshi_threshold_matches", f"{MARKET} window_start:t {BAR_REST} distance_to_threshold:d "
                    "abs_distance_to_threshold:d distance_to_threshold_bps:d threshold_band", WEEKLY.format("tm")),
            content("summary_metrics", "metric value:d", "market_long"),
        ])),
    )
    base = "ticker second:t observed_at:t selected_futures_symbol"
    by_second = (
        f"{base} underlying_trade_price:d underlying_trade_count:i underlying_trade_size:d underlying_trade_symbol "
        "has_underlying_trade_price"
    )
    strict = f"{base} futures_last_trade_price_1s:d futures_trade_count_1s:i futures_trade_size_1s:d has_futures_trade_1s"
    alias = f"{strict} underlying_trade_price:d underlying_trade_count:i underlying_trade_size:d"
    aliased = (
        "(SELECT *, futures_last_trade_price_1s AS underlying_trade_price, futures_trade_count_1s AS underlying_trade_count, "
        "futures_trade_size_1s AS underlying_trade_size FROM strict) x"
    )

    register(
        "e04_colocated_trades",
        pick("week_id ticker second:t observed_at:t selected_futures_symbol underlying_trade_price:d underlying_trade_count:i "
             "underlying_trade_size:d has_underlying_trade_price", "bysec"),
    )

    def both(columns: str, source: str) -> str:
        return " UNION ALL ".join(content(p, columns, source) for p in ("contract_evolution_1s", "contract_plot_sample"))

    def rated(columns: str, source: str, price: str) -> str:
        return f"""SELECT * FROM ({both(columns, source)}) c LEFT JOIN (
            SELECT week_id, count({price}) AS matched_rows, count({price}) * 100e0 / count(*) AS matched_pct
            FROM {source} GROUP BY 1) r USING (week_id)"""

    rates = f"{CONTENT} matched_rows:i matched_pct:d"
    register("e03_trade_enrichment", pick(rates, rated(by_second, "bysec", "underlying_trade_price")))
    register("e03_by_second_after_strict", pick(rates, rated(by_second, "bysec", "underlying_trade_price")))
    register("e03_strict_enrichment", pick(rates, rated(strict, "strict", "futures_last_trade_price_1s")))
    register(
        "e03_alias_enrichment",
        pick(f"{CONTENT} non_null:i", f"""SELECT * FROM ({both(alias, aliased)}) c LEFT JOIN (
             SELECT week_id, count(futures_last_trade_price_1s) AS non_null FROM strict GROUP BY 1) r USING (week_id)"""),
    )


for build in (_sources, _projections, _joins, _aggregates, _windows, _orders, _times, _expressions, _views, _profiles, _builds):
    build()

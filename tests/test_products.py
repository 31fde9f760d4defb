from datetime import date, datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

import golden
from conftest import rows_of
from strikepath import roles
from strikepath.functions import clock
from strikepath.operators import bars, daily, display, enrich, filters, match, metrics, panel, profile, skew, summary
from strikepath.sources import tables


def ts(text):
    return datetime.fromisoformat(text)


MICRO = (
    "timestamp timestamp, symbol string, mid_price double, spread double, spread_bps double, trade_count bigint, "
    "trade_volume double, rv_60s double, vol_regime string, event_large_move boolean"
)


def tick(at, symbol="A", price=100.0, regime=None, count=None):
    return (ts(at), symbol, price, None, None, count, None, None, regime, price > 150)


def test_bar_of_mixed_regimes(make):
    df = make(
        [
            tick("2024-01-01 00:14:59.900000", price=120.0, regime=None),
            tick("2024-01-01 00:00:01", price=100.0, regime="low"),
            tick("2024-01-01 00:07:00", price=160.0, regime="high"),
            tick("2024-01-01 00:08:00", price=90.0, regime="low"),
            (None, "A", 1.0, None, None, 1, 1.0, None, None, True),
            (ts("2024-01-01 00:01:00"), "A", None, None, None, 1, 1.0, None, None, True),
        ],
        MICRO,
    )
    row = bars.ohlc_bars(df).first()
    assert (row.futures_open, row.futures_close, row.futures_high, row.futures_low) == (100.0, 120.0, 160.0, 90.0)
    assert (row.vol_regime, row.large_move_rows) == ("low", 1)
    # All-NULL sums are 0, all-NULL means stay NULL.
    assert (row.trade_count_sum, row.trade_volume_sum, row.spread_mean) == (0, 0.0, None)
    assert row.futures_return_pct == pytest.approx(20.0)


def test_bar_with_unknown_regime_and_zero_open(make):
    row = bars.ohlc_bars(make([tick("2024-01-01 00:00:01", price=0.0)], MICRO)).first()
    assert row.vol_regime is None and row.futures_return_pct is None


def test_equal_counts_take_the_first_symbol(make):
    ticks = [tick("2024-01-01 00:00:01", s) for s in ("B", "A")] + [tick("2024-01-10 00:00:01", "B")]
    built = bars.ohlc_bars(make(ticks, MICRO))
    got = rows_of(bars.dominant_symbols(built).select("dominant_symbol", "dominant_symbol_rows"), "week_start")
    assert got == [("A", 1), ("B", 1)]
    assert sorted(r.symbol for r in bars.keep_dominant(built).collect()) == ["A", "B"]


MARKET = "ticker string, event_ticker string, close_time timestamp, floor_strike double, last_price double, " \
    "yes_ask double, yes_bid double, spread double"


def market(ticker, close, strike=100.0):
    return (ticker, "E", close and ts(close), strike, 0.5, 0.6, 0.4, 0.2)


def test_matching_never_fans_out_and_keeps_the_unmatched(make):
    ticks = [tick("2024-01-07 23:50:00", price=110.0), tick("2024-01-08 00:01:00", price=300.0)]
    leading = bars.keep_dominant(bars.ohlc_bars(make(ticks, MICRO)))
    markets = match.clean_markets(
        make(
            [
                market("monday", "2024-01-08 00:00:00"),
                market("next", "2024-01-08 00:15:00", None),
                market("none", "2024-01-08 05:00:00"),
                market("never", None),
            ],
            MARKET,
        )
    )
    by_window = {r.ticker: r for r in match.threshold_matches(markets, leading).collect()}
    assert set(by_window) == {"monday", "next", "none"}
    assert (by_window["monday"].distance_to_threshold, by_window["monday"].threshold_band) == (10.0, "±$25")
    assert by_window["monday"].distance_to_threshold_bps == pytest.approx(10 / 110 * 10_000)
    assert (by_window["next"].futures_close, by_window["next"].distance_to_threshold_bps) == (300.0, None)
    assert by_window["none"].threshold_band == "Outside ±$250"
    filed = {r.ticker: r for r in match.threshold_matches(markets, leading, week_of="close").collect()}
    assert filed["monday"].futures_close is None and filed["monday"].threshold_band == "Outside ±$250"
    row = match.strike_moneyness_bps(match.threshold_matches(markets, leading)).where("ticker = 'monday'").first()
    assert row.moneyness_bps_strike == pytest.approx(1000.0)


LABELS = "window_start timestamp, window_end timestamp, decision_point timestamp, close_start timestamp, " \
    "price_change double, label int"


def test_index_keeps_weeks_of_any_table(make):
    labels = match.clean_labels(
        make([(ts("2024-01-01 00:00"), ts("2024-01-01 00:15"), ts("2024-01-01 00:10"), ts("2024-01-01 00:14"), -2.0, 0)],
             LABELS)
    )
    markets = match.clean_markets(make([market("m", "2024-01-09 00:15:00")], MARKET))
    leading = bars.keep_dominant(bars.ohlc_bars(make([tick("2024-01-16 00:00:01")], MICRO)))
    index = rows_of(
        metrics.week_index(markets, labels, leading).select(
            "week_id", "n_kalshi_markets", "avg_abs_15m_futures_change", "n_futures_15m_rows"
        ),
        "week_id",
    )
    assert index == [("2024-01-01", None, 2.0, None), ("2024-01-08", 1, None, None), ("2024-01-15", None, None, 1)]
    behavior = match.window_behavior(labels, leading).first()
    assert behavior.futures_close is None and behavior.seconds_from_close_start_to_end == 60
    long = metrics.market_metrics(markets, labels, leading, match.threshold_matches(markets, leading))
    first = {r.metric: r.value for r in long.where("week_id = '2024-01-01'").collect()}
    assert first == {
        "kalshi_markets": 0, "label_windows": 1, "futures_15m_rows": 0, "threshold_matches": 0,
        "near_threshold_100_count": 0, "avg_abs_15m_futures_change": 2.0,
    }


def panel_rows(make, ticker="C", n=8, close="2024-01-01 00:15:00", **fixed):
    """A short dense contract; named columns take one value per row, others are NULL."""
    names = roles.CONTRACT_1S.names
    rows = []
    for i in range(n):
        values = dict.fromkeys(names)
        values.update(
            ticker=ticker, second=ts("2024-01-01 00:00:00") + timedelta(seconds=i), relative_second=i,
            contract_close_time=ts(close), minutes_to_close=15 - i / 60, abs_z_bps=float(i), kalshi_yes_price=i / 10,
            underlying_value=100.0 + i, has_trade_this_second=i % 2 == 0, decision_found=False,
        )
        values.update({k: v[i] for k, v in fixed.items()})
        rows.append(tuple(values[n] for n in names))
    return make(rows, roles.CONTRACT_1S)


def test_summary_keeps_null_first_values(make):
    features = panel.panel_features(
        panel_rows(make, inferred_winner=[None, "YES"] * 4, underlying_value=[None, *[float(i) for i in range(7)]])
    )
    row = summary.contract_summary(features).first()
    assert (row.inferred_winner, row.underlying_open, row.underlying_close) == (None, None, 6.0)
    assert (row.underlying_change, row.total_trade_count) == (None, 0)
    assert row.yes_price_change == pytest.approx(0.7) and row.mean_abs_z_bps == 3.5
    decision = summary.decision_times(features).collect()
    assert len(decision) == 1 and decision[0].inferred_winner is None


def test_short_contracts_have_no_5_row_change(make):
    features = panel.panel_features(panel_rows(make, n=5))
    assert summary.sensitivity_bins(features).count() == 0
    assert summary.threshold_heatmap(panel.panel_features(panel_rows(make, n=6))).first().n_rows == 1


def test_contract_without_close_is_left_out(make):
    rows = panel_rows(make, n=2).withColumn("contract_close_time", F.lit(None).cast("timestamp"))
    assert panel.panel_features(rows).count() == 0


def test_contract_metrics_count_contracts_once(make):
    both = panel_rows(
        make, n=8, decision_found=[True] * 8, minutes_before_close_at_decision=[4.0] * 8,
        kalshi_yes_price=[0.19, 0.2, 0.8, 0.81, 0.5, 0.5, 0.5, None],
    ).unionByName(panel_rows(make, "D", 2))
    features = panel.panel_features(both)
    got = {r.metric: r.value for r in metrics.contract_metrics(features).collect()}
    assert got == {
        "contract_behavior_rows": 10, "contracts": 2, "trade_seconds": 5, "decision_contracts": 1,
        "avg_minutes_before_decision": 4.0, "near_moneyness_rows_abs_z_bps_10": 10, "uncertain_20_80_rows": 5,
    }
    stored = {r.metric: r.value for r in metrics.contract_metrics(features, "as_is").collect()}
    assert stored["uncertain_20_80_rows"] == 0
    index = metrics.contract_week_index(features).first()
    assert (index.n_rows, index.n_contracts, index.decision_rows) == (10, 2, 8)


def test_metric_lookup_defaults(make):
    long = make([("w", "a", 1.0)], "week_id string, metric string, value double")
    got = rows_of(long.agg(metrics.metric("a", 9.0), metrics.metric("b", metrics.metric("a")), metrics.metric("b", 0.0)))
    assert got == [(1.0, 1.0, 0.0)]


def test_week_needs_all_products(make):
    names = ["contract_summary", "contract_evolution_1s", "contract_plot_sample", "sensitivity_bins",
             "threshold_heatmap", "contract_decision_times"]
    full = {n: make([("2024-01-01",), ("2024-01-08",), ("x",), (None,)], "week_id string") for n in names}
    full["threshold_heatmap"] = make([("2024-01-01",), ("x",), (None,)], "week_id string")
    got = rows_of(metrics.complete_weeks(full, "weeks/").select("week_id", "week_label", "week_path"), "week_id")
    assert got == [("2024-01-01", "Jan 01, 2024 - Jan 07, 2024", "weeks/2024-01-01"), ("x", "x", "weeks/x")]


TRADES = "ts_event timestamp, price double, size double, symbol string"


def test_trade_bars_and_joins(make):
    trades = make(
        [
            (ts("2024-01-01 00:00:01.100000"), 10.0, 1.0, "A"),
            (ts("2024-01-01 00:00:01.900000"), 11.0, None, None),
            (ts("2024-01-01 00:00:01.500000"), 12.0, 2.0, "B"),
            (ts("2024-01-01 00:00:02"), None, 2.0, "B"),
            (None, 1.0, 2.0, "B"),
        ],
        TRADES,
    )
    by_second = bars.trade_bars(trades)
    assert rows_of(by_second.drop("second")) == [(11.0, 3, 3.0, "B")]
    by_symbol = bars.trade_bars_by_symbol(trades)
    assert rows_of(by_symbol.select("symbol", "futures_last_trade_price_1s"), "symbol") == [("A", 10.0), ("B", 12.0)]
    frame = make(
        [("w", "A", ts("2024-01-01 00:00:01")), ("w", "A", None), ("w", None, ts("2024-01-01 00:00:05"))],
        "week_id string, futures_symbol string, second timestamp",
    )
    once = enrich.attach_trades_strict(frame, by_symbol)
    again = enrich.attach_trades_strict(once, by_symbol)
    assert again.columns == once.columns and again.count() == 3
    filled = rows_of(again.select("futures_trade_count_1s", "futures_trade_size_1s", "has_futures_trade_1s"),
                     F.desc("futures_trade_count_1s"))
    assert filled == [(1, 1.0, True), (0, 0.0, False), (0, 0.0, False)]
    loose = enrich.attach_trades_by_second(once, by_second, replace_strict=True)
    assert not set(enrich.STRICT_COLUMNS) & set(loose.columns)
    assert rows_of(enrich.match_rate(loose, "underlying_trade_price"))[0] == (3, 1, pytest.approx(100 / 3))
    assert rows_of(enrich.match_rate(loose.limit(0), "underlying_trade_price")) == [(0, 0, 0.0)]
    assert enrich.alias_strict_trades(once).where("underlying_trade_price = 10.0").count() == 1
    with pytest.raises(ValueError):
        enrich.attach_trades_strict(frame.drop("futures_symbol"), by_symbol)


def test_display_scales_by_week_and_by_rule(make):
    df = make(
        [("d", 0.5, 0.01), ("d", 0.9, 0.0), ("c", 50.0, 0.5), ("c", 90.0, 1.0), ("n", None, None)],
        "week_id string, yes_price_cents double, yes_price_change_5s double",
    )
    shown = display.with_display_prices(df)
    got = {r.week_id: r.m for r in shown.groupBy("week_id").agg(F.max("yes_price_cents_display").alias("m")).collect()}
    assert got == {"d": 90.0, "c": 90.0, "n": None}
    anyway = display.with_display_prices(df, any_column=True)
    assert anyway.where("week_id = 'c'").agg(F.max("yes_price_cents_display")).first()[0] == 9000.0


def test_series_choice_is_per_week_not_per_row(make):
    df = make(
        [("q", 1.0, 3.0, 7.0), ("q", None, 3.0, 7.0), ("m", None, None, 7.0), ("z", None, None, None)],
        "week_id string, best_bid double, best_ask double, underlying_value double",
    )
    got = display.with_underlying_series(display.with_underlying_columns(df))
    rows = sorted(rows_of(got.select("week_id", "underlying_series", "underlying_source_column")), key=str)
    assert rows == [
        ("m", 7.0, "underlying_modeling"), ("q", 2.0, "underlying_quote_mid"),
        ("q", None, "underlying_quote_mid"), ("z", None, None),
    ]


def test_distance_prefers_dollars(make):
    df = make(
        [("d", 60.0, 1.0), ("b", None, -9.0)], "week_id string, threshold_distance double, z_bps double"
    )
    got = rows_of(display.with_distance_series(df).select("week_id", "distance", "band", "in_band"), "week_id")
    assert got == [("b", -9.0, 10.0, True), ("d", 60.0, 50.0, False)]


def test_filters_ignore_all_and_missing(make):
    df = make([("0-1m", "Near"), ("1-2m", "Near"), (None, "Far")], "time_to_close_bucket string, moneyness_bucket string")
    assert filters.apply_filters(df, time_to_close="All", source="late").count() == 3
    assert filters.apply_filters(df, time_to_close="0-1m", moneyness="Near").count() == 1
    assert [r.option for r in filters.options(df, "time_to_close_bucket").orderBy("option").collect()] == ["0-1m", "1-2m"]


def test_conform_coerces_and_completes(make):
    df = make([("x", "bad", float("nan")), ("y", "2024-01-01 00:00:00", 1.0)], "symbol string, ts_event string, price double")
    fixed = roles.conform(df, roles.TRADES, required=("ts_event", "price"))
    assert fixed.schema == roles.TRADES
    assert rows_of(fixed, "symbol") == [(None, None, None, "x"), (ts("2024-01-01 00:00:00"), 1.0, None, "y")]
    with pytest.raises(ValueError, match="size"):
        roles.conform(df, roles.TRADES)


def test_profiles(make):
    df = make(
        [("a", ts("2024-01-01"), 1.0), ("a", ts("2024-01-01"), None), (None, ts("2024-01-03"), 3.0)],
        "ticker string, second timestamp, price double",
    )
    assert rows_of(profile.time_ranges(df)) == [("second", ts("2024-01-01"), ts("2024-01-03"))]
    assert rows_of(profile.numeric_ranges(df)) == [("price", 1.0, 3.0, 2.0)]
    assert rows_of(profile.duplicate_keys(df, "ticker", "second")) == [("a", ts("2024-01-01"), 2)]
    assert rows_of(profile.id_samples(df, "ticker", 12)) == [("a",)]
    audit = profile.series_audit({"x": df, "y": df.withColumn("underlying_quote_mid", F.col("price"))})
    assert sorted((r.file, r.has_quote_mid, r.non_null_quote_mid) for r in audit.collect()) == [("x", False, 0), ("y", True, 2)]


def test_published_daily_figures(make):
    first = date(2025, 12, 15)
    rows = [
        (datetime.combine(first + timedelta(days=i), datetime.min.time()) + timedelta(hours=h), part)
        for i, n in enumerate(golden.DAILY_TRADES)
        if n is not None
        for h, part in ((1, n // 3), (23, n - n // 3))
    ]
    totals = daily.daily_totals(make(rows, "window_start timestamp, trade_count_sum bigint"), "window_start",
                                "trade_count_sum")
    assert daily.total_stats(totals, "trade_count_sum").first().asDict() == golden.DAILY_STATISTICS
    top = totals.orderBy(F.desc("trade_count_sum")).first()
    assert (top.date, top.trade_count_sum) == (date(2026, 2, 5), 17_520)


def test_published_week_ids_are_mondays(spark):
    first = date.fromisoformat(golden.FIRST_WEEK)
    weeks = spark.range(golden.N_WEEKS).select(
        F.date_add(F.lit(first), (F.col("id") * 7).cast("int")).cast("timestamp").alias("week_start")
    )
    got = metrics.named_week(weeks, " - ")
    assert got.where(clock.week_start("week_start") != F.col("week_start")).count() == 0
    labels = [r.week_label for r in got.orderBy("week_id").collect()]
    assert (labels[0], labels[-1]) == ("Dec 15, 2025 - Dec 21, 2025", "Apr 27, 2026 - May 03, 2026")


def test_equal_times_give_one_answer_for_any_partitioning(make):
    rows = [("A", f"2024-01-01 00:00:0{i % 2}", float(i % 5)) for i in range(40)]
    ticks = make(rows, "symbol string, t string, price double").selectExpr("symbol", "cast(t AS timestamp) ts_event", "price", "1 size")
    found = set()
    for n in (1, 3, 8):
        by_symbol = bars.trade_bars_by_symbol(ticks.repartition(n, "price")).orderBy("second").collect()
        every = bars.trade_bars(ticks.repartition(n, "price")).orderBy("second").collect()
        found.add((tuple(r["futures_last_trade_price_1s"] for r in by_symbol), tuple(r["underlying_trade_price"] for r in every)))
    assert found == {((4.0, 4.0), (4.0, 4.0))}


def test_candidate_keys_are_found(spark, make):
    base = spark.range(4000)
    df = base.selectExpr(
        "concat('T', id div 10) AS ticker", "concat('M', id % 5) AS market_ticker", "id AS payload",
        "timestamp_seconds(id % 10) AS second", "timestamp_seconds(if(id % 100 = 0, 0, id)) AS observed_time",
        "if(id < 3990, timestamp_seconds(id), NULL) AS close_time", "timestamp_seconds(id div 100) AS date_hour",
    )
    got = {(r.contract_column, r.time_column): (r.n_rows, r.n_null, r.duplicates, r.verdict) for r in profile.candidate_keys(df).collect()}
    assert len(got) == 8
    assert got["ticker", "second"] == (4000, 0, 0, "key")
    assert got["ticker", "close_time"] == (4000, 10, 0, "nearly")
    # The 40 rows at moment 0 belong to 40 tickers, but to one market.
    assert got["ticker", "observed_time"] == (4000, 0, 0, "key")
    assert got["market_ticker", "observed_time"] == (4000, 0, 39, "nearly")
    assert got["market_ticker", "second"] == (4000, 0, None, "no") and got["ticker", "date_hour"][3] == "no"
    empty = make([], "ticker string, second timestamp")
    assert [tuple(r)[2:] for r in profile.candidate_keys(empty).collect()] == [(0, 0, None, "no")]
    with pytest.raises(ValueError):
        profile.candidate_keys(df.select("payload"))
    found = profile.candidate_keys(df)
    found.collect()
    plan = found._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # The sketches are read twice and made once; no pair has a pass of its own.
    assert "Expand" not in plan and plan.count("Range (0, 4000") - plan.count("ReusedExchange") <= 2


def test_statistics_come_from_footers(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).selectExpr("id", "if(id % 4 = 0, NULL, id / 8) AS price", "cast(id AS string) AS text", "timestamp_seconds(id) AS at").repartition(3).write.parquet(path)
    footers = tables.scan_footers(spark, path)
    got = profile.file_statistics(footers)
    assert {r["column"]: tuple(r)[1:] for r in got.collect()} == {"id": (1000, 1000, "0", "999"), "price": (1000, 750, "0.125", "124.875")}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*), COUNT(id), MIN(id)" in plan.replace("`", "")
    assert profile.row_count(footers).first().n_rows == 1000
    with pytest.raises(ValueError, match="text, at"):
        profile.file_statistics(footers, ["id", "text", "at"])
    # Later scans are plain ones again.
    assert "PushedAggregation" not in spark.read.parquet(path).agg(F.min("id"))._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("how", ["left", "inner"])
def test_a_key_with_half_of_all_rows_is_dealt_out(spark, how):
    left = spark.range(20_000).selectExpr("if(id % 2 = 0, 7, id % 997) AS k", "if(id % 50 = 0, NULL, 'x') AS s", "id")
    right = spark.range(0, 900, 2).selectExpr("id AS rk", "'x' AS rs", "id * 3 AS found").unionAll(spark.sql("SELECT 7L, 'x', seq FROM (SELECT explode(sequence(100L, 102L)) AS seq)"))
    joined = skew.frequent_join(left, right, {"k": "rk", "s": "rs"}, ["id"], how, part_rows=500)
    plain = left.join(right, (left.k == right.rk) & (left.s == right.rs), how).select("k", "s", "id", "found")
    assert joined.columns == ["k", "s", "id", "found"]
    assert joined.exceptAll(plain).count() == 0 and plain.exceptAll(joined).count() == 0
    hot = skew.frequent_keys(left, ["k"], ["id"], 500).collect()
    assert [r.k for r in hot] == [7] and 15 <= hot[0]["_salts"] <= 30
    # Dealt by key and salt, no part holds much more than its share.
    salts = hot[0]["_salts"]
    parts = left.where("k = 7").groupBy(F.pmod(F.xxhash64("id", F.lit(1)), F.lit(salts))).count().collect()
    assert len(parts) == salts and max(r["count"] for r in parts) < 2 * 10_000 / salts
    with pytest.raises(ValueError):
        skew.frequent_join(left, right, {"k": "rk"}, ["id"], "full")


def test_few_frequent_keys_are_listed(spark, monkeypatch):
    monkeypatch.setattr(skew, "MAX_KEYS", 3)
    df = spark.range(10_000).selectExpr("id % 100 AS k", "id")
    assert skew.frequent_keys(df, ["k"], ["id"], 16).count() <= 3


def test_ticks_of_one_moment_keep_the_order_of_their_files(spark, tmp_path):
    """Many equal times over several files, against the engine that numbers file rows itself."""
    path = str(tmp_path / "ticks")
    for part in range(4):
        spark.range(500).selectExpr(
            "timestamp_micros(1704067200000000 + (id div 50) * 60000000) AS timestamp", "if(id % 3 = 0, 'A', 'B') AS symbol",
            f"if(id % 97 = 0, 6e11, 100 + (id * {part + 3}) % 41) + {part} * 0.5 AS mid_price", f"concat('r', (id + {part}) % 3) AS vol_regime",
        ).coalesce(1).write.parquet(f"{path}/part={part}")
    ticks = tables.with_source_row(spark.read.parquet(path)).withColumns(
        {c: F.lit(None).cast("double") for c in ("spread", "spread_bps", "rv_60s", "trade_count", "trade_volume")} | {"event_large_move": F.lit(False)}
    )
    got = {(r.window_start, r.symbol): (r.futures_open, r.futures_close, r.vol_regime) for r in bars.ohlc_bars(ticks).collect()}
    again = {(r.window_start, r.symbol): (r.futures_open, r.futures_close, r.vol_regime) for r in bars.ohlc_bars(ticks.repartition(7)).collect()}
    duck = duckdb.connect()
    duck.execute("SET TimeZone = 'UTC'")
    rows = duck.execute(f"""
        SELECT CAST(time_bucket(INTERVAL 15 MINUTE, CAST(timestamp AS TIMESTAMP)) AS TIMESTAMP), symbol, mid_price, vol_regime
        FROM read_parquet('{path}/*/*.parquet', filename = true, file_row_number = true) ORDER BY timestamp, filename, file_row_number""").fetchall()
    expected = {}
    for window, symbol, price, regime in rows:
        first = expected.get((window, symbol), (price,))[0]
        expected[window, symbol] = (first, price, regime)
    assert got == again == expected and len(got) == 2
    trades = ticks.selectExpr("timestamp AS ts_event", "mid_price AS price", "1d AS size", "symbol", "source_row")
    last = {r.second: (r.underlying_trade_price, r.underlying_trade_symbol) for r in bars.trade_bars(trades).collect()}
    assert last == {r[0]: r[1:] for r in duck.execute(f"""
        SELECT CAST(timestamp AS TIMESTAMP), last(mid_price ORDER BY filename, file_row_number), last(symbol ORDER BY filename, file_row_number)
        FROM read_parquet('{path}/*/*.parquet', filename = true, file_row_number = true) GROUP BY 1""").fetchall()}
    # Aggregates on the order stay hash aggregates.
    plan = bars.ohlc_bars(ticks)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortAggregate") <= 2


def test_values_of_any_size_order_ticks_without_a_place(make):
    rows = [("2024-01-01", "A", x) for x in (5e11, 6e11, 1.0)]
    df = make(rows, "t string, symbol string, price double").selectExpr("cast(t AS timestamp) AS ts_event", "price", "1d AS size", "symbol")
    assert bars.trade_bars(df).first().underlying_trade_price == 6e11


def test_distinct_counts_without_expanding_rows(spark, make):
    rows = [("w", "a", 1), ("w", "a", 2), ("w", None, 1), ("w", "b", None), (None, "a", 1), ("v", None, None)]
    df = make(rows, "week string, name string, n int")
    counted = summary.distinct_counts(df, ["week"], ["name", "n"], ["name"])
    assert sorted(map(tuple, counted.collect()), key=str) == sorted([("w", 3, 2), (None, 1, 1), ("v", 1, 0)], key=str)
    assert "Expand" not in counted._jdf.queryExecution().optimizedPlan().toString()
    many = spark.range(50_000).selectExpr("id % 3 AS g", "id % 7001 AS a", "concat('x', id % 97) AS b")
    assert sorted(map(tuple, summary.distinct_counts(many, ["g"], ["a", "b"]).collect())) == [(g, 7001, 97) for g in range(3)]

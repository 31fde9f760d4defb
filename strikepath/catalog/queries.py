"""Registered queries: one per operator, view and profile, over the whole test tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strikepath import roles
from strikepath.catalog.present import content, present
from strikepath.functions import aggregates as agg
from strikepath.functions import buckets, clock, prices
from strikepath.operators import (
    bars,
    daily,
    display,
    enrich,
    filters,
    match,
    metrics,
    micro,
    panel,
    profile,
    sample,
    stats,
    summary,
)
from strikepath.plans import trade_enrichment, views, weekly_contracts, weekly_markets
from strikepath.session import scratch_path
from strikepath.sources import adapters, colocated, tables

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WEEK = ["week_id"]
CONTRACT = ["week_id", "ticker"]


class Data:
    """Role tables and common intermediate frames of one data folder, all lazy."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir.rstrip("/")

    def load(self, name: str) -> DataFrame:
        return adapters.load(self.spark, self.sf_dir, name)

    def file(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def scratch(self, name: str) -> str:
        return scratch_path(self.spark, name)

    @cached_property
    def micro(self) -> DataFrame:
        return adapters.micro_1s(self.spark, self.sf_dir)

    @cached_property
    def markets(self) -> DataFrame:
        return match.clean_markets(adapters.markets(self.spark, self.sf_dir))

    @cached_property
    def labels(self) -> DataFrame:
        return match.clean_labels(adapters.labels(self.spark, self.sf_dir))

    @cached_property
    def trades(self) -> DataFrame:
        return adapters.trades(self.spark, self.sf_dir)

    @cached_property
    def bars(self) -> DataFrame:
        return bars.ohlc_bars(self.micro)

    @cached_property
    def leading(self) -> DataFrame:
        return bars.keep_dominant(self.bars)

    @cached_property
    def matches(self) -> DataFrame:
        return match.threshold_matches(self.markets, self.leading)

    @cached_property
    def quotes(self) -> DataFrame:
        """Panel without decision columns, with week and buckets."""
        base = panel.with_week(adapters.contract_quotes(self.spark, self.sf_dir))
        return self._named(panel.with_buckets(base))

    @cached_property
    def contracts(self) -> DataFrame:
        """Whole panel with week and buckets, no changes."""
        base = panel.with_week(adapters.contract_1s(self.spark, self.sf_dir))
        return self._named(panel.with_buckets(base))

    @cached_property
    def moves(self) -> DataFrame:
        """Features without decision columns."""
        return panel.panel_features(adapters.contract_quotes(self.spark, self.sf_dir))

    @cached_property
    def features(self) -> DataFrame:
        return panel.panel_features(
            adapters.contract_1s(self.spark, self.sf_dir),
            sampled_from=adapters.contract_quotes(self.spark, self.sf_dir),
        )

    @cached_property
    def decisions(self) -> DataFrame:
        return summary.decision_times(self.contracts)

    @cached_property
    def summary(self) -> DataFrame:
        return summary.contract_summary(self.contracts)

    @cached_property
    def contract_moves(self) -> DataFrame:
        return views.contract_moves(self.moves, self.quotes)

    @cached_property
    def micro_frame(self) -> DataFrame:
        return views.micro_frame(self.quotes)

    @staticmethod
    def _named(df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                "week_id": clock.week_id("week_start"),
                "yes_price_cents": F.col("kalshi_yes_price"),
                "no_price_cents": F.col("kalshi_no_price"),
            }
        )


def query(name: str):
    def register(build: Callable[[Data], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: present(build(Data(spark, sf_dir)))
        return build

    return register


# --- scans, sources, sinks ---------------------------------------------------


@query("s01_scan_projection")
def _(d):
    return tables.scan(d.spark, d.file("events"), ["event_id", "ts", "value"])


@query("s02_read_columns")
def _(d):
    return d.trades.select("ts_event", "price", "size", "symbol")


@query("s03_week_read")
def _(d):
    root = d.scratch("week-read")
    named = d.leading.withColumn("week_id", clock.week_id("week_start"))
    tables.write_product(named, root, "futures_15m_windows", ("window_start",))
    return tables.read_product(d.spark, root, "futures_15m_windows", named.schema, "2024-01-08").select(
        "week_id", "window_start", "symbol", "futures_close", "trade_count_sum"
    )


@query("s04_csv_read")
def _(d):
    path = d.scratch("index-csv")
    index = metrics.named_week(bars.dominant_symbols(d.bars), " - ")
    tables.write_csv(
        index.select(
            "week_id",
            "week_label",
            F.to_date("week_start").alias("week_start"),
            F.concat(F.lit("weeks/"), "week_id").alias("week_path"),
        ),
        path,
    )
    return tables.read_csv(d.spark, path, roles.WEEK_INDEX)


@query("s05_weekly_write")
def _(d):
    root = d.scratch("weekly-write")
    tables.write_product(d.summary, root, "contract_summary", ("contract_close_time", "ticker"))
    return tables.read_product(d.spark, root, "contract_summary").select(
        "week_id", "ticker", "contract_close_time", "inferred_winner", "underlying_close", "total_trade_count"
    )


@query("s06_csv_write")
def _(d):
    path = d.scratch("daily-csv")
    tables.write_csv(daily.daily_totals(d.leading, "window_start", "trade_count_sum"), path)
    return tables.read_csv(d.spark, path, roles.schema(("date", roles.DATE), ("trade_count_sum", roles.LONG)))


@query("s07_rewrite_enriched")
def _(d):
    root = d.scratch("rewrite")
    base = d.quotes.select("week_id", "ticker", "second", "observed_at", "underlying_value")
    tables.write_product(base, root, "contract_evolution_1s", ("ticker", "second"))
    found = bars.trade_bars(d.trades)
    tables.rewrite_product(
        d.spark,
        root,
        "contract_evolution_1s",
        lambda df: enrich.attach_trades_by_second(df, found),
    )
    return tables.read_product(d.spark, root, "contract_evolution_1s").select(
        "week_id", "ticker", "observed_at", "underlying_trade_price", "has_underlying_trade_price"
    )


@query("s08_union_sources")
def _(d):
    split = F.lit(adapters.PERIOD_SPLIT).cast("timestamp")
    late = d.bars.where(F.col("window_start") >= split)
    early = d.bars.where(F.col("window_start") < split).drop("vol_regime")
    return tables.union_all([early, late]).select("window_start", "symbol", "trade_count_sum", "vol_regime")


@query("s09_first_source_per_week")
def _(d):
    named = d.bars.withColumn("week_id", clock.week_id("week_start"))
    behavior = match.window_behavior(d.labels, d.leading).withColumn("week_id", clock.week_id("week_start"))
    by_second = enrich.attach_trades_by_second(d.quotes, bars.trade_bars(d.trades))
    strict = enrich.attach_trades_strict(d.quotes, bars.trade_bars_by_symbol(d.trades))
    # A panel row without a trade is no count of trades.
    traded = strict.where(F.col("has_futures_trade_1s"))
    # Windows first; the panel products only stand in for a week that has none.
    sources = [
        ("futures_label_window_behavior", behavior, "window_start", "trade_count_sum"),
        ("futures_15m_windows", named, "window_start", "trade_count_sum"),
        ("contract_evolution_1s", traded, "second", "futures_trade_count_1s"),
        ("contract_plot_sample", by_second, "second", "underlying_trade_count"),
    ]
    return tables.first_source_totals(sources)


# --- projections, filters, predicates ----------------------------------------


@query("p01_fixed_projection")
def _(d):
    return adapters.contract_1s(d.spark, d.sf_dir).select(*roles.CONTRACT_1S.names)


@query("p02_tolerant_projection")
def _(d):
    return roles.keep_existing(d.quotes, "ticker", "observed_at", "trade_px", "best_bid", "quote_spread", "best_ask")


@query("p03_computed_columns")
def _(d):
    return d.markets


@query("p04_alias_columns")
def _(d):
    return d.quotes.select("ticker", "observed_at", "kalshi_yes_price", "yes_price_cents", "no_price_cents")


@query("p05_drop_columns")
def _(d):
    return d.labels.drop("has_gap", "decision_point", "close_start", "no_such_column")


@query("p06_not_null")
def _(d):
    return d.micro.na.drop(subset=["rv_60s", "vol_regime"]).groupBy("symbol").agg(agg.rows().alias("n_rows"))


@query("p07_equality_filter")
def _(d):
    return d.quotes.where(F.col("has_trade_this_second") & (F.col("data_source_period") == "early")).select(
        "ticker", "observed_at", "selected_futures_symbol", "data_source_period"
    )


@query("p08_threshold_counts")
def _(d):
    return d.matches.groupBy("week_start").agg(
        F.count_if(F.col("abs_distance_to_threshold") <= match.NEAR_DOLLARS).alias("n_within_100"),
        agg.rows().alias("n_markets"),
    )


@query("p09_between_closed")
def _(d):
    cents = F.col("kalshi_yes_price") * 100
    return d.quotes.groupBy("week_id").agg(
        F.count_if(cents.between(20, 80)).alias("uncertain_rows"),
        F.count_if(F.col("kalshi_yes_price").between(20, 80)).alias("uncertain_rows_as_is"),
    )


@query("p10_filter_stack")
def _(d):
    return filters.apply_filters(d.quotes, time_to_close="5-7m", moneyness=filters.ALL, source="late").select(
        "ticker", "observed_at", "time_to_close_bucket", "moneyness_bucket", "data_source_period"
    )


def _with_bad_quotes(df: DataFrame) -> DataFrame:
    """Blank some bids and cross some quotes, so all three tests have something to refuse."""
    k = F.col("yes_state_cents")
    return df.withColumns(
        {
            "best_bid": F.when(k % 17 != 0, F.col("best_bid")),
            "best_ask": F.when(k % 19 == 0, F.col("best_bid") - 1).otherwise(F.col("best_ask")),
        }
    )


@query("p11_valid_quote")
def _(d):
    ok = prices.valid_quote("best_bid", "best_ask")
    return _with_bad_quotes(d.quotes).groupBy("week_id").agg(
        F.count_if(ok).alias("valid_rows"), F.count_if(~ok).alias("invalid_rows")
    )


@query("p12_outlier_rows")
def _(d):
    big = stats.at_or_above_quantile(d.quotes, CONTRACT, "underlying_value", 0.95, "p95")
    return big.select(*CONTRACT, "observed_at", "underlying_value", "p95")


@query("p13_complete_weeks")
def _(d):
    return weekly_contracts.weeks_to_be_complete(d.moves, "data/app/weeks").select("week_id", "week_path")


# --- joins ---------------------------------------------------------------------


@query("j01_dominant_symbol_join")
def _(d):
    built = d.bars
    # One dominant symbol per week: bounded by the calendar.
    return (
        built.join(F.broadcast(bars.dominant_symbols(built)), "week_start", "left")
        .where(F.col("symbol") == F.col("dominant_symbol"))
        .select("week_start", "window_start", "symbol", "futures_close", "dominant_symbol_rows")
    )


@query("j02_label_bar_join")
def _(d):
    return match.window_behavior(d.labels, d.leading)


@query("j03_threshold_match")
def _(d):
    return d.matches


@query("j03_threshold_match_filing_week")
def _(d):
    return match.threshold_matches(d.markets, d.leading, week_of="close").select(
        "ticker", "window_start", "week_start", "futures_close", "distance_to_threshold", "threshold_band"
    )


@query("j04_full_outer_index")
def _(d):
    return metrics.week_index(d.markets, d.labels, d.leading)


@query("j05_strict_trade_join")
def _(d):
    found = bars.trade_bars_by_symbol(d.trades)
    return enrich.attach_trades_strict(d.quotes, found).select(
        "ticker", "observed_at", "selected_futures_symbol", *enrich.STRICT_COLUMNS
    )


@query("j06_second_trade_join")
def _(d):
    return enrich.attach_trades_by_second(d.quotes, bars.trade_bars(d.trades)).select(
        "ticker", "observed_at", *enrich.BY_SECOND_COLUMNS
    )


@query("j07_match_rate")
def _(d):
    enriched = enrich.attach_trades_by_second(d.quotes, bars.trade_bars(d.trades))
    return enrich.match_rate(enriched, "underlying_trade_price", "week_id")


@query("j08_decision_lookup")
def _(d):
    return views.decision_markers(d.contracts, d.decisions)


# --- aggregations ----------------------------------------------------------------


@query("a01_ohlc_15m")
def _(d):
    return d.bars.select(
        "window_start", "symbol", "week_start", "first_timestamp", "last_timestamp",
        "futures_open", "futures_close", "futures_high", "futures_low",
    )


@query("a02_bar_measures")
def _(d):
    return d.bars.select(
        "window_start", "symbol", "spread_mean", "spread_bps_mean", "trade_count_sum",
        "trade_volume_sum", "rv_60s_mean", "large_move_rows",
    )


@query("a03_last_known_regime")
def _(d):
    return d.bars.select("window_start", "symbol", "vol_regime")


@query("a04_row_counts")
def _(d):
    return bars.symbol_counts(d.bars)


@query("a05_distinct_with_null")
def _(d):
    counted = summary.distinct_counts(d.quotes, WEEK, ["inferred_winner", "selected_futures_symbol"], ["inferred_winner", "selected_futures_symbol"])
    return counted.select("week_id", F.col("n_inferred_winner").alias("n_winners"), F.col("n_selected_futures_symbol").alias("n_symbols"))


@query("a06_dominant_symbol")
def _(d):
    return bars.dominant_symbols(d.bars)


@query("a07_distinct_known")
def _(d):
    return d.contracts.groupBy("week_id").agg(F.count_distinct("inferred_winner").alias("n_winners"))


@query("a08_boolean_sums")
def _(d):
    return d.contracts.groupBy("week_id").agg(
        F.count_if("has_trade_this_second").alias("trade_seconds"),
        F.count_if("decision_found").alias("decision_rows"),
        F.count_if("is_after_decision").alias("after_decision_rows"),
    )


@query("a09_market_index")
def _(d):
    return metrics.market_index(d.markets)


@query("a10_label_index")
def _(d):
    return metrics.label_index(d.labels)


@query("a11_bar_index")
def _(d):
    return metrics.bar_index(d.leading)


@query("a12_contract_week_index")
def _(d):
    return metrics.contract_week_index(d.contracts)


@query("a13_contract_summary")
def _(d):
    return d.summary


@query("a14_decision_times")
def _(d):
    return d.decisions


@query("a15_sensitivity_bins")
def _(d):
    return summary.sensitivity_bins(d.moves)


@query("a16_threshold_heatmap")
def _(d):
    return summary.threshold_heatmap(d.moves)


@query("a17_event_window_response")
def _(d):
    return summary.event_window_response(d.quotes)


@query("a17_event_window_all_buckets")
def _(d):
    return summary.event_window_response(d.quotes, by_bucket=False)


@query("a18_trade_bars_by_symbol")
def _(d):
    return bars.trade_bars_by_symbol(d.trades)


@query("a19_trade_bars")
def _(d):
    return bars.trade_bars(d.trades)


@query("a20_daily_totals")
def _(d):
    return daily.daily_totals(d.leading, "window_start", "trade_count_sum")


@query("a20_daily_line_quantity")
def _(d):
    return daily.daily_totals(d.load("lineitem"), "l_shipdate", "l_quantity")


@query("a21_daily_statistics")
def _(d):
    totals = daily.daily_totals(d.leading, "window_start", "trade_count_sum")
    return daily.total_stats(totals, "trade_count_sum")


@query("a22_two_level_daily")
def _(d):
    split = F.lit(adapters.PERIOD_SPLIT).cast("timestamp")
    parts = [d.bars.where(F.col("window_start") < split), d.bars.where(F.col("window_start") >= split)]
    return daily.daily_totals(tables.union_all(parts), "window_start", "trade_count_sum", "trade_count")


@query("a23_market_metrics")
def _(d):
    return metrics.market_metrics(d.markets, d.labels, d.leading, d.matches)


@query("a24_contract_metrics")
def _(d):
    return metrics.contract_metrics(d.contracts)


@query("a24_contract_metrics_as_is")
def _(d):
    return metrics.contract_metrics(d.contracts, price_unit="as_is")


@query("a25_per_second_frame")
def _(d):
    return micro.per_second(display.with_underlying_series(display.with_underlying_columns(d.quotes)))


@query("a26_underlying_per_second")
def _(d):
    return d.quotes.groupBy("week_id", "second").agg(agg.exact_mean("underlying_value").alias("underlying_value"))


@query("a27_category_counts")
def _(d):
    return stats.category_counts(d.contracts, WEEK, "inferred_winner")


@query("a28_describe")
def _(d):
    return stats.describe(d.quotes, WEEK, "underlying_value", ["observed_at"])


@query("a28_describe_order_price")
def _(d):
    return stats.describe(d.load("orders"), ["o_orderpriority"], "o_totalprice")


@query("a29_quantiles")
def _(d):
    return stats.exact_quantiles(d.quotes, WEEK, "abs_z_bps", {"p95": 0.95, "p99": 0.99}, ["observed_at"])


@query("a29_contract_p95")
def _(d):
    return stats.exact_quantiles(d.quotes, CONTRACT, "abs_z_bps", {"p95": 0.95})


@query("a30_micro_kpis")
def _(d):
    return micro.micro_kpis(d.micro_frame)


@query("a31_histogram")
def _(d):
    return stats.histogram(d.quotes, WEEK, "abs_z_bps", 60, "time_to_close_bucket", per_week=True)


@query("a31_histogram_line_price")
def _(d):
    return stats.histogram(d.load("lineitem"), ["l_returnflag"], "l_extendedprice", 50)


@query("a32_box_stats")
def _(d):
    return stats.box_stats(d.quotes, ["week_id", "time_to_close_bucket"], "trade_size")


@query("a33_pivot_mean")
def _(d):
    return stats.pivot_mean(
        d.quotes, ["week_id", "moneyness_bucket"], "time_to_close_bucket", buckets.TIME_BUCKETS, "trade_size"
    )


@query("a34_series_audit")
def _(d):
    return profile.series_audit(
        {
            "contract_evolution_1s": display.with_underlying_columns(d.quotes),
            "contract_plot_sample": d.quotes,
        }
    )


# --- windows ---------------------------------------------------------------------


@query("w01_lag1_changes")
def _(d):
    return d.moves.select("ticker", "observed_at", "yes_price_change_1s", "underlying_change_1s")


@query("w02_lag5_changes")
def _(d):
    return d.moves.select("ticker", "observed_at", "yes_price_change_5s", "underlying_change_5s")


@query("w03_sampled_lag")
def _(d):
    return views.filtered_move_pairs(d.moves, d.quotes, time_to_close="10-15m")


@query("w03_lag_all_rows")
def _(d):
    return views.filtered_move_pairs(d.moves, d.quotes)


@query("w04_contract_path_moves")
def _(d):
    return d.contract_moves.select(
        "ticker", "observed_at", "yes_price_change_1s_display", "yes_price_change_5s_display",
        "abs_yes_price_change_5s_display",
    )


@query("w05_series_difference")
def _(d):
    return d.micro_frame.select("week_id", "second", "underlying_change_1s")


@query("w06_log_return_bps")
def _(d):
    return d.micro_frame.select("week_id", "second", "underlying_return_1s_bps")


@query("w07_local_vol_60")
def _(d):
    return d.micro_frame.select("week_id", "second", "local_vol_60s_bps")


@query("w08_first_known")
def _(d):
    sparse = d.quotes.withColumn("trade_price", F.when(F.col("has_trade_this_second"), F.col("underlying_value")))
    return sparse.groupBy(*CONTRACT).agg(agg.first_known_by("trade_price", "observed_at").alias("reference"))


@query("w09_first_last_row")
def _(d):
    return d.quotes.groupBy(*CONTRACT).agg(
        agg.first_by("underlying_value", "observed_at").alias("underlying_open"),
        agg.last_by("underlying_value", "observed_at").alias("underlying_close"),
    )


@query("w10_rank_one")
def _(d):
    ranked = stats.top_per_group(bars.symbol_counts(d.bars), ["week_start"], 1, F.desc("rows"), "symbol")
    return ranked.select("week_start", "symbol", "rows")


# --- order, limits, samples ----------------------------------------------------------


@query("o01_multi_key_sort")
def _(d):
    return d.leading.select("week_start", "window_start", "symbol", "futures_close").orderBy(
        "week_start", "window_start", "symbol"
    )


@query("o02_mixed_sort")
def _(d):
    return bars.symbol_counts(d.bars).orderBy(F.asc("week_start"), F.desc("rows"), "symbol")


@query("o03_bucket_order")
def _(d):
    return (
        d.quotes.groupBy("time_to_close_bucket", "moneyness_bucket")
        .agg(agg.rows().alias("n_rows"))
        .withColumns({"time_order": buckets.time_ordinal(), "moneyness_order": buckets.moneyness_ordinal()})
        .orderBy("time_order", "moneyness_order")
    )


@query("o04_top25_moves")
def _(d):
    top = stats.top_per_group(d.contract_moves, CONTRACT, 25, F.desc("abs_yes_price_change_5s_display"), "observed_at")
    return top.select(*CONTRACT, "rank", "observed_at", "abs_yes_price_change_5s_display")


@query("o05_top200_decisions")
def _(d):
    decided = d.decisions.where(F.col("decision_found"))
    return (
        decided.orderBy(F.desc("minutes_before_close_at_decision"), "ticker")
        .limit(200)
        .select("ticker", "decision_time", "minutes_before_close_at_decision")
    )


@query("o06_head_rows")
def _(d):
    return d.leading.orderBy("window_start", "symbol").limit(300).select("window_start", "symbol", "futures_close")


@query("o07_option_list")
def _(d):
    return filters.options(d.quotes, "ticker").orderBy("option")


@query("o08_capped_sample")
def _(d):
    return sample.capped_sample(d.quotes, cap=150_000).select(*CONTRACT, "observed_at", "kalshi_yes_price")


@query("o08_capped_sample_small")
def _(d):
    return sample.capped_sample(d.quotes, cap=500).select(*CONTRACT, "observed_at", "kalshi_yes_price")


# --- set operations -------------------------------------------------------------------


@query("u01_union_all")
def _(d):
    split = F.col("data_source_period") == "early"
    parts = tables.union_all([d.quotes.where(split), d.quotes.where(~split)])
    return parts.select("ticker", "observed_at", "data_source_period")


@query("u02_distinct_on_key")
def _(d):
    return summary.decision_times(d.quotes.withColumn("decision_found", F.lit(None).cast("boolean"))).select(
        "week_id", "ticker", "inferred_winner", "outcome_yes", "data_source_period"
    )


@query("u03_distinct_values")
def _(d):
    return d.micro.where(F.col("vol_regime").isNotNull()).select("vol_regime").distinct()


# --- time functions ----------------------------------------------------------------------


@query("t01_microsecond_times")
def _(d):
    return d.load("events").select("event_id", "ts", F.unix_micros("ts").alias("ts_us"))


@query("t02_week_truncation")
def _(d):
    return d.load("orders").select("o_orderkey", clock.week_start("o_orderdate").alias("week_start"))


@query("t03_window_truncation")
def _(d):
    return d.load("events").select("event_id", clock.floor_to("ts").alias("window_start"))


@query("t04_second_floor")
def _(d):
    return d.load("events").select("event_id", clock.floor_second("ts").alias("second"))


@query("t05_time_shift")
def _(d):
    return d.load("events").select(
        "event_id",
        (F.col("ts") - F.expr("INTERVAL 15 MINUTES")).alias("earlier"),
        clock.minus_minutes("ts", F.col("value")).alias("earlier_by_value"),
    )


@query("t06_whole_seconds")
def _(d):
    return d.load("events").select("event_id", clock.whole_seconds("ts", clock.week_start("ts")).alias("into_week"))


@query("t07_date_format")
def _(d):
    return d.load("orders").select("o_orderkey", F.date_format("o_orderdate", clock.ID_FORMAT).alias("close_date"))


@query("t08_week_label")
def _(d):
    weeks = d.load("lineitem").select(clock.week_start("l_shipdate").alias("week_start")).distinct()
    return weeks.select(
        "week_start",
        clock.week_label("week_start").alias("week_label"),
        clock.week_label("week_start", " - ").alias("index_label"),
    )


@query("t09_label_from_id")
def _(d):
    ids = d.load("orders").select(
        F.when(F.col("o_orderkey") % 7 == 0, F.col("o_orderpriority"))
        .otherwise(clock.week_id(clock.week_start("o_orderdate")))
        .alias("week_id")
    )
    return ids.distinct().select("week_id", clock.week_label_from_id("week_id").alias("week_label"))


@query("t10_coercing_parse")
def _(d):
    text = F.when(F.col("event_id") % 11 == 0, F.col("event_type")).otherwise(
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    )
    return d.load("events").select("event_id", clock.parse_time(text).alias("ts_event"))


@query("t11_calendar_date")
def _(d):
    return d.load("lineitem").groupBy(F.to_date("l_shipdate").alias("date")).agg(agg.rows().alias("n_rows"))


@query("t12_decision_marker")
def _(d):
    minutes = F.col("minutes_before_close_at_decision")
    marker = F.when(F.col("decision_found") & minutes.isNotNull(), clock.minus_minutes("contract_close_time", minutes))
    return d.decisions.select("ticker", marker.alias("decision_marker"))


@query("t13_decision_zone")
def _(d):
    rows = d.quotes.withColumn("close_marker", F.col("contract_close_time"))
    return views.decision_zone(rows).groupBy(*CONTRACT, "zone_start", "zone_end").agg(
        F.count_if("in_zone").alias("rows_in_zone")
    )


# --- expressions ------------------------------------------------------------------------------


@query("f01_cents")
def _(d):
    return d.markets.select("ticker", "last_price_cents", "yes_ask_cents", "yes_bid_cents", "spread_cents")


@query("f02_yes_mid")
def _(d):
    return d.markets.select("ticker", "yes_mid_cents")


@query("f03_quote_mid_spread")
def _(d):
    return _with_bad_quotes(d.quotes).select(
        "ticker",
        "observed_at",
        prices.quote_mid("best_bid", "best_ask").alias("underlying_quote_mid"),
        prices.quote_spread("best_bid", "best_ask").alias("quote_spread"),
    )


@query("f04_change_and_return")
def _(d):
    return d.bars.select("window_start", "symbol", "futures_change", "futures_return_pct")


@query("f05_strike_distance")
def _(d):
    return d.matches.select("ticker", "distance_to_threshold", "abs_distance_to_threshold")


@query("f06_distance_bps")
def _(d):
    return d.matches.select("ticker", "distance_to_threshold_bps")


@query("f07_moneyness_of_strike")
def _(d):
    return match.strike_moneyness_bps(d.matches).select("ticker", "moneyness_bps_strike")


@query("f08_threshold_band")
def _(d):
    return match.band_counts(d.matches)


@query("f09_moneyness_bucket")
def _(d):
    return d.quotes.groupBy("moneyness_bucket").agg(agg.rows().alias("n_rows"))


@query("f10_time_bucket")
def _(d):
    return d.quotes.groupBy("time_to_close_bucket").agg(agg.rows().alias("n_rows"))


@query("f11_uncertainty_bucket")
def _(d):
    as_is = buckets.uncertainty_bucket("kalshi_yes_price").alias("uncertainty_as_is")
    return d.quotes.groupBy("uncertainty_bucket", as_is).agg(agg.rows().alias("n_rows"))


@query("f12_directions")
def _(d):
    return match.window_behavior(d.labels, d.leading).select("window_start", "window_direction", "futures_direction")


@query("f13_absolute_value")
def _(d):
    return d.moves.select("ticker", "observed_at", "abs_yes_price_change_5s", "abs_underlying_change_5s")


@query("f14_natural_log")
def _(d):
    return d.quotes.select("ticker", "observed_at", F.ln("underlying_value").alias("log_underlying"))


@query("f15_coercing_number")
def _(d):
    text = F.when(F.col("event_id") % 13 == 0, F.col("event_type")).otherwise(F.col("value").cast("string"))
    return d.load("events").select("event_id", clock.parse_number(text).alias("number"))


@query("f16_dollar_detection")
def _(d):
    both = d.quotes.withColumns(
        {"in_dollars": F.col("kalshi_yes_price"), "in_cents": F.col("yes_state_cents"), "empty": F.lit(None).cast("double")}
    )
    return display.unit_facts(both, ["in_dollars", "in_cents", "empty", "underlying_value"])


@query("f17_display_prices")
def _(d):
    return display.with_display_prices(d.quotes).select(
        "ticker", "observed_at", "yes_price_cents_display", "no_price_cents_display"
    )


@query("f17_display_prices_any_column")
def _(d):
    stored = d.moves.withColumns({"yes_price_cents": F.col("yes_state_cents"), "no_price_cents": F.col("no_state_cents")})
    return display.with_display_prices(stored, any_column=True).select(
        "ticker", "observed_at", "yes_price_cents_display", "yes_price_change_5s_display"
    )


@query("f18_underlying_series")
def _(d):
    # The later period has no quotes, so its weeks fall back to the modelling value.
    mixed = d.quotes.withColumn("best_bid", F.when(F.col("data_source_period") == "early", F.col("best_bid")))
    return display.with_underlying_series(display.with_underlying_columns(mixed)).select(
        "week_id", "ticker", "observed_at", "underlying_series", "underlying_source_column"
    )


@query("f19_trade_price_choice")
def _(d):
    late = F.col("data_source_period") == "late"
    mixed = d.quotes.withColumns(
        {"last_price": F.col("underlying_value"), "trade_price": F.when(late, F.col("underlying_value") + 1)}
    )
    return display.with_trade_price(mixed).select("ticker", "observed_at", "underlying_trade_price")


@query("f20_distance_choice")
def _(d):
    late = F.col("data_source_period") == "late"
    mixed = d.quotes.withColumn("distance_to_threshold", F.when(late, F.col("underlying_diff")))
    return views.distance_path(mixed).select("ticker", "second", "distance", "distance_label", "band", "in_band")


@query("f21_post_join_fill")
def _(d):
    return enrich.attach_trades_strict(d.quotes, bars.trade_bars_by_symbol(d.trades)).groupBy("week_id").agg(
        F.sum("futures_trade_count_1s").alias("trade_count"),
        F.sum("futures_trade_size_1s").alias("trade_size"),
        F.count_if("has_futures_trade_1s").alias("matched_rows"),
    )


@query("f22_bucket_ordinals")
def _(d):
    return d.quotes.select(
        "ticker",
        "observed_at",
        buckets.time_ordinal().alias("time_order"),
        buckets.moneyness_ordinal().alias("moneyness_order"),
    )


@query("f23_metric_lookup")
def _(d):
    long = metrics.market_metrics(d.markets, d.labels, d.leading, d.matches)
    return long.groupBy("week_id").agg(
        metrics.metric("label_windows").alias("label_windows"),
        metrics.metric("no_such_metric", metrics.metric("kalshi_markets", 0.0)).alias("fallback"),
        metrics.metric("no_such_metric", -1.0).alias("default_value"),
    )


@query("f24_null_label")
def _(d):
    return d.contracts.select("ticker", F.coalesce("inferred_winner", F.lit("Unknown")).alias("winner")).distinct()


@query("f25_concatenation")
def _(d):
    index = metrics.named_week(bars.dominant_symbols(d.bars))
    return index.select(
        "week_id",
        F.concat("week_label", F.lit("  ("), "week_id", F.lit(")")).alias("display"),
        F.concat(F.lit("data/app/weeks/"), "week_id").alias("week_path"),
    )


# --- views ---------------------------------------------------------------------------------------


@query("v01_week_kpis")
def _(d):
    market = metrics.market_metrics(d.markets, d.labels, d.leading, d.matches)
    return views.week_kpis(metrics.contract_metrics(d.contracts), market)


@query("v02_yes_change_histogram")
def _(d):
    return views.yes_change_histogram(d.summary)


@query("v03_outcomes")
def _(d):
    return views.outcomes(d.summary)


@query("v04_underlying_path")
def _(d):
    return views.underlying_path(d.quotes)


@query("v04_underlying_path_fallback")
def _(d):
    early = F.col("data_source_period") == "early"
    sparse = d.quotes.withColumns(
        {c: F.when(early, F.col(c)) for c in ("underlying_value", "best_bid", "best_ask")}
    )
    return views.underlying_path(sparse, d.leading)


@query("v05_decision_histogram")
def _(d):
    return views.decision_histogram(d.decisions)


@query("v06_contract_metadata")
def _(d):
    return views.contract_metadata(d.quotes)


@query("v07_move_histogram")
def _(d):
    return views.move_histogram(d.contract_moves)


@query("v08_move_boxes")
def _(d):
    return views.move_boxes(d.contract_moves)


@query("v09_largest_moves")
def _(d):
    return views.largest_moves(d.contract_moves, 25)


@query("v10_combined_path")
def _(d):
    return views.combined_path(d.quotes, d.decisions)


@query("v11_distance_path")
def _(d):
    return views.distance_path(d.quotes)


@query("v12_micro_kpis")
def _(d):
    return micro.micro_kpis(d.micro_frame)


@query("v13_micro_series")
def _(d):
    return views.micro_series(d.micro_frame)


@query("v14_spread_vs_volatility")
def _(d):
    return views.spread_vs_volatility(d.micro_frame)


@query("v15_decision_shares")
def _(d):
    return views.decision_shares(d.decisions)


@query("v16_decision_statistics")
def _(d):
    return views.decision_statistics(d.decisions)


@query("v17_decision_table")
def _(d):
    return views.decision_table(d.decisions, 200)


@query("v18_heatmap_matrix")
def _(d):
    return views.heatmap_matrix(summary.threshold_heatmap(d.moves))


@query("v19_distance_histogram")
def _(d):
    return views.distance_histogram(d.quotes, moneyness="Far")


@query("v19_distance_histogram_all")
def _(d):
    return views.distance_histogram(d.quotes)


@query("v20_distance_vs_response")
def _(d):
    return views.distance_vs_response(d.moves, d.quotes, source="late")


@query("v20_distance_vs_response_all")
def _(d):
    return views.distance_vs_response(d.moves, d.quotes)


@query("v21_move_pairs")
def _(d):
    return views.move_pairs(d.moves)


@query("v22_sensitivity_curve")
def _(d):
    return views.sensitivity_curve(summary.sensitivity_bins(d.moves))


@query("v23_preview_summary")
def _(d):
    return views.product_preview(d.summary, 200, "contract_close_time", "ticker")


@query("v23_preview_evolution")
def _(d):
    return views.evolution_preview(d.quotes, 300)


@query("v23_preview_decisions")
def _(d):
    return views.product_preview(d.decisions, 200, "contract_close_time", "ticker")


@query("v23_preview_sample")
def _(d):
    sampled = d.moves.select(
        "week_id", "ticker", "observed_at", "yes_price_change_5s", "moneyness_bucket", "time_to_close_bucket"
    )
    return views.product_preview(sampled, 200, "ticker", "observed_at")


@query("v24_price_audit")
def _(d):
    evolution = enrich.attach_trades_by_second(d.quotes, bars.trade_bars(d.trades))
    return views.price_audit(evolution, d.quotes)


@query("v25_filter_options")
def _(d):
    return views.filter_options(d.quotes)


# --- profiles ---------------------------------------------------------------------------------------


@query("d01_row_count")
def _(d):
    return profile.row_count(tables.scan_footers(d.spark, d.file("events")))


@query("d01_file_statistics")
def _(d):
    columns = ["l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice"]
    found = profile.file_statistics(tables.scan_footers(d.spark, d.file("lineitem")), columns)
    return found.withColumns({c: F.col(c).cast("double") for c in ("min", "max")})


@query("d02_time_ranges")
def _(d):
    return profile.time_ranges(d.quotes)


@query("d03_id_sample")
def _(d):
    return profile.id_samples(d.quotes, "ticker", 20)


@query("d03_distinct_counts")
def _(d):
    return profile.distinct_count(d.quotes, "ticker", "futures_symbol")


@query("d04_numeric_ranges")
def _(d):
    return profile.numeric_ranges(d.quotes)


@query("d05_duplicate_keys")
def _(d):
    return profile.duplicate_keys(d.quotes, "selected_futures_symbol", "second")


def _sparse_count(df: DataFrame, column: str) -> DataFrame:
    """A count that is NULL on some rows, as a double."""
    return df.withColumn(column, F.col(column).cast("double"))


@query("d05_candidate_keys")
def _(d):
    return _sparse_count(profile.candidate_keys(d.quotes, profile.id_columns(d.quotes)), "duplicates")


@query("d05_candidate_keys_lines")
def _(d):
    found = profile.candidate_keys(d.load("lineitem"), ["l_orderkey", "l_partkey", "l_suppkey"], ["l_linenumber", "l_shipdate"])
    return _sparse_count(found, "duplicates")


@query("d06_file_coverage")
def _(d):
    return profile.file_coverage(tables.with_file(d.load("events")), "ts", "event_type")


@query("d06_file_coverage_lineitem")
def _(d):
    return profile.file_coverage(tables.with_file(d.load("lineitem")), "l_shipdate", "l_returnflag")


@query("d07_complete_week_index")
def _(d):
    return weekly_contracts.weeks_to_be_complete(d.moves, "data/app/weeks")


@query("d08_known_trade_prices")
def _(d):
    strict = enrich.attach_trades_strict(d.quotes, bars.trade_bars_by_symbol(d.trades))
    by_second = enrich.attach_trades_by_second(d.quotes, bars.trade_bars(d.trades))
    return enrich.known_values(
        {"contract_evolution_1s": enrich.alias_strict_trades(strict), "contract_plot_sample": by_second},
        "underlying_trade_price",
    )


# --- whole builds -------------------------------------------------------------------------------------


def _contents(d: Data, root: str, written: dict[str, str]) -> DataFrame:
    names = sorted(name for name, path in written.items() if not path.endswith(".csv"))
    return tables.union_all([content(tables.read_product(d.spark, root, name), name) for name in names])


@query("e01_weekly_contract_build")
def _(d):
    root = d.scratch("contract-build")
    return _contents(d, root, weekly_contracts.build(d.spark, adapters.contract_1s(d.spark, d.sf_dir), root))


@query("e02_weekly_market_build")
def _(d):
    root = d.scratch("market-build")
    markets, labels = adapters.markets(d.spark, d.sf_dir), adapters.labels(d.spark, d.sf_dir)
    return _contents(d, root, weekly_markets.build(d.spark, d.micro, markets, labels, root))


def _enriched_root(d: Data) -> str:
    """Both panel products, written without trades."""
    root = d.scratch("enrichment")
    evolution = d.quotes.select("week_id", "ticker", "second", "observed_at", "selected_futures_symbol")
    for product in trade_enrichment.PRODUCTS:
        tables.write_product(evolution, root, product, ("ticker", "second"))
    return root


def _enriched(d: Data, root: str, rate: DataFrame) -> DataFrame:
    """Match rate per week beside the content of both products."""
    found = _contents(d, root, dict.fromkeys(trade_enrichment.PRODUCTS, ""))
    return found.join(rate, "week_id", "left")


@query("e03_trade_enrichment")
def _(d):
    root = _enriched_root(d)
    return _enriched(d, root, trade_enrichment.build(d.spark, d.trades, root).drop("n_rows"))


@query("e03_strict_enrichment")
def _(d):
    root = _enriched_root(d)
    return _enriched(d, root, trade_enrichment.build(d.spark, d.trades, root, strict=True).drop("n_rows"))


@query("e03_alias_enrichment")
def _(d):
    root = _enriched_root(d)
    trade_enrichment.build(d.spark, d.trades, root, strict=True)
    known = trade_enrichment.alias_build(d.spark, root).withColumnRenamed("dataset", "product")
    return _contents(d, root, dict.fromkeys(trade_enrichment.PRODUCTS, "")).join(known, ["product", "week_id"], "left")


@query("e03_by_second_after_strict")
def _(d):
    """A by-second run over strict results: its content has no column of the strict run left."""
    root = _enriched_root(d)
    trade_enrichment.build(d.spark, d.trades, root, strict=True)
    return _enriched(d, root, trade_enrichment.build(d.spark, d.trades, root).drop("n_rows"))


@query("e04_colocated_trades")
def _(d):
    """Panel and trade bars in files by second, joined where they lie."""
    panel_rows = d.quotes.select("week_id", "ticker", "second", "observed_at", "selected_futures_symbol")
    found = colocated.write_colocated(bars.trade_bars(d.trades), d.scratch("trades-by-second"), ["second"], 8)
    lying = colocated.write_colocated(panel_rows, d.scratch("panel-by-second"), ["second"], 8, ["ticker"])
    return enrich.with_trades_of_second(lying, found).drop("underlying_trade_symbol")

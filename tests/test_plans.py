"""Physical plans that matter at scale."""

import inspect
import re

from pyspark.sql import functions as F

from strikepath.operators import bars, panel, stats, summary
from strikepath.plans import views, weekly_contracts
from strikepath.sources import adapters


def initial(df):
    return df._jdf.queryExecution().executedPlan().toString()


def below_exchange(plan):
    """The part of the plan that runs before the deepest exchange."""
    return plan[plan.rindex("Exchange") :]


def test_large_inputs_are_hash_aggregated(spark, sf_dir):
    quotes = adapters.contract_quotes(spark, sf_dir)
    named = panel.with_week(quotes).withColumn("week_id", F.lit("w"))
    full = named.withColumns(
        {
            "decision_found": F.lit(True),
            "decision_time": F.col("second"),
            "minutes_before_close_at_decision": F.lit(1.0),
        }
    )
    frames = {
        "bars": bars.ohlc_bars(adapters.micro_1s(spark, sf_dir)),
        "trade bars": bars.trade_bars(adapters.trades(spark, sf_dir)),
        "summary": summary.contract_summary(full),
        "decisions": summary.decision_times(full),
        "metadata": views.contract_metadata(named),
    }
    for name, df in frames.items():
        first_stage = below_exchange(initial(df))
        assert "HashAggregate" in first_stage and "SortAggregate" not in first_stage, name
        assert "ObjectHashAggregate" not in first_stage, name


def test_scan_reads_only_needed_columns(spark, sf_dir):
    plan = initial(summary.event_window_response(_named(panel.with_buckets(panel.with_week(
        adapters.contract_quotes(spark, sf_dir))))))
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas and all(set(c.split(":")[0] for c in s.split(",")) <= {"ts", "event_type", "user_id", "value", "props"}
                           for s in schemas)


def _named(df):
    return df.withColumn("week_id", F.date_format("week_start", "yyyy-MM-dd"))


def test_both_lags_share_one_exchange_and_sort(spark, sf_dir):
    df = panel.with_changes(panel.with_week(adapters.contract_quotes(spark, sf_dir)))
    df.write.format("noop").mode("overwrite").save()
    rows = df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert rows and final.count("Sort [") == 1
    assert final.count("hashpartitioning(week_start") == 1


def test_top_rows_are_cut_before_the_exchange(spark, sf_dir):
    df = stats.top_per_group(adapters.contract_quotes(spark, sf_dir), ["ticker"], 25, F.desc("trade_size"), "second")
    assert "WindowGroupLimit" in below_exchange(initial(df))


def test_no_cross_joins_and_no_python_workers(spark, sf_dir):
    from strikepath.catalog.queries import QUERIES

    for name in ("f17_display_prices", "v11_distance_path", "a28_describe", "a31_histogram", "v10_combined_path"):
        plan = initial(QUERIES[name](spark, sf_dir))
        assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan, name
        assert "Python" not in plan, name


def test_views_read_every_row_of_a_large_week(spark):
    panel_rows = spark.range(160_000).selectExpr("'2024-01-01' AS week_id", "cast(id % 97 AS double) AS abs_z_bps", "'0-1m' AS time_to_close_bucket")
    shown = views.distance_histogram(panel_rows)
    assert shown.agg(F.sum("count")).first()[0] == 160_000
    assert inspect.signature(weekly_contracts.products).parameters["cap"].default is None


EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"


def test_panel_exchanges_events_and_not_its_columns(spark, tmp_path):
    """The join of the decisions deals out the short rows of events; the decisions come from an exchange of their own."""
    spark.createDataFrame([], EVENTS).write.parquet(f"{tmp_path}/events.parquet")
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set(name, "-1")
    try:
        plan = initial(adapters.contract_1s(spark, str(tmp_path)))
    finally:
        spark.conf.set(name, before)
    below = plan[plan.index("SortMergeJoin") :]
    assert not any(c in below for c in ("ticker", "log_moneyness", "best_bid", "px"))
    assert below.count("Exchange hashpartitioning(user_id") == 3 and re.search(r"Exchange hashpartitioning\(user_id#\d+L?, wk#\d+, deal#", below)


def test_panel_of_events_without_user_or_time(spark, tmp_path):
    """They keep their rows, find no decision and are dealt apart; repeated and undecided rows stay as well."""
    at = "2024-01-0{} 10:00:0{}"
    rows = [
        (1, at.format(2, 0), 7, 50), (2, at.format(2, 1), 7, 97), (3, at.format(2, 2), 7, 10), (3, at.format(2, 2), 7, 10), (4, at.format(9, 0), 7, 20),
        (5, None, 7, 99), (6, at.format(2, 0), 8, None), (None, None, None, 99), *[(100 + i, at.format(2, i), None, 99) for i in range(9)],
    ]
    events = spark.createDataFrame([(e, t, u, "click", 1.5, f'{{"k": {k}}}' if k is not None else None) for e, t, u, k in rows], "event_id long, ts string, user_id long, event_type string, value double, props string")
    events.withColumn("ts", F.col("ts").cast("timestamp_ntz")).write.parquet(f"{tmp_path}/events.parquet")
    name, before = "spark.sql.autoBroadcastJoinThreshold", spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    found = []
    try:
        for limit in ("-1", before):
            spark.conf.set(name, limit)
            df = adapters.contract_1s(spark, str(tmp_path))
            cells = df.selectExpr("ticker", "cast(observed_at AS string)", "cast(yes_state_cents AS int)", "decision_found", "cast(decision_time AS string)", "is_after_decision", "underlying_value")
            found.append(sorted(map(str, map(tuple, cells.collect()))))
    finally:
        spark.conf.set(name, before)

    def decided(user, t):
        return user == 7 and t is not None and t.startswith("2024-01-02")

    expected = [
        (
            f"C{u}-{'20240108' if t.startswith('2024-01-09') else '20240101'}" if u is not None and t is not None else None,
            t, k, decided(u, t), at.format(2, 1) if decided(u, t) else None, decided(u, t) and t >= at.format(2, 1), 100015.0,
        )
        for _, t, u, k in rows
    ]
    assert found == [sorted(map(str, expected))] * 2

"""Whole builds on the small test tables: files, invariants and rewrites."""

import duckdb
from pyspark.sql import functions as F

from strikepath import roles
from strikepath.catalog import queries
from strikepath.catalog.oracle import VIEWS
from strikepath.operators import metrics, panel, summary
from strikepath.plans import trade_enrichment, views, weekly_contracts, weekly_markets
from strikepath.sources import adapters, tables


def count_by_week(df):
    return {r.week_id: r["count"] for r in df.groupBy("week_id").count().collect()}


def test_contract_build_and_enrichment(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    rows = adapters.contract_1s(spark, sf_dir)
    written = weekly_contracts.build(spark, rows, root, cap=50)
    assert {"contract_summary", "contract_plot_sample", "week_index_contract_behavior"} <= set(written)
    evolution = tables.read_product(spark, root, "contract_evolution_1s")
    assert evolution.count() == rows.count()
    weeks = count_by_week(evolution)
    sample = count_by_week(tables.read_product(spark, root, "contract_plot_sample"))
    assert sample == {w: min(n, 50) for w, n in weeks.items()}
    contracts = count_by_week(tables.read_product(spark, root, "contract_summary"))
    metrics = tables.read_product(spark, root, "contract_behavior_summary_metrics")
    named = {r.week_id: r.value for r in metrics.where("metric = 'contracts'").collect()}
    assert named == contracts
    decided = {r.week_id: r.value for r in metrics.where("metric = 'decision_contracts'").collect()}
    assert all(decided[w] <= n for w, n in contracts.items())

    # Writing one week again leaves the others alone.
    one = tables.read_product(spark, root, "contract_summary").where("week_id = '2024-01-08'").limit(1)
    kept = spark.createDataFrame(one.collect(), one.schema)
    tables.write_product(kept, root, "contract_summary")
    after = count_by_week(tables.read_product(spark, root, "contract_summary"))
    assert after == {**contracts, "2024-01-08": 1}

    trades = adapters.trades(spark, sf_dir)
    rate = {r.week_id: r for r in trade_enrichment.build(spark, trades, root).collect()}
    assert {w: r.n_rows for w, r in rate.items()} == weeks
    assert sum(r.matched_rows for r in rate.values()) >= trades.count()
    first = tables.read_product(spark, root, "contract_evolution_1s").columns
    trade_enrichment.build(spark, trades, root)
    assert tables.read_product(spark, root, "contract_evolution_1s").columns == first

    trade_enrichment.build(spark, trades, root, strict=True)
    known = trade_enrichment.alias_build(spark, root)
    by_name = {r.dataset: r.n for r in known.groupBy("dataset").agg(F.sum("non_null").alias("n")).collect()}
    assert by_name["contract_evolution_1s"] == trades.count()

    plain = tables.read_product(spark, root, "contract_evolution_1s", week="2024-01-08")
    plan = plain._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(cast(week_id" in plan or "PartitionFilters: [isnotnull(week_id" in plan


def test_market_build_invariants(spark, sf_dir, tmp_path):
    root = str(tmp_path)
    weekly_markets.build(
        spark, adapters.micro_1s(spark, sf_dir), adapters.markets(spark, sf_dir), adapters.labels(spark, sf_dir), root
    )
    metrics = tables.read_product(spark, root, "summary_metrics").groupBy("week_id").pivot("metric").agg(F.first("value"))
    rows = metrics.collect()
    assert rows
    for row in rows:
        assert row.kalshi_markets == row.threshold_matches
        assert row.futures_15m_rows <= 7 * 24 * 4
        assert row.near_threshold_100_count <= row.threshold_matches
    index = spark.read.csv(f"{root}/week_index.csv", header=True)
    assert index.count() == len(rows) and {"week_id", "week_label"} <= set(index.columns)


def test_missing_product_is_an_empty_frame(spark, tmp_path):
    contract = roles.schema(("week_id", roles.STRING), ("metric", roles.STRING), ("value", roles.DOUBLE))
    df = tables.read_product(spark, str(tmp_path), "never_written", contract)
    assert df.count() == 0 and df.columns == ["week_id", "metric", "value"]


def test_files_are_found_by_path(spark, sf_dir, tmp_path):
    for part in ("live/trades", "venv/.venv/trades", "notes"):
        spark.range(1).write.parquet(str(tmp_path / part))
    found = tables.discover_files(spark, str(tmp_path), ("trade",)).select("path").collect()
    assert found and all("live/trades" in r.path and ".venv" not in r.path for r in found)


def test_first_source_is_taken_per_week(spark):
    one = spark.createDataFrame([("w1", "2024-01-01", 3)], "week_id string, at string, n int")
    two = spark.createDataFrame([("w1", "2024-01-01", 9), ("w2", None, 1), ("w2", "2024-01-02", 4)],
                                "week_id string, time string, c int")
    got = tables.first_source_per_week([("none", two, "at", "c"), ("one", one, "at", "n"), ("two", two, "time", "c")])
    assert sorted((r.week_id, r.source, r.trade_count) for r in got.collect()) == [("w1", "one", 3), ("w2", "two", 4)]


def test_views_fall_back_without_buckets_and_prices(spark, sf_dir):
    moves = views.contract_moves(panel.panel_features(adapters.contract_quotes(spark, sf_dir)))
    assert "bin" in views.move_boxes(moves.drop("time_to_close_bucket")).columns
    features = panel.panel_features(adapters.contract_1s(spark, sf_dir))
    markers = views.decision_markers(features, summary.decision_times(features))
    gaps = markers.where(F.col("decision_marker") > F.col("close_marker"))
    assert markers.where("decision_marker IS NOT NULL").count() > 0 and gaps.count() == 0


def test_complete_weeks_of_a_folder_and_of_its_source(spark, sf_dir, tmp_path):
    """What the manifest of a build says, what the source promises, and the SQL agree, with a week that is incomplete."""
    rows = adapters.contract_1s(spark, sf_dir).withColumn("week", F.date_format(F.date_trunc("week", "second"), "yyyy-MM-dd")).checkpoint()
    weeks = sorted(r.week for r in rows.select("week").distinct().collect())
    got = queries.QUERIES["p13_complete_weeks"](spark, sf_dir).collect()
    assert sorted(r.week_id for r in got) == weeks
    # One row a week has no change over five rows, so the week's bins and heat map hold nothing.
    short = rows.where(F.col("week") == weeks[0]).limit(1).unionByName(rows.where(F.col("week") == weeks[1])).drop("week").checkpoint()
    root = str(tmp_path)
    weekly_contracts.build(spark, short, root)
    sample = tables.read_product(spark, root, "contract_plot_sample")
    assert sorted(r.week_id for r in sample.select("week_id").distinct().collect()) == weeks[:2]
    read = weekly_contracts.complete_weeks(spark, root, "weeks")
    promised = weekly_contracts.weeks_to_be_complete(panel.panel_features(short), "weeks")
    assert read.collect() == promised.collect() and [r.week_id for r in read.collect()] == weeks[1:2]
    six = {n: tables.read_product(spark, root, n) for n in weekly_contracts.SIX_PRODUCTS if n != "sensitivity_bins"}
    assert sorted(r.week_id for r in metrics.complete_weeks({**six, "sensitivity_bins": six["contract_summary"].where("week_id > '2'")}, "w").collect()) == weeks[1:2]
    feat = sample.select("week_id", "abs_yes_price_change_5s", "yes_price_change_5s", "underlying_change_5s").toPandas()
    found = duckdb.connect()
    found.register("feat", feat)
    assert found.execute(VIEWS["six"]).fetchall() == [(weeks[1],)]
    # The manifest alone answers: its plan scans nothing else.
    scanned = read._jdf.queryExecution().optimizedPlan().collectLeaves().toString()
    assert "mean_abs" not in scanned and read.inputFiles() and all("/_manifest/" in f for f in read.inputFiles())


def test_windows_come_before_panel_products(spark, sf_dir, monkeypatch):
    """The order of the reference; a later source answers only for a week the earlier ones lack."""
    seen = []
    real = tables.first_source_totals
    monkeypatch.setattr(tables, "first_source_totals", lambda sources: seen.extend(s[0] for s in sources) or real(sources))
    got = queries.QUERIES["s09_first_source_per_week"](spark, sf_dir).collect()
    order = ["futures_label_window_behavior", "futures_15m_windows", "contract_evolution_1s", "contract_plot_sample"]
    assert seen == order
    labelled = adapters.labels(spark, sf_dir)
    assert labelled.count() > 0 and "futures_label_window_behavior" in {r.source for r in got}
    # Every source but the first lacks nothing the one before it has, and has one week more.
    frames = [spark.createDataFrame([(w, w, k) for w in ("w1", "w2", "w3", "w4")[: k + 1]], "week_id string, at string, n int") for k in range(4)]
    sources = [(name, f, "at", "n") for name, f in zip(order, frames, strict=True)]
    rows = tables.first_source_per_week(sources).collect()
    assert sorted((r.week_id, r.source) for r in rows) == list(zip(["w1", "w2", "w3", "w4"], order, strict=True))
    totals = real(sources).collect()
    assert sorted((r.week_id, r.source, r.n_rows, r.trade_count) for r in totals) == [(f"w{k + 1}", order[k], 1, k) for k in range(4)]

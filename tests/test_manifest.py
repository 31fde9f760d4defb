"""Versioned products: what a run that dies, a part of the weeks, a changed and a vanished week leave."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from strikepath.operators import panel as panels
from strikepath.plans import weekly_contracts
from strikepath.sources import adapters, manifest, tables

SCHEMA = "week_id string, ticker string, at timestamp, n int"


def frame(make, rows):
    return make(rows, SCHEMA).withColumn("at", F.timestamp_seconds(F.col("n")))


def content(df):
    return sorted(tuple(r) for r in df.select("week_id", "ticker", "n").collect())


def folders(root, product):
    return sorted(os.path.relpath(p, f"{root}/{product}") for p in glob.glob(f"{root}/{product}/version=*/week_id=*"))


@pytest.fixture
def written(spark, make, tmp_path):
    root = str(tmp_path)
    rows = [("2024-01-01", "a", None, 1), ("2024-01-01", "b", None, 2), ("2024-01-08", "a", None, 3)]
    tables.write_product(frame(make, rows), root, "p", ("ticker",), "at")
    return root


def test_a_week_is_replaced_and_the_rest_kept(spark, make, written):
    tables.write_product(frame(make, [("2024-01-08", "c", None, 9), (None, "d", None, 4)]), written, "p", ("ticker",), "at")
    assert content(tables.read_product(spark, written, "p").where("week_id IS NOT NULL")) == [("2024-01-01", "a", 1), ("2024-01-01", "b", 2), ("2024-01-08", "c", 9)]
    assert tables.read_product(spark, written, "p").where("week_id IS NULL").count() == 1
    assert tables.read_product(spark, written, "p", week="2024-01-08").count() == 1
    assert folders(written, "p") == ["version=1/week_id=2024-01-01", "version=2/week_id=2024-01-08", f"version=2/week_id={manifest.NO_WEEK}"]
    entry = {r.week_id: r for r in manifest.current(spark, written, "p").collect()}
    assert (entry["2024-01-01"].n_rows, entry["2024-01-01"].version) == (2, 1)
    assert (entry["2024-01-01"].last_time - entry["2024-01-01"].first_time).total_seconds() == 1


def test_a_run_that_dies_leaves_the_old_product_whole(spark, make, written):
    before, files = content(tables.read_product(spark, written, "p")), folders(written, "p")
    # The second week's rows stop the job after others may have been written.
    dies = lambda df: df.withColumn("n", F.when(F.col("week_id") == "2024-01-08", F.raise_error(F.lit("lost"))).otherwise(F.col("n") + 1).cast("int"))
    with pytest.raises(Exception, match="lost"):
        tables.rewrite_product(spark, written, "p", dies, ("ticker",))
    assert content(tables.read_product(spark, written, "p")) == before
    # Files of a version that was written but never listed are not read either, and go with the next write.
    frame(make, [("2024-01-01", "x", None, 7)]).write.partitionBy("week_id").parquet(manifest.version_path(written, "p", 2))
    assert content(tables.read_product(spark, written, "p")) == before and set(files) < set(folders(written, "p"))
    tables.rewrite_product(spark, written, "p", lambda df: df.withColumn("n", F.col("n") + 1), ("ticker",))
    assert content(tables.read_product(spark, written, "p")) == [(w, t, n + 1) for w, t, n in before]
    assert folders(written, "p") == ["version=2/week_id=2024-01-01", "version=2/week_id=2024-01-08"]
    assert sorted(os.listdir(written)) == ["_manifest", "p"]


def test_files_that_miss_rows_never_count(spark, written):
    before = content(tables.read_product(spark, written, "p"))
    found = manifest.measured(spark, manifest.version_path(written, "p", 1), "at")
    with pytest.raises(RuntimeError, match="wrote 4 rows"):
        manifest.commit(spark, written, "p", 2, found, 4)
    assert manifest.next_version(spark, written, "p") == 2 and content(tables.read_product(spark, written, "p")) == before


def test_weeks_of_different_columns(spark, make, written):
    more = frame(make, [("2024-01-15", "z", None, 5)]).withColumn("more", F.lit("m"))
    tables.write_product(more, written, "p")
    got = {r.week_id: r.more for r in tables.read_product(spark, written, "p").collect()}
    assert got == {"2024-01-01": None, "2024-01-08": None, "2024-01-15": "m"}
    tables.drop_weeks(spark, written, "p", ["2024-01-15", "2024-01-01"])
    assert content(tables.read_product(spark, written, "p")) == [("2024-01-08", "a", 3)]
    with pytest.raises(FileNotFoundError):
        tables.read_product(spark, written, "never")


def test_fingerprints_see_content_and_not_order(spark, make):
    rows = [("w", "a", None, 1), ("w", None, None, 2), ("v", "a", None, 1)]
    prints = lambda r, n=3: {x.week_id: x.source for x in manifest.fingerprints(make(r, SCHEMA).repartition(n)).collect()}
    assert prints(rows) == prints(rows[::-1], 1)
    assert prints(rows)["w"] != prints([("w", None, None, 1), ("w", "a", None, 2)])["w"]
    # Equal pairs do not cancel out.
    assert prints([*rows, ("w", "q", None, 3), ("w", "q", None, 3)])["w"] != prints(rows)["w"]


def products_of(spark, root):
    names = (weekly_contracts.FEATURES, *weekly_contracts.SORTED_BY)
    return {n: sorted(map(str, tables.read_product(spark, root, n).collect())) for n in names}


def versions(spark, root):
    names = (weekly_contracts.FEATURES, *weekly_contracts.SORTED_BY)
    return {(n, r.week_id): r.version for n in names for r in manifest.current(spark, root, n).collect()}


def test_only_changed_weeks_are_built_and_vanished_ones_go(spark, sf_dir, tmp_path):
    source, root, fresh = (str(tmp_path / n) for n in ("source", "root", "fresh"))
    rows = panels.with_week(adapters.contract_1s(spark, sf_dir)).withColumn("week_id", F.date_format("week_start", "yyyy-MM-dd")).drop("week_start")
    weeks = sorted(r.week_id for r in rows.select("week_id").distinct().collect())
    rows = rows.where(F.col("week_id").isin(*weeks[:3])).checkpoint()
    tables.write_product(rows, source, "panel")
    read = lambda: tables.read_product(spark, source, "panel")
    assert weekly_contracts.refresh(spark, read(), root) == (weeks[:3], [])
    assert weekly_contracts.refresh(spark, read(), root) == ([], [])
    first = versions(spark, root)

    # Equal rows written anew are no change; one other price is, and only its week is built.
    again = rows.where(F.col("week_id") == weeks[0]).repartition(3)
    changed = rows.where(F.col("week_id") == weeks[1]).withColumn("kalshi_yes_price", F.col("kalshi_yes_price") / 2)
    tables.write_product(again.unionByName(changed), source, "panel")
    tables.drop_weeks(spark, source, "panel", weeks[2:3])
    assert weekly_contracts.refresh(spark, read(), root) == (weeks[1:2], weeks[2:3])
    after = versions(spark, root)
    assert {w for (_, w), v in after.items() if first[_, w] != v} == set(weeks[1:3])
    weekly_contracts.build(spark, read().drop("week_id"), fresh)
    assert products_of(spark, root) == products_of(spark, fresh)

    plan = read().where(F.col("week_id").isin(weeks[1]))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and weeks[1] in plan

    # Other settings, or a product a dead run left behind, build a week again.
    assert weekly_contracts.refresh(spark, read(), root, price_unit="as_is")[0] == weeks[:2]
    tables.drop_weeks(spark, root, "sensitivity_bins", weeks[:1])
    assert weekly_contracts.refresh(spark, read(), root, price_unit="as_is") == (weeks[:1], [])


def test_products_that_lie_together_join_without_an_exchange(spark, sf_dir, tmp_path):
    from strikepath.operators import bars, enrich
    from strikepath.sources import colocated

    rows = adapters.contract_quotes(spark, sf_dir).select("ticker", "second", "observed_at", "underlying_value")
    found = bars.trade_bars(adapters.trades(spark, sf_dir))
    panel = colocated.write_colocated(rows, str(tmp_path / "panel"), ["second"], 5, ["ticker"])
    trades = colocated.write_colocated(found, str(tmp_path / "trades"), ["second"], 5)
    assert len(glob.glob(f"{tmp_path}/panel/*.parquet")) == 5 and not [t for t in spark.catalog.listTables() if t.name.startswith("colocated")]
    # Small sides would be broadcast; this is about large ones.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = enrich.with_trades_of_second(panel, trades)
        got = sorted(map(str, joined.select("ticker", "observed_at", "underlying_trade_price").collect()))
        plan = joined._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "Exchange" not in plan and "SortMergeJoin" in plan
    wanted = enrich.attach_trades_by_second(rows, found).select("ticker", "observed_at", "underlying_trade_price")
    assert got == sorted(map(str, wanted.collect()))

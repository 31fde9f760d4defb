"""Groups cut into ranges must give what one window over the whole group gives."""

import random
from datetime import datetime, timedelta

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window as W

from strikepath.operators import micro, panel
from strikepath.operators import lookback
from strikepath.operators.lookback import range_cuts, with_lookback

START = datetime(2024, 1, 1)


def path_rows(sizes, gaps):
    rng = random.Random(7)
    rows = []
    for ticker, size in sizes.items():
        at = START
        for _ in range(size):
            at += timedelta(seconds=rng.choice(gaps))
            rows.append((START, ticker, at, rng.random() if rng.random() > 0.05 else None, 100 + rng.random()))
    rng.shuffle(rows)
    return rows


SCHEMA = "week_start timestamp, ticker string, second timestamp, kalshi_yes_price double, underlying_value double"
CHANGES = ["yes_price_change_1s", "yes_price_change_5s", "underlying_change_1s", "underlying_change_5s"]


@pytest.mark.parametrize("gaps", [(1,), (1, 1, 1, 900), (1, 50, 4000)])
def test_cut_groups_equal_whole_groups(make, gaps):
    # "hot" holds most rows; the others have 1, 5 and 6.
    df = make(path_rows({"hot": 400, "one": 1, "five": 5, "six": 6}, gaps), SCHEMA)
    plain = panel._changes(df, W.partitionBy("week_start", "ticker").orderBy("second")).toPandas()
    cut = panel.with_changes(df, slot_rows=40).toPandas()
    key = ["ticker", "second"]
    plain, cut = plain.sort_values(key, ignore_index=True), cut.sort_values(key, ignore_index=True)
    assert len(cut) == len(df.collect())
    pd.testing.assert_frame_equal(cut[plain.columns], plain)
    assert cut[cut.ticker == "five"]["underlying_change_5s"].isna().all()
    assert cut[cut.ticker == "six"]["underlying_change_5s"].notna().sum() == 1


def ranges(df, order, slot_rows):
    """Rows of each range of every group."""
    cuts = range_cuts(df, ("week_start", "ticker"), order, slot_rows)
    dealt = lookback.join_cuts(df, cuts, ("week_start", "ticker"), "left").withColumn("range", lookback.range_of(order))
    return {(r.ticker, r.range): r["count"] for r in dealt.groupBy("ticker", "range").count().collect()}


def test_ranges_follow_the_rows(make):
    df = make(path_rows({"hot": 4000, "five": 5}, (1, 1, 1, 9000)), SCHEMA)
    found = ranges(df, ["second"], 400)
    assert found["five", 0] == 5 and sum(found.values()) == 4005
    sizes = [n for (ticker, _), n in found.items() if ticker == "hot"]
    assert 6 <= len(sizes) <= 15 and max(sizes) < 1000


def test_a_burst_is_cut_evenly_and_equal_times_give_one_answer(spark):
    """100,000 rows in a tenth of a second, most of them at one moment, beside one quiet hour."""
    df = spark.range(100_000).selectExpr(
        "timestamp'2024-01-01' AS week_start", "'hot' AS ticker",
        "timestamp_micros(1704070000000000 + CASE WHEN id < 70000 THEN 50 ELSE id END) AS second",
        "id % 9973 / 100d AS kalshi_yes_price", "cast(id AS double) AS underlying_value",
    ).unionAll(spark.range(100).selectExpr("timestamp'2024-01-01'", "'hot'", "timestamp_seconds(1704060000 + 36 * id)", "0d", "0d"))
    sizes = list(ranges(df, ["second", "kalshi_yes_price", "underlying_value"], 5_000).values())
    assert sum(sizes) == 100_100 and 12 <= len(sizes) <= 30 and max(sizes) < 3 * 5_000
    digest = lambda d: d.selectExpr("count(*)", "sum(cast(xxhash64(*) AS decimal(20)))").first()
    cut = [digest(panel.with_changes(df.repartition(n), slot_rows=rows)) for n, rows in ((3, 5_000), (7, 5_000), (5, 2_000_000))]
    assert cut[0] == cut[1] == cut[2] and cut[0][0] == 100_100


def test_cuts_have_a_bound(make, monkeypatch):
    monkeypatch.setattr(lookback, "MAX_CUTS", 5)
    df = make(path_rows({"hot": 4000, "warm": 800}, (1,)), SCHEMA)
    found = ranges(df, ["second"], 40)
    assert len(found) <= 5 + 2 and sum(found.values()) == 4800
    whole = panel._changes(df, W.partitionBy("week_start", "ticker").orderBy("second")).toPandas()
    cut = panel.with_changes(df, slot_rows=40).toPandas()
    key = ["ticker", "second"]
    pd.testing.assert_frame_equal(
        cut.sort_values(key, ignore_index=True)[whole.columns], whole.sort_values(key, ignore_index=True)
    )


def test_second_branch_vanishes_without_large_groups(make):
    df = make(path_rows({"a": 30, "b": 20}, (1,)), SCHEMA)
    result = panel.with_changes(df)
    result.collect()
    final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert "isFinalPlan=true" in final
    assert final.count("Window [") == 1 and "BroadcastHashJoin" not in final


@pytest.mark.parametrize("size", [19, 20, 21, 22, 300])
def test_rolling_deviation_matches_pandas(make, size):
    rng = np.random.default_rng(size)
    price = 100 + rng.normal(size=size).cumsum() * 0.01
    rows = [("w", START + timedelta(seconds=i), float(p)) for i, p in enumerate(price)]
    df = make(rows, "week_id string, second timestamp, underlying double")
    series = pd.Series(price)
    expected = (np.log(series / series.shift(1)) * 10_000).rolling(60, min_periods=20).std()
    for cut in (100_000, 50):
        got = micro.with_local_volatility(df, slot_rows=cut).toPandas().sort_values("second")["local_vol_60s_bps"]
        np.testing.assert_allclose(got.to_numpy(float), expected.to_numpy(), rtol=1e-9, atol=1e-9)


@pytest.mark.parametrize("slot_rows", [1000, 20])
def test_lookback_keeps_null_keys(make, slot_rows):
    rows = [(START, None, START + timedelta(seconds=i), 0.1 * i, 1.0) for i in range(80)]
    df = make(rows, SCHEMA)
    got = with_lookback(df, ("week_start", "ticker"), "second", 5, panel._changes, slot_rows).toPandas()
    assert len(got) == 80 and got["yes_price_change_5s"].notna().sum() == 75

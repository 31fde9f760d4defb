from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from strikepath.functions import aggregates as agg
from strikepath.functions import buckets, clock, prices


def ts(text):
    return datetime.fromisoformat(text)


def test_week_turns_on_monday_midnight(make):
    df = make([(ts("2024-01-07 23:59:59.999999"),), (ts("2024-01-08 00:00:00"),)], "t timestamp")
    got = rows_of(df.select(clock.week_id(clock.week_start("t"))))
    assert got == [("2024-01-01",), ("2024-01-08",)]


def test_window_and_second_floor(make):
    df = make([(ts("2024-01-07 10:14:59.900000"),), (ts("1969-12-31 23:59:59"),)], "t timestamp")
    got = rows_of(df.select(clock.floor_to("t"), clock.floor_second("t")))
    assert got[0] == (ts("2024-01-07 10:00:00"), ts("2024-01-07 10:14:59"))
    assert got[1][0] == ts("1969-12-31 23:45:00")


def test_whole_seconds_cut_toward_zero(make):
    df = make([(ts("2024-01-01 00:00:01.200000"), ts("2024-01-01 00:00:00"))], "a timestamp, b timestamp")
    assert rows_of(df.select(clock.whole_seconds("a", "b"), clock.whole_seconds("b", "a"))) == [(1, -1)]


def test_week_labels(make):
    df = make([("2025-12-15",), ("2026-04-27",), ("misc",), ("2026-99-99",)], "w string")
    got = dict(rows_of(df.select("w", clock.week_label_from_id("w"))))
    assert got["2025-12-15"] == "Dec 15, 2025 - Dec 21, 2025"
    assert got["2026-04-27"] == "Apr 27, 2026 - May 03, 2026"
    assert got["misc"] == "misc" and got["2026-99-99"] == "2026-99-99"


def test_bad_text_becomes_null(make):
    df = make([("2024-01-01 00:00:00", "1.5"), ("soon", "many"), (None, "NaN")], "t string, x string")
    got = rows_of(df.select(clock.parse_time("t"), clock.parse_number("x")))
    assert got == [(ts("2024-01-01 00:00:00"), 1.5), (None, None), (None, None)]


def test_variable_shift(make):
    df = make([(ts("2024-01-01 01:00:00"), 1.5), (ts("2024-01-01 01:00:00"), None)], "t timestamp, m double")
    assert rows_of(df.select(clock.minus_minutes("t", "m"))) == [(ts("2024-01-01 00:58:30"),), (None,)]


@pytest.mark.parametrize(
    "value,band",
    [(25.0, "±$25"), (25.1, "±$50"), (50.0, "±$50"), (100.0, "±$100"), (250.0, "±$250"), (250.1, "Outside ±$250"),
     (None, "Outside ±$250")],
)
def test_threshold_band_limits(make, value, band):
    assert rows_of(make([(value,)], "d double").select(buckets.threshold_band("d"))) == [(band,)]


def test_bucket_limits(make):
    zs = [5.0, 10.0, 25.0, 50.0, 50.1, None]
    ms = [1.0, 2.0, 3.0, 5.0, 7.0, 10.0, 10.1, None]
    z = make([(v,) for v in zs], "z double").select(buckets.moneyness_bucket("z"))
    m = make([(v,) for v in ms], "m double").select(buckets.time_bucket("m"))
    assert [r[0] for r in z.collect()] == [*buckets.MONEYNESS_BUCKETS, "Very far"]
    assert [r[0] for r in m.collect()] == [*buckets.TIME_BUCKETS, "10-15m"]


def test_uncertainty_is_closed_on_both_ends(make):
    df = make([(19.9,), (20.0,), (80.0,), (80.1,), (None,)], "y double")
    flags = [r[0] == "Uncertain 20-80c" for r in df.select(buckets.uncertainty_bucket("y")).collect()]
    assert flags == [False, True, True, False, False]


def test_ordinals(make):
    df = make([("0-1m",), ("10-15m",), ("never",), (None,)], "b string")
    assert [r[0] for r in df.select(buckets.time_ordinal("b")).collect()] == [1, 7, None, None]


def test_quotes_that_do_not_count(make):
    df = make([(1.0, 2.0), (None, 2.0), (3.0, 2.0), (0.0, 2.0), (2.0, 2.0)], "b double, a double")
    got = rows_of(df.select(prices.quote_mid("b", "a"), prices.quote_spread("b", "a")))
    assert got == [(1.5, 1.0), (None, None), (None, None), (None, None), (2.0, 0.0)]


def test_zero_denominators_are_null(make):
    df = make([(1.0, 0.0)], "a double, b double")
    got = rows_of(df.select(prices.return_pct("a", "b"), prices.bps_of("a", "b", "b"), prices.log_return_bps("a", "b")))
    assert got == [(None, None, None)]


def test_log_return_of_non_positive_ratio_is_null(make):
    df = make([(-1.0, 2.0), (0.0, 2.0)], "a double, b double")
    assert rows_of(df.select(prices.log_return_bps("a", "b"))) == [(None,), (None,)]


def test_null_label_and_change_point_down(make):
    df = make([(1, 0.0), (0, -0.1), (None, None)], "l int, c double")
    got = rows_of(df.select(prices.window_direction("l"), prices.futures_direction("c")))
    assert got == [("Up / YES-like", "Up"), ("Down / NO-like", "Down"), ("Down / NO-like", "Down")]


@pytest.mark.parametrize("seed", range(6))
def test_dollar_test_equals_interpolated_percentile(make, seed):
    rng = np.random.default_rng(seed)
    values = rng.uniform(0, 1.6, size=int(rng.integers(1, 260)))
    values = np.where(rng.random(values.size) < 0.02, values + rng.uniform(0, 2), values)
    df = make([(float(v),) for v in values], "x double")
    expected = bool(np.quantile(np.abs(values), 0.99) <= 1.5)
    assert rows_of(df.agg(prices.looks_like_dollars("x"))) == [(expected,)]


def test_dollar_test_of_nothing_is_false(make):
    assert rows_of(make([(None,)], "x double").agg(prices.looks_like_dollars("x"))) == [(False,)]


def test_null_safe_aggregates(make):
    df = make([(None, None, 1), (None, "a", 2), (None, "a", 3)], "x double, s string, o int")
    got = rows_of(
        df.agg(
            agg.sum_or_zero("x"), agg.distinct_with_null("s"), F.count_distinct("s"), agg.first_by("s", "o"),
            agg.first_known_by("s", "o"), agg.last_known_by("x", "o"),
        )
    )
    assert got == [(0.0, 2, 1, None, "a", None)]


def test_snap_leaves_what_has_no_millionths(make):
    values = [0.1234565, -0.1234565, float("nan"), 1e13, -2e13, float("inf"), None]
    df = make([(v,) for v in values], "x double").select(prices.snap("x").alias("x"))
    got = [r["x"] for r in df.collect()]
    assert got[:2] == [0.123457, -0.123456] and got[2] != got[2]
    assert got[3:] == [1e13, -2e13, float("inf"), None]


def test_exact_mean_does_not_depend_on_order(spark):
    rows = spark.range(64).selectExpr("id % 2 AS k", "(CASE WHEN id % 3 = 0 THEN 0.1 ELSE 0.7 END) + id * 1e5 AS x")
    means = {
        tuple(r["m"] for r in rows.repartition(n, "x").groupBy("k").agg(agg.exact_mean("x").alias("m")).orderBy("k").collect())
        for n in (1, 3, 7)
    }
    assert len(means) == 1

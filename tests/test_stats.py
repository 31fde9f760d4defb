import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from conftest import rows_of
from strikepath.functions.aggregates import exact_mean
from strikepath.operators import daily, sample, stats

QS = {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.95, "e": 0.99, "f": 1.0}


def groups_of_values():
    rng = np.random.default_rng(3)
    return {
        "one": [4.0],
        "two": [1.0, 2.0],
        "three": [1.0, 2.0, 3.0],
        "ties": [5.0] * 900 + [6.0] * 100,
        "skewed": list(np.exp(rng.normal(0, 4, size=3000))),
        "wide": list(rng.normal(size=3000)),
        None: list(rng.normal(size=50)),
    }


def values_of(spark, groups):
    pdf = pd.DataFrame([(g, v, i) for g, vs in groups.items() for i, v in enumerate(vs)], columns=["g", "v", "i"])
    extra = spark.createDataFrame([("one", None, -1), ("none", None, 0)], "g string, v double, i long")
    return spark.createDataFrame(pdf, "g string, v double, i long").unionByName(extra).repartition(4)


@pytest.mark.parametrize("slot_rows", [2_000_000, 200, 20, None])
def test_quantiles_are_exact(spark, slot_rows):
    """Few rows a range make the groups lie in many, equal values among them."""
    groups = groups_of_values()
    df = values_of(spark, groups)
    got = {r.g: r for r in stats.exact_quantiles(df, ["g"], "v", QS, ["i"], slot_rows).collect()}
    assert set(got) == set(groups)
    for name, values in groups.items():
        expected = np.quantile(values, list(QS.values()))
        np.testing.assert_allclose([got[name][q] for q in QS], expected, rtol=1e-12)
        assert got[name].n == len(values)


@pytest.mark.parametrize("slot_rows", [2_000_000, 100, None])
def test_figures_of_groups_in_ranges(spark, slot_rows):
    groups = groups_of_values()
    df = values_of(spark, groups)
    described = {r.g: r for r in stats.describe(df, ["g"], "v", ["i"], slot_rows).collect()}
    assert described["none"]["count"] == 0 and described["none"]["mean"] is None
    boxes = {r.g: r for r in stats.box_stats(df, ["g"], "v", ["i"], slot_rows).collect()}
    above = stats.at_or_above_quantile(df, ["g"], "v", 0.9, "p", ["i"], slot_rows).collect()
    assert "none" not in boxes and set(described) - {"none"} == set(boxes) == set(groups)
    for name, values in groups.items():
        v = pd.Series(values)
        d, b = described[name], boxes[name]
        expected = v.describe()
        np.testing.assert_allclose([np.nan if d[c] is None else d[c] for c in ("count", "mean", "std", "min", "q25", "q50", "q75", "max")], expected.to_numpy(), rtol=1e-9)
        low, high = expected["25%"] - 1.5 * (expected["75%"] - expected["25%"]), expected["75%"] + 1.5 * (expected["75%"] - expected["25%"])
        assert (b.whisker_low, b.whisker_high, b.n_outliers) == (v[v >= low].min(), v[v <= high].max(), ((v < low) | (v > high)).sum())
        assert sorted(r.v for r in above if r.g == name) == sorted(v[v >= np.quantile(values, 0.9)])


def test_a_group_without_keys_and_one_exchange_of_the_rows(spark, tmp_path):
    spark.range(5000).selectExpr("id % 3 AS g", "id AS i", "cast(id * 7 % 5000 AS double) AS v", "'payload' AS text").write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    row = stats.exact_quantiles(df, [], "v", {"p": 0.25}, ["i"], 300).first()
    assert (row.n, row.p) == (5000, 1249.75)
    big = stats.at_or_above_quantile(df, ["g"], "v", 0.5, "p", ["i"], 300)
    assert big.count() == 2501 or big.count() == 2502
    big.collect()
    plan = big._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    # Rows with their text are dealt out once; what joins them again is per range.
    dealt = [x for x in plan.split("\n") if "REPARTITION_BY_COL" in x and "Exchange hash" in x and "Reused" not in x]
    assert len(dealt) <= 2 and "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_p95_of_three(make):
    df = make([("g", 1.0), ("g", 2.0), ("g", 3.0)], "g string, v double")
    assert rows_of(stats.exact_quantiles(df, ["g"], "v", {"p": 0.95}).select("p")) == [(2.9,)]


def test_describe_matches_pandas(spark):
    pdf = pd.DataFrame({"g": list("aabbbb"), "v": [1.0, 5.0, 2.0, 2.0, 9.0, -1.0]})
    got = stats.describe(spark.createDataFrame(pdf), ["g"], "v").toPandas().set_index("g").sort_index()
    expected = pdf.groupby("g")["v"].describe()
    np.testing.assert_allclose(got.to_numpy(float), expected.to_numpy(float))


def test_means_leave_no_value_out(make):
    cases = {
        "large": ([1.0, 1e21], 5e20), "small": ([4e-9, 4e-9], 4e-9), "tiny": ([3e-300, 1e-300], 2e-300), "cents": ([0.1, 0.2, 0.3], 0.2),
        "far": ([1e17, 1.0, -1e17], 1 / 3), "endless": ([1.0, float("inf")], float("inf")), "none": ([None], None), "zero": ([0.0, 0.0], 0.0),
        "both": ([float("inf"), float("-inf")], float("nan")), "nan": ([1.0, float("nan")], float("nan")), "gap": ([1.0, None], 1.0),
    }
    rows = [(g, v) for g, (vs, _) in cases.items() for v in vs]
    for parts in (1, 2, 5):
        got = {r.g: r.m for r in make(rows, "g string, v double").repartition(parts).groupBy("g").agg(exact_mean("v").alias("m")).collect()}
        for g, (_, expected) in cases.items():
            assert got[g] == expected or got[g] is not None and (abs(got[g] - expected) <= 1e-12 * abs(expected) or got[g] != got[g] and expected != expected), g


def test_means_do_not_depend_on_partitions(spark):
    df = spark.range(20_000).selectExpr("id % 3 AS g", "sin(id) * pow(10, id % 7) AS v")
    got = {tuple(map(tuple, df.repartition(n).groupBy("g").agg(exact_mean("v").alias("m")).orderBy("g").collect())) for n in range(1, 11)}
    assert len(got) == 1


def test_histogram_edges(make):
    df = make([("g", float(v)) for v in (0, 1, 9.99, 10, 10)] + [("flat", 3.0), ("flat", 3.0)], "g string, v double")
    got = {(r["g"], r["bin"]): r["count"] for r in stats.histogram(df, ["g"], "v", 10).collect()}
    assert got == {("g", 0): 1, ("g", 1): 1, ("g", 9): 3, ("flat", 0): 2}
    assert rows_of(stats.histogram(df, ["g"], "v", 10, whole=True), "g", "bin") == rows_of(stats.histogram(df, ["g"], "v", 10), "g", "bin")


def test_box_whiskers_and_outliers(make):
    df = make([("g", float(v)) for v in (1, 2, 3, 4, 100)], "g string, v double")
    row = stats.box_stats(df, ["g"], "v").first()
    assert (row.q25, row.q50, row.q75, row.whisker_low, row.whisker_high, row.n_outliers) == (2, 3, 4, 1, 4, 1)


def test_category_shares(make):
    df = make([("w", "YES"), ("w", "YES"), ("w", None), ("w", "NO")], "k string, c string")
    got = {r["c"]: (r["count"], r["share"]) for r in stats.category_shares(df, ["k"], "c").collect()}
    assert got == {"YES": (2, 0.5), "NO": (1, 0.25), "Unknown": (1, 0.25)}


def test_sample_is_whole_below_the_cap_and_exact_above(spark):
    base = spark.range(5000).select(
        F.when(F.col("id") < 4000, "big").otherwise("small").alias("week_id"),
        F.concat(F.lit("C"), F.col("id") % 7).alias("ticker"),
        F.timestamp_seconds("id").alias("second"),
    )
    first = sample.capped_sample(base, cap=1000).toPandas()
    again = sample.capped_sample(base.repartition(3), cap=1000).toPandas()
    assert first["week_id"].value_counts().to_dict() == {"big": 1000, "small": 1000}
    assert not first.duplicated(["ticker", "second"]).any()
    key = ["week_id", "ticker", "second"]
    pd.testing.assert_frame_equal(
        first.sort_values(key, ignore_index=True), again.sort_values(key, ignore_index=True)
    )


def test_daily_totals_skip_unreadable_times(make):
    df = make([("2024-01-01 10:00:00", 5), ("2024-01-01 11:00:00", None), ("x", 9), ("2024-01-02", 1)], "t string, n int")
    totals = daily.daily_totals(df, "t", "n")
    assert [r["n"] for r in totals.orderBy("date").collect()] == [5, 1]
    row = daily.total_stats(totals, "n").first()
    assert (row.n_days, row.total, row["mean"], row["median"], row["min"], row["max"]) == (2, 6, 3.0, 3.0, 1, 5)

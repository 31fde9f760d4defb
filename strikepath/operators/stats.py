"""Generic statistics: quantiles, descriptions, histograms, box figures, counts, pivots.

Order statistics go by rank. A group's values are dealt out by ranges of the value,
whose cuts come from a sample (``operators/lookback.py``); each range counts its
rows, a running sum of those counts over the ranges says how many rows lie below
each, and so every row knows its place in its group from its place in its range.
That takes one exchange of the rows, however large a group is, and the figures
of a group come back to its rows by range, which needs no further one.

Where the data bounds a group (a contract has one row a second in its week) the
caller passes ``slot_rows=None``: then a group is ranked whole by plain windows,
which costs no sample and reads the rows once.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strikepath.functions.aggregates import exact_mean, rows
from strikepath.operators.lookback import SLOT_ROWS, join_cuts, range_cuts, range_of


def _attach(df: DataFrame, small: DataFrame, keys: Sequence[str], per_week: bool) -> DataFrame:
    """Equi-join group figures back to rows.

    Groups that are whole weeks number about 52 a year, so their figures are
    broadcast; any other grouping is joined by size.
    """
    return df.join(F.broadcast(small) if per_week else small, list(keys))


class _Ranked:
    """Rows of groups dealt out by ranges of a value; a NULL key is a key."""

    def __init__(
        self, df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str], slot_rows: int | None, with_null: bool = False
    ):
        # One column that is never NULL, so that joins match it as it is.
        key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
        held = df.withColumns({"_key": key, "_v": F.col(value).cast("double")})
        known = held.where(F.col("_v").isNotNull())
        self.keys, self.whole = list(keys), slot_rows is None
        if self.whole:
            self.rows = held if with_null else known
            return
        order = ["_v", *tie]
        ranged = join_cuts(held if with_null else known, range_cuts(known, ["_key"], order, slot_rows), ["_key"], "left")
        # Rows without a value lie below all ranges and count in none.
        below = -1 - F.pmod(F.xxhash64(*tie), F.lit(64)) if tie else F.lit(-1)
        self.rows = (
            ranged.withColumn("_range", F.when(F.col("_v").isNull(), below).otherwise(range_of(order)))
            .drop("_cuts")
            .repartition("_key", "_range")
        )

    def _ranges(self) -> DataFrame:
        """(_key, _range, _size): counted along the same order as the places, so that both read one exchange."""
        part = W.partitionBy("_key", "_range")
        counted = self.rows.withColumns({"_place": F.row_number().over(part.orderBy("_v")), "_size": F.count("_v").over(part)})
        return counted.where(F.col("_place") == 1).select("_key", "_range", "_size")

    def placed(self, figures: DataFrame | None = None) -> DataFrame:
        """The rows with ``_n``, the values in their group, ``_rank``, their place among them from 0, and group figures."""
        group = W.partitionBy("_key")
        if self.whole:
            place = F.row_number().over(group.orderBy(F.asc_nulls_last("_v")))
            ranked = self.rows.withColumns({"_n": F.count("_v").over(group), "_rank": place - 1})
            return ranked if figures is None else ranked.join(figures, "_key")
        below = F.sum("_size").over(group.orderBy("_range")) - F.col("_size")
        offsets = self._ranges().select("_key", "_range", below.alias("_below"), F.sum("_size").over(group).alias("_n"))
        if figures is not None:
            offsets = offsets.join(figures, "_key")
        place = F.row_number().over(W.partitionBy("_key", "_range").orderBy("_v"))
        ranked = self.rows.withColumn("_place", place).join(offsets, ["_key", "_range"])
        return ranked.withColumn("_rank", F.col("_below") + F.col("_place") - 1)

    @staticmethod
    def _sides(probabilities: dict[str, float]) -> dict[str, Column]:
        """Aggregates: the values at the two ranks around each quantile."""
        sides = {}
        for name, p in probabilities.items():
            place = (F.col("_n") - 1) * F.lit(float(p))
            for side, rank in (("lo", F.floor(place)), ("hi", F.ceil(place))):
                sides[f"_{name}_{side}"] = F.max(F.when(F.col("_rank") == rank, F.col("_v")))
        return sides

    @staticmethod
    def _between(name: str, p: float, n: str) -> Column:
        place, low, high = (F.col(n) - 1) * F.lit(float(p)), F.col(f"_{name}_lo"), F.col(f"_{name}_hi")
        return (low + (place - F.floor(place)) * (high - low)).alias(name)

    def quantiles(self, probabilities: dict[str, float], *measures: Column, figures: DataFrame | None = None) -> DataFrame:
        """(_key, n, the named quantiles, the measures), one row per group."""
        sides = self._sides(probabilities)
        picked = [m.alias(name) for name, m in sides.items()]
        found = self.placed(figures).groupBy("_key").agg(F.max("_n").alias("n"), *picked, *measures)
        others = [c for c in found.columns if c not in sides and c not in ("_key", "n")]
        return found.select("_key", "n", *[self._between(name, p, "n") for name, p in probabilities.items()], *others)

    def with_quantiles(self, probabilities: dict[str, float]) -> DataFrame:
        """The rows with their group's ``n`` and named quantiles."""
        if not self.whole:
            return self.back(self.quantiles(probabilities))
        group = W.partitionBy("_key")
        ranked = self.placed().withColumns({name: m.over(group) for name, m in self._sides(probabilities).items()})
        return ranked.select(*self.rows.columns, F.col("_n").alias("n"), *[self._between(name, p, "_n") for name, p in probabilities.items()])

    def back(self, figures: DataFrame) -> DataFrame:
        """The rows with their group's figures, which are spread over its ranges first."""
        spread = self._ranges().select("_key", "_range").join(figures, "_key")
        return self.rows.join(spread, ["_key", "_range"])

    def named(self, figures: DataFrame, *columns: str) -> DataFrame:
        return figures.select(*[F.col(f"_key.`{k}`").alias(k) for k in self.keys], *columns)


def exact_quantiles(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probabilities: dict[str, float],
    tie: Sequence[str] = (),
    slot_rows: int | None = SLOT_ROWS,
) -> DataFrame:
    """Exact linear-interpolated quantiles of ``value`` per group, of any group size.

    Output: the keys, ``n`` and one column per name in ``probabilities``. Equal
    values are cut apart only by ``tie``, further columns that differ between them.
    """
    ranked = _Ranked(df.select(*keys, value, *tie), keys, value, tie, slot_rows)
    return ranked.named(ranked.quantiles(probabilities), "n", *probabilities)


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(
    df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str] = (), slot_rows: int | None = SLOT_ROWS
) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum per group.

    Mean and deviation are exact sums where those fit (``exact_mean``), so the
    order of rows cannot show; squares are taken about the mean.
    """
    ranked = _Ranked(df.select(*keys, value, *tie), keys, value, tie, slot_rows, with_null=True)
    means = ranked.rows.groupBy("_key").agg(exact_mean("_v").alias("_mean"))
    square = F.pow(F.col("_v") - F.col("_mean"), F.lit(2))
    measures = (F.min("_v").alias("min"), F.max("_v").alias("max"), F.max("_mean").alias("mean"), exact_mean(square).alias("_spread"))
    found = ranked.quantiles(QUARTILES, *measures, figures=means)
    deviation = F.when(F.col("n") > 1, F.sqrt(F.col("_spread") * F.col("n") / (F.col("n") - 1)))
    found = found.withColumns({"count": F.col("n"), "std": deviation})
    return ranked.named(found, "count", "mean", "std", "min", *QUARTILES, "max")


def histogram(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    bins: int,
    split: str | None = None,
    per_week: bool = False,
    whole: bool = False,
) -> DataFrame:
    """Equal-width bins between a group's extremes; the top edge belongs to the last bin.

    ``whole`` is for groups that the data bounds: their extremes come from a window, and the rows are read once.
    """
    extra = [split] if split else []
    data = df.select(*keys, *extra, F.col(value).cast("double").alias("_v")).where(F.col("_v").isNotNull())
    ends = {"_lo": F.min("_v"), "_hi": F.max("_v")}
    if whole:
        group = W.partitionBy(*keys)
        ranged = data.withColumns({name: end.over(group) for name, end in ends.items()})
    else:
        ranged = _attach(data, data.groupBy(*keys).agg(*[end.alias(name) for name, end in ends.items()]), keys, per_week)
    width = F.col("_hi") - F.col("_lo")
    slot = F.floor(F.try_divide(F.col("_v") - F.col("_lo"), width) * bins)
    # One value only: everything is in bin 0.
    bin_ = F.least(F.coalesce(slot, F.lit(0)), F.lit(bins - 1))
    return (
        ranged.groupBy(*keys, *extra, bin_.alias("bin"), "_lo", "_hi")
        .agg(rows().alias("count"))
        .select(
            *keys,
            *extra,
            "bin",
            (F.col("_lo") + width / bins * F.col("bin")).alias("bin_start"),
            (F.col("_lo") + width / bins * (F.col("bin") + 1)).alias("bin_end"),
            "count",
        )
    )


def box_stats(
    df: DataFrame, keys: Sequence[str], value: str, tie: Sequence[str] = (), slot_rows: int | None = SLOT_ROWS
) -> DataFrame:
    """Quartiles, whisker ends (last values within 1.5 IQR) and outlier count per group."""
    ranked = _Ranked(df.select(*keys, value, *tie), keys, value, tie, slot_rows)
    reach = (F.col("q75") - F.col("q25")) * 1.5
    low, high, v = F.col("q25") - reach, F.col("q75") + reach, F.col("_v")
    boxes = (
        ranked.with_quantiles(QUARTILES)
        .groupBy("_key", "n", *QUARTILES)
        .agg(
            F.min(F.when(v >= low, v)).alias("whisker_low"),
            F.max(F.when(v <= high, v)).alias("whisker_high"),
            F.count_if((v < low) | (v > high)).alias("n_outliers"),
        )
    )
    return ranked.named(boxes, "n", *QUARTILES, "whisker_low", "whisker_high", "n_outliers")


def at_or_above_quantile(
    df: DataFrame,
    keys: Sequence[str],
    value: str,
    probability: float,
    name: str = "threshold",
    tie: Sequence[str] = (),
    slot_rows: int | None = SLOT_ROWS,
) -> DataFrame:
    """Rows at or above their group's quantile, with that quantile."""
    ranked = _Ranked(df, keys, value, tie, slot_rows)
    return ranked.with_quantiles({name: probability}).where(F.col("_v") >= F.col(name)).select(*df.columns, name)


def category_counts(df: DataFrame, keys: Sequence[str], category: str, unknown: str = "Unknown") -> DataFrame:
    """Rows per category, NULL under a label of its own; most frequent first within each group, equal counts by label."""
    return _counted(df, keys, category, unknown).orderBy(*keys, F.desc("count"), category)


def _counted(df: DataFrame, keys: Sequence[str], category: str, unknown: str) -> DataFrame:
    label = F.coalesce(F.col(category), F.lit(unknown)).alias(category)
    return df.groupBy(*keys, label).agg(rows().alias("count"))


def category_shares(df: DataFrame, keys: Sequence[str], category: str) -> DataFrame:
    """Category counts with their part of the group."""
    whole = F.sum("count").over(W.partitionBy(*keys))
    shares = _counted(df, keys, category, "Unknown").withColumn("share", F.col("count") / whole)
    return shares.orderBy(*keys, F.desc("count"), category)


def pivot_mean(
    df: DataFrame, rows_: Sequence[str], across: str, values: Sequence[str], measure: str
) -> DataFrame:
    """Mean of ``measure``, one column per listed value of ``across``."""
    return df.groupBy(*rows_).pivot(across, list(values)).agg(F.avg(measure))


def top_per_group(df: DataFrame, keys: Sequence[str], n: int, *order) -> DataFrame:
    """First ``n`` rows per group. Each task keeps ``n`` of a group before the exchange."""
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)

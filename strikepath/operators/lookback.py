"""Ordered windows over groups of any size.

A column that looks back at most ``rows`` rows (a lag, a rolling deviation) needs
no more than the last ``rows`` rows before its own. So every group is cut into
ranges of its order that hold about ``slot_rows`` rows each, every range is
worked on alone, and the first ``rows`` rows of each, which lack their history,
are worked out again from the heads and tails of the group's ranges put in order.

The cuts come from a sample of the rows by a hash of their own values, as a range
partitioner's do, so they follow the rows and not the clock: a burst is cut like
anything else, also one within a single moment, as further columns order equal
times. Unlike a range partitioner's, the sample is the same whenever it is drawn,
so the two branches below always agree, and both wait for the first action.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strikepath.functions.aggregates import rows as count_rows

Compute = Callable[[DataFrame, WindowSpec], DataFrame]

# Rows of a range, as many as one task sorts with ease.
SLOT_ROWS = 2_000_000
# Sampled rows for each cut, which evens out the ranges.
OVERSAMPLE = 16
# Bound of the broadcast: about 100,000 cuts of two or three values each. Beyond 2e11
# rows the ranges grow instead, each then a hundred-thousandth of all rows.
MAX_CUTS = 100_000
# Cuts are looked up in two steps of about this many.
CHUNK = 64


def range_cuts(df: DataFrame, keys: Sequence[str], order: Sequence[str], slot_rows: int = SLOT_ROWS) -> DataFrame:
    """(keys, _cuts): for each group that has any, its cuts in ascending order, in chunks.

    A cut is the order columns of the first row of a range.
    """
    rate = max(1, slot_rows // OVERSAMPLE)
    drawn = df.where(F.pmod(F.xxhash64(*keys, *order), F.lit(rate)) == 0).select(*keys, F.struct(*order).alias("_at")).distinct()
    count = drawn.agg((F.ceil(count_rows() / F.lit(MAX_CUTS))).alias("n")).scalar()
    stride = F.greatest(F.lit(min(OVERSAMPLE, slot_rows)), count)
    nth = F.row_number().over(W.partitionBy(*keys).orderBy("_at"))
    cuts = drawn.withColumn("_nth", nth).where(F.col("_nth") % stride == 0).groupBy(*keys).agg(F.array_sort(F.collect_set("_at")).alias("_all"))
    chunks = F.transform(
        F.sequence(F.lit(0), F.expr(f"(size(_all) - 1) div {CHUNK}")), lambda i: F.slice("_all", i * CHUNK + 1, F.lit(CHUNK))
    )
    return cuts.select(*keys, chunks.alias("_cuts"))


def range_of(order: Sequence[str]):
    """Number of the range a row lies in: how many cuts are not above it."""
    at = F.struct(*order)
    before = F.size(F.filter("_cuts", lambda chunk: chunk[0] <= at))
    within = F.size(F.filter(F.get("_cuts", before - 1), lambda cut: cut <= at))
    return F.when(F.col("_cuts").isNull() | (before == 0), 0).otherwise((before - 1) * CHUNK + within)


def join_cuts(df: DataFrame, cuts: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Equi-join in which NULL keys match, since rows without a key are a group too."""
    renamed = cuts.withColumnsRenamed({k: f"_cut_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_cut_{k}")) for k in keys])
    return df.join(F.broadcast(renamed), same, how).drop(*[f"_cut_{k}" for k in keys])


def with_lookback(
    df: DataFrame,
    keys: Sequence[str],
    order: str | Sequence[str],
    rows: int,
    compute: Compute,
    slot_rows: int = SLOT_ROWS,
    sampled_from: DataFrame | None = None,
) -> DataFrame:
    """Add the columns of ``compute(frame, window)``, exact for groups of any size.

    ``compute`` may use the current row and at most ``rows`` rows before it.
    ``order`` names a time and, where times can be equal, the columns that
    ``compute`` reads: rows that agree in all of them are the same to it, so
    equal times give one answer. ``sampled_from`` is a frame with the same keys,
    order and rows that costs less than ``df`` to draw the sample from.

    Where no group is long enough for a cut the second branch is empty and
    adaptive execution drops it, which leaves one exchange and one sort.
    """
    order = [order] if isinstance(order, str) else list(order)
    cuts = range_cuts(df if sampled_from is None else sampled_from, keys, order, slot_rows)
    by_range = W.partitionBy(*keys, "_range").orderBy(*order)
    extra = ("_cuts", "_range", "_pos")

    inner = (
        compute(join_cuts(df, cuts, keys, "left").withColumn("_range", range_of(order)), by_range)
        .withColumn("_pos", F.when(F.col("_cuts").isNotNull(), F.row_number().over(by_range)))
        .where(F.col("_pos").isNull() | (F.col("_pos") > rows))
        .drop(*extra)
    )

    size = F.count(F.lit(1)).over(W.partitionBy(*keys, "_range"))
    edges = (
        join_cuts(df, cuts, keys, "inner")
        .withColumn("_range", range_of(order))
        .withColumn("_pos", F.row_number().over(by_range))
        .withColumn("_left", size - F.col("_pos"))
        .where((F.col("_pos") <= rows) | (F.col("_left") < rows))
        .drop("_left")
    )
    heads = compute(edges, W.partitionBy(*keys).orderBy(*order)).where(F.col("_pos") <= rows).drop(*extra)
    return inner.unionByName(heads)

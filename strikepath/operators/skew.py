"""Equi-joins in which a few keys hold most rows of one side.

Adaptive execution splits a large partition only where both sides come straight
from exchanges of their own, and an aggregate on the join key takes that away:
its result is joined where it lies. Here the frequent keys are found first, by
counting a sample of the rows; their rows are dealt over as many salts as they
need, and the other side's few rows of those keys are repeated once per salt.
All other keys are joined as they are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strikepath.functions.aggregates import rows as count_rows

# Rows of one key that one task joins with ease.
PART_ROWS = 1_000_000
# Sampled rows for each part.
OVERSAMPLE = 16
# Bound of the list of frequent keys, which is broadcast.
MAX_KEYS = 100_000


def frequent_keys(df: DataFrame, keys: Sequence[str], row: Sequence[str], part_rows: int = PART_ROWS) -> DataFrame:
    """(keys, _salts): keys with more than about ``part_rows`` rows and the parts to cut them into.

    ``row`` names columns that tell rows of one key apart. The sample is drawn by
    their hash, so it is the same whenever it is drawn. There are never more than
    ``MAX_KEYS``: a key that is left out holds less than a hundred-thousandth of all rows.
    """
    rate = max(1, part_rows // OVERSAMPLE)
    drawn = df.where(F.pmod(F.xxhash64(*keys, *row), F.lit(rate)) == 0).select(*keys)
    least = F.greatest(F.lit(2 * min(OVERSAMPLE, part_rows)), drawn.agg(F.ceil(count_rows() / F.lit(MAX_KEYS))).scalar())
    counted = drawn.groupBy(*keys).agg(count_rows().alias("_drawn")).where(F.col("_drawn") >= least)
    return counted.select(*keys, F.ceil(F.col("_drawn") / F.lit(min(OVERSAMPLE, part_rows))).cast("int").alias("_salts"))


def _with_salts(df: DataFrame, hot: DataFrame, keys: Sequence[str], names: Sequence[str]) -> DataFrame:
    renamed = hot.withColumnsRenamed({k: f"_hot_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(n) == F.col(f"_hot_{k}") for n, k in zip(names, keys, strict=True)])
    return df.join(F.broadcast(renamed), same, "left").drop(*[f"_hot_{k}" for k in keys])


def frequent_join(
    left: DataFrame,
    right: DataFrame,
    on: dict[str, str],
    row: Sequence[str],
    how: str = "left",
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """``left`` joined with ``right`` on left column = right column; the right one's key columns go.

    ``how`` is "left" or "inner". ``row`` names columns that tell left rows of one key apart.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"a {how} join would repeat unmatched right rows")
    keys = list(on)
    hot = frequent_keys(left, keys, row, part_rows)
    salt = F.when(F.col("_salts").isNull(), 0).otherwise(F.pmod(F.xxhash64(*row, F.lit(1)), F.col("_salts"))).cast("int")
    dealt = _with_salts(left, hot, keys, keys).withColumn("_salt", salt).drop("_salts")
    renamed = right.withColumnsRenamed({r: f"_right_{k}" for k, r in on.items()})
    names = [f"_right_{k}" for k in keys]
    every = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    repeated = _with_salts(renamed, hot, keys, names).withColumn("_right_salt", F.explode(every)).drop("_salts")
    same = [F.col(k) == F.col(n) for k, n in zip(keys, names, strict=True)] + [F.col("_salt") == F.col("_right_salt")]
    return dealt.join(repeated, reduce(lambda a, b: a & b, same), how).drop("_salt", "_right_salt", *names)


def own_exchange(df: DataFrame, key: str) -> DataFrame:
    """``df`` with a text key written so that a join on it exchanges ``df`` anew.

    A frame grouped by the join key is joined where it lies, and then adaptive
    execution cannot split the other side's large partitions. The frame is small.
    """
    return df.withColumn(key, F.concat(F.col(key), F.lit("")))

"""Repeatable capped sample of each week."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from strikepath.functions.aggregates import rows
from strikepath.operators.panel import order_column

#: Draws are whole numbers of 15 hexadecimal digits.
DIGITS = 15


def capped_sample(
    features: DataFrame, cap: int, seed: int = 42, sized_by: DataFrame | None = None
) -> DataFrame:
    """Of each week as many rows as it has, at most ``cap``; the caller always chooses it.

    Rows are picked by a seeded digest of their key, so a rerun, a lost executor or
    another engine gives the same sample. Hash values a little above the needed share are kept
    first, which leaves about ``cap`` rows per week to rank, never the week.
    ``sized_by`` is a cheaper frame with the same rows per week to count.
    """
    at = order_column(features)
    key = F.md5(F.concat_ws("|", F.lit(str(seed)), F.coalesce("ticker", F.lit("")), F.unix_micros(at).cast("string")))
    draw = F.conv(F.substring(key, 1, DIGITS), 16, 10).cast("bigint")
    sizes = (features if sized_by is None else sized_by).groupBy("week_id").agg(rows().alias("_n"))
    # Eight deviations of the drawn count above the cap.
    limit = sizes.select("week_id", (F.lit(float(16**DIGITS)) * (cap + 8 * math.isqrt(cap) + 8) / F.col("_n")).alias("_limit"))
    rank = F.row_number().over(W.partitionBy("week_id").orderBy("_draw", "ticker", at))
    return (
        # One limit per week, so the broadcast is bounded by the calendar.
        features.join(F.broadcast(limit), "week_id")
        .withColumn("_draw", draw)
        .where(F.col("_draw") < F.col("_limit"))
        .withColumn("_rank", rank)
        .where(F.col("_rank") <= cap)
        .drop("_limit", "_draw", "_rank")
    )

"""Price, return, distance and quote expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


SNAPPED_BELOW = 1e9


def snap(value: str | Column) -> Column:
    """Nearest millionth, halves up. Plain arithmetic, where ``round`` would go through decimals.

    NaN, infinities and numbers from a billion on, which hold no millionths worth
    rounding, stay as they are.
    """
    v = _col(value)
    return F.when(F.abs(v) < SNAPPED_BELOW, F.floor(v * 1e6 + 0.5) / 1e6).otherwise(v)


def cents(dollars: str | Column) -> Column:
    return _col(dollars) * 100


def mid_cents(bid: str | Column, ask: str | Column) -> Column:
    return (_col(ask) + _col(bid)) / 2 * 100


def valid_quote(bid: str | Column, ask: str | Column) -> Column:
    """Both sides there, both above zero, and not crossed. Never NULL."""
    b, a = _col(bid), _col(ask)
    return F.coalesce((b > 0) & (a > 0) & (a >= b), F.lit(False))


def quote_mid(bid: str | Column, ask: str | Column) -> Column:
    return F.when(valid_quote(bid, ask), (_col(bid) + _col(ask)) / 2)


def quote_spread(bid: str | Column, ask: str | Column) -> Column:
    return F.when(valid_quote(bid, ask), _col(ask) - _col(bid))


def change(last: str | Column, first: str | Column) -> Column:
    return _col(last) - _col(first)


def return_pct(last: str | Column, first: str | Column) -> Column:
    return F.try_divide(_col(last) - _col(first), _col(first)) * 100


def bps_of(value: str | Column, base: str | Column, denominator: str | Column) -> Column:
    """``value - base`` in basis points of ``denominator``; NULL if either is NULL."""
    v, b = _col(value), _col(base)
    return F.when(v.isNotNull() & b.isNotNull(), F.try_divide(v - b, _col(denominator)) * 10_000)


def log_return_bps(value: str | Column, previous: str | Column) -> Column:
    """Natural-log return in basis points; NULL where the ratio is not positive."""
    return F.ln(F.try_divide(_col(value), _col(previous))) * 10_000


def window_direction(label: str | Column) -> Column:
    return F.when(_col(label) == 1, "Up / YES-like").otherwise("Down / NO-like")


def futures_direction(price_change: str | Column) -> Column:
    return F.when(_col(price_change) >= 0, "Up").otherwise("Down")


def share_pct(part: Column, whole: Column) -> Column:
    """Percentage that is 0 when there is nothing to divide by."""
    return F.coalesce(F.try_divide(part * 100.0, whole), F.lit(0.0))


# Prices up to this size at their 99th percentile are taken to be dollars.
DOLLAR_CEILING = 1.5


def dollar_counters(column: str | Column, ceiling: float = DOLLAR_CEILING) -> dict[str, Column]:
    """Aggregates that tell where the 99th percentile of ``|x|`` lies: rows, rows at or below the ceiling, nearest values."""
    size = F.abs(_col(column).try_cast("double"))
    return {
        "n": F.count(size),
        "below": F.count_if(size <= ceiling),
        "under": F.max(F.when(size <= ceiling, size)),
        "over": F.min(F.when(size > ceiling, size)),
    }


def merged_counters(column: Callable[[str], Column]) -> dict[str, Column]:
    """The counters of a whole from those of its parts; ``column`` names the column of a counter."""
    merge = {"n": F.sum, "below": F.sum, "under": F.max, "over": F.min}
    return {name: f(column(name)) for name, f in merge.items()}


def dollars_by_counters(counters: dict[str, Column], ceiling: float = DOLLAR_CEILING) -> Column:
    """Is the interpolated 99th percentile at or below the ceiling? Exact, without the group's values."""
    count, below = counters["n"], counters["below"]
    position = (count - 1) * F.lit(0.99)
    rank = F.floor(position)
    weight = position - rank
    between = counters["under"] + weight * (counters["over"] - counters["under"])
    return (
        F.when(count == 0, False)
        .when(below >= rank + 2, True)
        .when(below < rank + 1, False)
        .when(weight == 0, True)
        .otherwise(F.coalesce(between <= ceiling, F.lit(True)))
    )


def looks_like_dollars(column: str | Column, ceiling: float = DOLLAR_CEILING) -> Column:
    """Aggregate: is the 99th percentile of ``|x|`` at or below ``ceiling``?"""
    return dollars_by_counters(dollar_counters(column, ceiling), ceiling)

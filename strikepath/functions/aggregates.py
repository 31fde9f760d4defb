"""Small aggregate expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Place of a row among all rows of its source, file after file.
SOURCE_ROW = "source_row"


def sum_or_zero(column: str | Column) -> Column:
    """Sum that is 0, not NULL, over an all-NULL group."""
    return F.coalesce(F.sum(column), F.lit(0))


# Groups whose largest magnitude lies between these are summed as decimals with 18 places.
LEAST_EXACT, MOST_EXACT = 1e-6, 1e18


def exact_mean(column: str | Column) -> Column:
    """Mean from an exact decimal sum and one division, so the order of rows cannot show.

    A group whose values are all tiny, or that holds one beyond 1e18, an infinity or NaN, or
    whose sum needs more than 38 digits, has the plain floating-point mean instead: no value is left out.
    """
    value = F.col(column) if isinstance(column, str) else column
    exact = F.try_sum(value.try_cast("decimal(38,18)")).cast("double")
    fits = F.max(F.abs(value)).between(LEAST_EXACT, MOST_EXACT) & exact.isNotNull()
    return F.when(fits, F.try_divide(exact, F.count(value))).otherwise(F.avg(value))


def distinct_with_null(column: str) -> Column:
    """Exact distinct count in which NULL is one more value."""
    return F.count_distinct(column) + F.coalesce(F.max(F.col(column).isNull().cast("int")), F.lit(0))


def first_by(column: str | Column, order: str | Column) -> Column:
    """Value on the first row in ``order``, kept even when it is NULL."""
    return F.min_by(column, order)


def last_by(column: str | Column, order: str | Column) -> Column:
    """Value on the last row in ``order``, kept even when it is NULL."""
    return F.max_by(column, order)


def tick_order(time: str, value: str, columns: Sequence[str]) -> Column:
    """Order of ticks: by time, then by their place in the source's files where ``columns`` has it, else by value.

    Time and place make one fixed-width number, so aggregates on it stay hash
    aggregates; time and value are a pair, which any two values order rightly.
    """
    if SOURCE_ROW not in columns:
        return F.struct(time, value)
    return F.unix_micros(time).cast("decimal(17,0)") * F.lit(Decimal(10**19)) + F.col(SOURCE_ROW).cast("decimal(19,0)")


def first_known_by(column: str, *order: str) -> Column:
    """First non-NULL value in ``order``."""
    return F.min_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


def last_known_by(column: str, *order: str) -> Column:
    """Last non-NULL value in ``order``."""
    return F.max_by(column, F.when(F.col(column).isNotNull(), F.struct(*order)))


def rows() -> Column:
    return F.count(F.lit(1))

"""Time truncation, shifting, differences and week naming. Everything is UTC."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WINDOW_SECONDS = 15 * 60
ID_FORMAT = "yyyy-MM-dd"
LABEL_FORMAT = "MMM dd, yyyy"


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value


def week_start(ts: str | Column) -> Column:
    """Monday 00:00 of the ISO week."""
    return F.date_trunc("WEEK", _col(ts))


def floor_to(ts: str | Column, seconds: int = WINDOW_SECONDS) -> Column:
    """Start of the fixed-width window that holds ``ts``."""
    epoch = F.unix_seconds(_col(ts))
    return F.timestamp_seconds(epoch - F.pmod(epoch, F.lit(seconds)))


def floor_second(ts: str | Column) -> Column:
    return F.date_trunc("SECOND", _col(ts))


def minus_minutes(ts: str | Column, minutes: str | Column | float) -> Column:
    """``ts`` less a possibly fractional, possibly per-row number of minutes."""
    amount = F.lit(minutes) if isinstance(minutes, (int, float)) else _col(minutes)
    micros = F.floor(amount * F.lit(60_000_000.0) + 0.5)
    return F.timestamp_micros(F.unix_micros(_col(ts)) - micros)


def whole_seconds(later: str | Column, earlier: str | Column) -> Column:
    """Whole seconds from ``earlier`` to ``later``, cut toward zero."""
    return F.timestamp_diff("SECOND", _col(earlier), _col(later))


def week_id(start: str | Column) -> Column:
    return F.date_format(_col(start), ID_FORMAT)


def week_label(start: str | Column, sep: str = " to ") -> Column:
    first = _col(start)
    return F.concat_ws(
        sep,
        F.date_format(first, LABEL_FORMAT),
        F.date_format(F.date_add(F.to_date(first), 6), LABEL_FORMAT),
    )


def week_label_from_id(week: str | Column, sep: str = " - ") -> Column:
    """Label of a week id; an id that is not a date labels itself."""
    ident = _col(week)
    day = F.when(ident.rlike(r"^\d{4}-\d{1,2}-\d{1,2}$"), F.try_to_date(ident))
    return F.when(day.isNotNull(), week_label(day, sep)).otherwise(ident)


def parse_time(value: str | Column) -> Column:
    """Timestamp, or NULL when the text is not one."""
    return _col(value).try_cast("timestamp")


def parse_number(value: str | Column) -> Column:
    """Double, or NULL when the text is not one."""
    number = _col(value).try_cast("double")
    return F.when(~F.isnan(number), number)

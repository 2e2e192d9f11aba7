"""Scalar helpers (Column -> Column), all JVM-side built-ins.

Each helper pins one SQL behaviour of the source system that Spark spells
differently (NULL handling in clip, 1-based array access, padded month names,
Sunday-based day of week, epoch seconds to date without a time zone).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(x: ColumnOrName) -> Column:
    return F.col(x) if isinstance(x, str) else x


def trim_spaces(x: ColumnOrName) -> Column:
    """SQL ``TRIM``: strips blanks only; tabs and newlines stay."""
    return F.trim(_c(x))


def is_blank(x: ColumnOrName) -> Column:
    """``TRIM(x) = ''``; NULL stays NULL (so a filter drops it)."""
    return trim_spaces(x) == F.lit("")


def clip(x: ColumnOrName, lo, hi, dtype: str | None = None) -> Column:
    """``GREATEST(lo, LEAST(hi, x))``.

    Both functions skip NULLs, so a NULL input becomes ``hi`` — kept on
    purpose (a missing community score is read as the maximum). The result
    is cast back to ``dtype`` because the widened decimal type differs.
    """
    out = F.greatest(F.lit(lo), F.least(F.lit(hi), _c(x)))
    return out.cast(dtype) if dtype else out


def first_element(arr: ColumnOrName) -> Column:
    """``arr[1]`` in 1-based SQL: NULL for an empty or NULL array (never raises)."""
    return F.get(_c(arr), 0)


def epoch_seconds_to_date(x: ColumnOrName) -> Column:
    """``TO_TIMESTAMP(epoch)::DATE`` in UTC, as integer arithmetic.

    ``floor(x / 86400)`` days after 1970-01-01; independent of the session
    zone, and NULL in gives NULL out.
    """
    days = F.floor(_c(x) / F.lit(86400)).cast("int")
    return F.date_from_unix_date(days)


def date_to_epoch_seconds(x: ColumnOrName) -> Column:
    """Midnight UTC of a date (or the day of a timestamp) in epoch seconds."""
    return F.unix_date(F.to_date(_c(x))).cast("bigint") * F.lit(86400)


def date_key(d: ColumnOrName) -> Column:
    """``TO_CHAR(d, 'YYYYMMDD')::INT`` without going through a string."""
    d = _c(d)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def padded_month_name(d: ColumnOrName, width: int = 9) -> Column:
    """``TO_CHAR(d, 'Month')``: English month name blank-padded to 9 chars."""
    return F.rpad(F.date_format(_c(d), "MMMM"), width, " ")


def padded_day_name(d: ColumnOrName, width: int = 9) -> Column:
    """``TO_CHAR(d, 'Day')``: English day name blank-padded to 9 chars."""
    return F.rpad(F.date_format(_c(d), "EEEE"), width, " ")


def day_of_week_sunday0(d: ColumnOrName) -> Column:
    """``EXTRACT(DOW)``: 0 = Sunday … 6 = Saturday."""
    return (F.dayofweek(_c(d)) - 1).cast("int")


def iso_week(d: ColumnOrName) -> Column:
    """``EXTRACT(WEEK)``: ISO-8601 week number 1–53."""
    return F.weekofyear(_c(d)).cast("int")


def is_weekend(d: ColumnOrName) -> Column:
    return F.dayofweek(_c(d)).isin(1, 7)


def text_prefix(x: ColumnOrName, n: int) -> Column:
    """``t[:n] if t else ''``: first n code points, NULL and '' give ''."""
    return F.substring(F.coalesce(_c(x), F.lit("")), 1, n)


def map_with_default(x: ColumnOrName, mapping: dict[str, str]) -> Column:
    """``mapping.get(x, x)``: known keys are renamed, others pass through."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    m = F.create_map(*pairs)
    return F.coalesce(F.try_element_at(m, _c(x)), _c(x))


def percent_text(x: ColumnOrName, digits: int = 1) -> Column:
    """Display a ratio as ``'45.7%'``: x*100, half-even rounding, then text."""
    return F.concat(F.bround(_c(x) * 100, digits).cast("string"), F.lit("%"))


def display_round(x: ColumnOrName, digits: int = 3) -> Column:
    """Display rounding as a data-frame library does it (half to even)."""
    return F.bround(_c(x), digits)

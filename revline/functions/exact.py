"""Exact rounding on integers.

The source system rounds NUMERIC values half away from zero. Doing the same
on doubles (or on Spark's fixed-scale decimal averages, which already round
once to scale+4) can flip the last digit. All averages and ratios here are
therefore computed on integers and only turned into a double at the end:

    round(num / den, k)  ==  (2 * num * 10^k + den) div (2 * den) / 10^k

for non-negative ``num`` and positive ``den``. The scaled integer is also a
total-order sort key, so rankings never depend on float noise.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """SQL integral division ``a div b`` (BIGINT, truncating)."""
    return F.call_function("div", a.cast("bigint"), b.cast("bigint"))


def round_half_up_scaled(num: Column, den: Column, digits: int) -> Column:
    """``round(num/den, digits) * 10^digits`` as BIGINT, for num >= 0.

    NULL when ``den`` is 0 or NULL (the ``NULLIF(den, 0)`` guard).
    """
    scale = F.lit(10 ** digits).cast("bigint")
    den_nz = F.nullif(den.cast("bigint"), F.lit(0).cast("bigint"))
    return idiv(F.lit(2) * num.cast("bigint") * scale + den_nz, F.lit(2) * den_nz)


def scaled_to_double(x: Column, digits: int) -> Column:
    """Turn a scaled integer back into a double: ``x / 10^digits``."""
    return x.cast("double") / F.lit(float(10 ** digits))


def double_to_scaled(x: Column, digits: int) -> Column:
    """Recover the integer of a value that already has ``digits`` decimals."""
    return F.round(x * F.lit(float(10 ** digits)), 0).cast("bigint")


def weighted_score_scaled(ratio_e4: Column, community_e2: Column) -> Column:
    """``round(0.6 * ratio + 0.4 * (community / 100), 4) * 10^4`` exactly.

    With ``ratio = r / 10^4`` and ``community = c / 10^2`` the unrounded value
    times 10^4 is ``(6r + 4c) / 10``; half-up rounding of a non-negative value
    is ``(6r + 4c + 5) div 10``.
    """
    return idiv(F.lit(6) * ratio_e4 + F.lit(4) * community_e2 + F.lit(5), F.lit(10))

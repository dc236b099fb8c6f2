"""Exact half-up rounding of ratios to four decimals.

Rounding a double (``round(x, 4)``) differs between engines when the
quotient ends in ...5, which is common for means of 4-decimal values.
Ratios are therefore kept as integers in ten-thousandths (long arithmetic,
integral division) and turned into a double once at the end, which gives
the same double in every engine.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def idiv(a: Column, b: Column) -> Column:
    """Integral division of longs (SQL ``a div b``)."""
    return F.call_function("div", a.cast("long"), b.cast("long"))


def half_up_4(num: Column, den: Column) -> Column:
    """round_half_up(num / den, 4) * 10000 as a long; NULL when den <= 0.

    floor((20000 * num + den) / (2 * den)) for non-negative num and den.
    """
    n, d = num.cast("long"), den.cast("long")
    return F.when(d > 0, idiv(F.lit(20000) * n + d, F.lit(2) * d))


def mean_half_up_4(parts: list[Column]) -> Column:
    """round_half_up(mean of values already in ten-thousandths) as a long."""
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    n = len(parts)
    return idiv(F.lit(2) * total + F.lit(n), F.lit(2 * n))


def tenths_of_mille_to_double(c: Column) -> Column:
    return c.cast("double") / F.lit(10000.0)

"""Fact measures and ratio features (F11-F20), exact decimal arithmetic.

Operands are narrowed to the precision they need before multiplying so that
products stay exact (Spark caps decimals at 38 digits and would otherwise
round intermediate results); only the final value is rounded HALF_UP.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def gross_amount(qty, price) -> Column:
    """round(qty × price, 4)."""
    return (_c(qty).cast("decimal(5,0)") * _c(price).cast("decimal(15,4)")).cast("decimal(19,4)")


def discount_amount(qty, price, rate) -> Column:
    """round(qty × price × rate, 4) with the rate narrowed first."""
    return (_c(qty).cast("decimal(5,0)") * _c(price).cast("decimal(15,4)")
            * _c(rate).cast("decimal(9,4)")).cast("decimal(19,4)")


def margin_amount(net, qty, cost) -> Column:
    """round(net − round(qty × cost, 4), 4), stored at scale 6."""
    cost_total = (_c(qty).cast("decimal(5,0)") * _c(cost).cast("decimal(15,4)")).cast("decimal(19,4)")
    return F.round(_c(net).cast("decimal(30,6)") - cost_total, 4).cast("decimal(38,6)")


def guarded_ratio(num, den) -> Column:
    """num / den as double, 0 when the denominator is 0, null when an input is null."""
    n = _c(num).cast("double")
    d = _c(den).cast("double")
    return F.when(d == 0, F.lit(0.0)).otherwise(n / d)


def growth(cur, prev) -> Column:
    """(cur − prev) / prev; 0 when prev = 0; null when prev is null."""
    c = _c(cur).cast("double")
    p = _c(prev).cast("double")
    return F.when(p == 0, F.lit(0.0)).otherwise((c - p) / p)


def season_flags(month) -> dict:
    """is_q4 / is_year_end_season / is_mid_year as 0/1."""
    m = _c(month)
    return {
        "is_q4": (F.ceil(m / 3) == 4).cast("int"),
        "is_year_end_season": m.isin(11, 12).cast("int"),
        "is_mid_year": m.isin(6, 7).cast("int"),
    }


def month_cycle(month) -> dict:
    """sin/cos of 2π·month/12."""
    m = _c(month).cast("double")
    return {"month_sin": F.sin(F.lit(2 * math.pi) * m / 12),
            "month_cos": F.cos(F.lit(2 * math.pi) * m / 12)}


def quarter_of_month(month) -> Column:
    """ceil(month / 3)."""
    return F.ceil(_c(month).cast("double") / 3).cast("int")


def pct_of(num, den) -> Column:
    """100 × num / den as double (F20); callers filter den > 0 first."""
    return _c(num).cast("double") / _c(den).cast("double") * 100


def inf_to_null(c) -> Column:
    """±infinity → null (P19); the guarded ratios above never produce it."""
    col = _c(c)
    return F.when(F.abs(col) == float("inf"), F.lit(None).cast("double")).otherwise(col)

"""Rounding helpers.

The reference rounds with ``Math.round(v * 10^n) / 10^n``: half rounds toward +inf
(-2.5 -> -2). Spark's ``round`` is HALF_UP *away from zero* (-2.5 -> -3), so the
reference's rule is written as ``floor(v * 10^n + 0.5) / 10^n``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col


def round_half_up(c, digits: int = 0) -> Column:
    """FN-10: round half toward +infinity to ``digits`` decimals (double result)."""
    scale = float(10 ** digits)
    return F.floor(as_col(c) * F.lit(scale) + F.lit(0.5)) / F.lit(scale)


def report(c, digits: int = 6) -> Column:
    """Presentation rounding of a derived double (used for report columns)."""
    return F.round(as_col(c), digits)

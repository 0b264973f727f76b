"""Small shared helpers for Column arguments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_col(c) -> Column:
    """Accept a column name or a Column."""
    return F.col(c) if isinstance(c, str) else c


def names(cols) -> list[str]:
    """Normalise a str-or-sequence of column names to a list."""
    return [cols] if isinstance(cols, str) else list(cols)

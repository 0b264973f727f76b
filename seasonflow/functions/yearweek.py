"""The ``yearweek`` domain type: a 6-character string ``YYYYWW``.

Year = characters 1-4, week = characters 5-6. All helpers return Columns (JVM-side,
codegen-friendly). Parsing uses ``try_cast`` so that malformed values become NULL and
are dropped by the filters instead of failing the job (ANSI casts throw).
"""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

from .util import as_col

# Fixed values of the domain (from the reference's cleaning rules).
YEARWEEK_LENGTH = 6
MAX_WEEK = 52


def year_of(yearweek) -> Column:
    """Integer year: first four characters (Scala ``substring(0,4)``)."""
    return F.substring(as_col(yearweek), 1, 4).try_cast("int")


def week_of(yearweek) -> Column:
    """Integer week: characters 5-6 (Scala ``substring(4,6)``; ``getWeekInfo``)."""
    return F.substring(as_col(yearweek), 5, 2).try_cast("int")


def week_text(yearweek) -> Column:
    """Week as the two-character string the reference emits (``"01"`` .. ``"53"``)."""
    return F.substring(as_col(yearweek), 5, 2)


def yearweek_int(yearweek) -> Column:
    """The whole yearweek as an int; the sort key of every series."""
    return as_col(yearweek).try_cast("int")


def is_well_formed(yearweek) -> Column:
    """FLT-1: keep values of exactly six characters."""
    return F.length(as_col(yearweek)) == YEARWEEK_LENGTH


def week_at_most(yearweek, max_week: int = MAX_WEEK) -> Column:
    """FLT-2: keep weeks ``<= max_week`` (the code drops only ``> 52``)."""
    return week_of(yearweek) <= F.lit(max_week)


def iso_yearweek(ts) -> Column:
    """``YYYYWW`` of a timestamp/date using ISO-8601 year and week."""
    c = as_col(ts)
    return (F.extract(F.lit("YEAROFWEEK"), c) * 100 + F.weekofyear(c)).cast("string")


def yearweek_range(lo: str, hi: str, yearweek="yearweek") -> Column:
    """FLT-9: inclusive, lexicographic ``between`` on the string. Pushed to the scan of a
    table that has the string; where it is derived from a date, see :func:`week_dates`."""
    return as_col(yearweek).between(F.lit(lo), F.lit(hi))


def week_dates(low: str | None, high: str | None) -> tuple[date | None, date | None]:
    """The dates [first, end) of the ISO weeks ``low`` to ``high`` (``YYYYWW``, inclusive;
    None: no bound). A filter on them can be pushed to a scan that has the date."""
    first = date.fromisocalendar(int(low[:4]), int(low[4:]), 1) if low else None
    last = date.fromisocalendar(int(high[:4]), int(high[4:]), 1) if high else None
    return first, last + timedelta(weeks=1) if last else None

"""Cleaning: value caps and row filters (PRJ-11/12, FLT-1..13, JN-6).

All predicates are Column expressions, so Catalyst can push the simple ones
(equality, IN, BETWEEN, comparisons) into the parquet/JDBC scan.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.util import as_col
from ..functions.yearweek import is_well_formed, week_at_most, week_of, year_of
from .joins import lookup_join

# Fixed value of the reference: quantities above this are capped.
REFERENCE_CAP = 700000


def capped(qty, cap: float) -> Column:
    """PRJ-11: ``qty > cap -> cap``.

    NULL stays NULL (``least`` would turn it into the cap). NaN stays NaN as in the
    reference's JVM comparison (Spark SQL orders NaN above every number, so a plain
    ``qty > cap`` would replace it).
    """
    c = as_col(qty).cast("double")
    return F.when(~F.isnan(c) & (c > F.lit(cap)), F.lit(float(cap))).otherwise(c)


def cap(df: DataFrame, cap_value: float, qty: str = "qty") -> DataFrame:
    """Replace ``qty`` by its capped value."""
    return df.withColumn(qty, capped(qty, cap_value))


def cap_keep_original(df: DataFrame, cap_value: float, qty: str = "qty",
                      original: str = "original_qty") -> DataFrame:
    """PRJ-12: capped ``qty`` with the untouched value kept beside it."""
    return df.withColumn(original, F.col(qty)).withColumn(qty, capped(qty, cap_value))


def valid_yearweek(df: DataFrame, yearweek: str = "yearweek") -> DataFrame:
    """FLT-1: drop rows whose yearweek is not six characters long."""
    return df.filter(is_well_formed(yearweek))


def drop_late_weeks(df: DataFrame, max_week: int = 52, yearweek: str = "yearweek") -> DataFrame:
    """FLT-2: keep weeks <= ``max_week`` (unparsable weeks are dropped too)."""
    return df.filter(week_at_most(yearweek, max_week))


def in_set(df: DataFrame, values: Iterable, column: str = "product") -> DataFrame:
    """FLT-3/4: membership in a literal set (an IN list, pushable to the scan)."""
    return df.filter(F.col(column).isin(list(values)))


def any_equal(df: DataFrame, values: Iterable, column: str = "product") -> DataFrame:
    """FLT-5: the OR-of-equalities form; Catalyst turns it into the same IN."""
    cond = None
    for v in values:
        term = F.col(column) == F.lit(v)
        cond = term if cond is None else (cond | term)
    return df.filter(cond if cond is not None else F.lit(False))


def precedence_filter(df: DataFrame, min_year: int, bad_week: int, first: str, second: str,
                      yearweek: str = "yearweek", product: str = "product") -> DataFrame:
    """FLT-6: ``year >= y && week != w && product == first || product == second``.

    ``&&`` binds tighter than ``||``, so rows of ``second`` skip the year/week tests;
    reproduced with explicit parentheses.
    """
    a = (year_of(yearweek) >= min_year) & (week_of(yearweek) != bad_week) & (F.col(product) == first)
    return df.filter(a | (F.col(product) == second))


def over(df: DataFrame, threshold: float, qty: str = "qty") -> DataFrame:
    """FLT-7: rows whose quantity is above a threshold."""
    return df.filter(F.col(qty) > F.lit(threshold))


def parameter_lookup(params: DataFrame, names, category: str = "COMMON", to: str = "int") -> DataFrame:
    """AGG-12 as a lookup: one row with the map ``values`` from each of ``names`` to its
    active value, the smallest that parses as ``to`` where there are several.

    ``names`` bounds the map; the rows of other names (lists, see :func:`parameter_filter`)
    are never gathered. A name without an active value is not in the map.
    """
    active = params.filter((F.col("use_yn") == "Y") & (F.col("param_category") == category)
                           & F.col("param_name").isin(list(names)))
    value = F.min(F.col("param_value").try_cast(to)).alias("value")
    each = active.groupBy("param_name").agg(value).filter(F.col("value").isNotNull())
    return each.agg(F.map_from_entries(
        F.collect_list(F.struct("param_name", "value"))).alias("values"))


def parameter_filter(df: DataFrame, params: DataFrame, category: str = "COMMON",
                     default_week: int = 53, default_year: int = 2016,
                     yearweek: str = "yearweek", product: str = "product") -> DataFrame:
    """FLT-12/13 + JN-6: filter driven by a parameter table.

    ``params`` has ``param_category, param_name, param_value, use_yn``. Active rows
    (``use_yn = 'Y'``) of ``category`` give ``VALID_WEEK`` (keep ``week < value``),
    ``VALID_YEAR`` (keep ``year >= value``) and ``VALID_PRODUCT`` (one row per product).
    Missing scalars fall back to the defaults (the smallest value wins when several
    active rows give one); a missing product list keeps nothing.

    Nothing is collected: the scalars are a one-row map (:func:`parameter_lookup`) read by a
    scalar subquery, the product list is a left-semi join that the planner broadcasts if the
    size it sees at run time allows.
    """
    active = params.filter((F.col("use_yn") == "Y") & (F.col("param_category") == category))
    values = parameter_lookup(params, ("VALID_WEEK", "VALID_YEAR"), category).select("values").scalar()
    valid_week = F.coalesce(F.try_element_at(values, F.lit("VALID_WEEK")), F.lit(default_week))
    valid_year = F.coalesce(F.try_element_at(values, F.lit("VALID_YEAR")), F.lit(default_year))
    products = (active.filter(F.col("param_name") == "VALID_PRODUCT")
                .select(F.col("param_value").alias(product)).distinct())
    kept = lookup_join(df, products, product, "left_semi")
    return kept.filter((week_of(yearweek) < valid_week) & (year_of(yearweek) >= valid_year))

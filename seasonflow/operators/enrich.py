"""Enrichment: master-data lookups and derived columns (PRJ-1..10, JN-1..5)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.util import as_col
from ..functions.yearweek import week_of
from .groupstats import key_column
from .joins import lookup_join

# Fixed values of the reference: grade labels, highest tier first.
GRADE_LABELS = ("수", "우", "양")
# Week numbers treated as holiday weeks in the forecast input.
HOLIDAY_WEEKS = (1, 51, 52)


def flag(condition: Column) -> Column:
    """PRJ-9: ``case when cond then 1 else 0 end`` (NULL -> 0)."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def yn_flag(c, yes: str = "Y") -> Column:
    """1 for ``'Y'``, else 0 (the reference's promotion/holiday codes)."""
    return flag(as_col(c) == F.lit(yes))


def holiday_flag(yearweek="yearweek", weeks=HOLIDAY_WEEKS) -> Column:
    return flag(week_of(yearweek).isin(list(weeks)))


def grade(value, high: float, low: float, labels=GRADE_LABELS) -> Column:
    """PRJ-10: three tiers: ``> high``, ``> low and <= high``, else."""
    v = as_col(value)
    top, mid, rest = labels
    return (F.when(v > F.lit(high), F.lit(top))
            .when((v > F.lit(low)) & (v <= F.lit(high)), F.lit(mid))
            .otherwise(F.lit(rest)))


def with_product_name(fact: DataFrame, master: DataFrame, how: str = "left",
                      product: str = "product", master_key: str = "product_id",
                      name: str = "product_name", out: str = "productname") -> DataFrame:
    """JN-1/2/5: attach the master's name column to every fact row.

    The master is renamed to the fact's key so the join is a plain equi-join and the
    key appears once; the planner decides how, on the sizes it sees at run time.
    """
    m = master.select(F.col(master_key).alias(product), F.col(name).alias(out))
    return lookup_join(fact, m, product, how)


def raw_data(sellout: DataFrame, master: DataFrame, how: str = "left") -> DataFrame:
    """JN-5 + PRJ-2/3/4: keyed, renamed, typed fact joined to the product master."""
    j = with_product_name(sellout, master, how)
    return j.select(
        key_column().alias("keycol"),
        F.col("regionid").alias("accountid"),
        "product", "yearweek",
        F.col("qty").cast("double").alias("qty"),
        "productname")

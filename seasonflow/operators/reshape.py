"""Reshaping, sorting and shares (SET-1/2, SRT-1..3, FN-12)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.rounding import round_half_up
from ..functions.util import names
from .joins import attach

# Fixed values of the reference: measure labels after its statement is upper-cased.
REAL_MEASURE = "REAL-QTY"
PREDICTION_MEASURE = "PREDICTION-QTY"


def measures_union(df: DataFrame, ids, real: str, predicted: str,
                   measure: str = "MEASURE", value: str = "SALES",
                   labels=(REAL_MEASURE, PREDICTION_MEASURE)) -> DataFrame:
    """SET-1: ``select 'real', ids, real union all select 'pred', ids, pred``."""
    ids = names(ids)
    a = df.select(F.lit(labels[0]).alias(measure), *ids, F.col(real).cast("double").alias(value))
    b = df.select(F.lit(labels[1]).alias(measure), *ids, F.col(predicted).cast("double").alias(value))
    return a.unionByName(b)


def measures_unpivot(df: DataFrame, ids, real: str, predicted: str,
                     measure: str = "MEASURE", value: str = "SALES",
                     labels=(REAL_MEASURE, PREDICTION_MEASURE)) -> DataFrame:
    """SET-2: the same long table from one scan with ``unpivot`` (Expand, no union)."""
    ids = names(ids)
    wide = df.select(*ids, F.col(real).cast("double").alias(labels[0]),
                     F.col(predicted).cast("double").alias(labels[1]))
    return wide.unpivot(ids, list(labels), measure, value).select(measure, *ids, value)


def sort_total(df: DataFrame, *order) -> DataFrame:
    """SRT-1: global ascending sort (range-partitioned by Spark)."""
    return df.orderBy(*[F.asc(c) if isinstance(c, str) else c for c in order])


def top_k(df: DataFrame, k: int, by: str, ties) -> DataFrame:
    """SRT-3: the k largest rows by ``by`` with a total tie-break order.

    Planned as TakeOrderedAndProject: each task keeps its own top k, the merge sees
    ``k x tasks`` rows, so nothing proportional to the input reaches one task.
    """
    return df.orderBy(F.desc(by), *[F.asc(c) for c in names(ties)]).limit(k)


def shares_with_residual(df: DataFrame, group, item: str, value: str, total: float = 100.0,
                         digits: int = 2, out: str = "share") -> DataFrame:
    """FN-12: percentage shares rounded half-up, residual added to the first item.

    Per ``group``: ``share = round_half_up(total * value / sum(value), digits)``; the
    rounding residual ``round_half_up(total - sum(share), digits)`` is added to the
    alphabetically first ``item`` so that the rounded shares add up to ``total``.
    Repeated items are summed first: there is one row for each (group, item). A group
    whose values sum to zero has null shares; a null group is a group.
    Both per-group numbers are partial aggregates attached back by key (no window
    over a whole group, so a group with very many items is not one task).
    """
    group = names(group)
    rows = df.groupBy(*group, item).agg(F.sum(value).alias(value))
    sums = rows.groupBy(*group).agg(F.sum(value).alias("_group_sum"))
    whole = F.nullif(F.col("_group_sum"), F.lit(0.0))
    shares = attach(rows, sums, group).withColumn(
        out, round_half_up(F.lit(total) * F.col(value) / whole, digits)
    ).drop("_group_sum")
    fix = shares.groupBy(*group).agg(
        round_half_up(F.lit(total) - F.sum(out), digits).alias("_residual"),
        F.min(item).alias("_first_item"))
    return (attach(shares, fix, group)
            .withColumn(out, F.when(F.col(item) == F.col("_first_item"),
                                    F.col(out) + F.col("_residual")).otherwise(F.col(out)))
            .drop("_residual", "_first_item"))

"""Weekly series: centred moving averages, seasonal ratios, week-of-year index.

WIN-4..10, AGG-10/11. The reference groups each (region, product) series onto one
executor, sorts it, computes a centred moving average with hand-built edge values
and scatters the result back. Here the whole job is window functions over a ROWS
frame: for ``h = order // 2`` the edge rule of the reference ("average of the rows
that exist in ``[p-h, p+h]``") is exactly what a ``rowsBetween(-h, h)`` frame does
at the start and end of a partition, so one frame covers interior and edges.

Scale: the series is first reduced to one row per (key, yearweek) (``series``), so a
window partition holds at most one row per calendar week whatever the input volume
or key skew; the per-week reduction is a partial (map-side) aggregate. The index
aggregation groups by a superset of the window keys, so it reuses the window's
hash partitioning: one shuffle for the whole pipeline after the series reduction.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, Window, WindowSpec
from pyspark.sql import functions as F

from ..functions.util import names
from ..functions.yearweek import week_text, yearweek_int
from .groupstats import group_stats
from .joins import attach
from .numbering import block_of, with_group_position, with_halo

SERIES_KEYS = ("regionid", "product")
SHORT_SERIES_POLICIES = ("error", "drop", "truncate")

# Fixed values of the reference job.
REFERENCE_ORDER = 17

# Rows of a block of a series in :func:`moving_average_blocked`.
BLOCK_ROWS = 4096


def series(df: DataFrame, keys=SERIES_KEYS, yearweek: str = "yearweek", qty: str = "qty",
           duplicates: str = "sum") -> DataFrame:
    """Normalise to one row per (key, yearweek).

    ``duplicates="sum"`` (default) adds up repeated weeks, which bounds every series by
    the number of calendar weeks. ``"keep"`` leaves rows as they are; repeated weeks
    are then ordered by quantity (a total order, so reruns agree).
    """
    keys = names(keys)
    if duplicates == "keep":
        return df
    if duplicates != "sum":
        raise ValueError("duplicates must be 'sum' or 'keep'")
    return df.groupBy(*keys, yearweek).agg(F.sum(qty).alias(qty))


def ordered(keys=SERIES_KEYS, yearweek: str = "yearweek", qty: str = "qty") -> WindowSpec:
    """SRT-2: partition per series, ordered by the integer yearweek (ties by text, qty)."""
    return Window.partitionBy(*names(keys)).orderBy(
        yearweek_int(yearweek), F.col(yearweek), F.col(qty))


def row_index(keys=SERIES_KEYS, yearweek: str = "yearweek", qty: str = "qty") -> Column:
    """WIN-4: 0-based position of a row inside its ordered series (``zipWithIndex``)."""
    return (F.row_number().over(ordered(keys, yearweek, qty)) - 1).cast("bigint")


def centred_ma(qty: str = "qty", order: int = REFERENCE_ORDER, keys=SERIES_KEYS,
               yearweek: str = "yearweek") -> Column:
    """WIN-5/6/7: centred moving average of ``order`` rows with truncated edges.

    Odd order: mean of the ``[-h, h]`` frame. Even order (2 x m average): on interior
    rows ``h <= p <= n-1-h`` the mean of the two ``order``-row windows around the row,
    ``(mean[-h, h-1] + mean[-h+1, h]) / 2``; on the ``h`` rows at each end the
    truncated ``[-h, h]`` mean, as the reference's edge arrays do.
    """
    if order <= 2:
        raise ValueError("moving-average order must be > 2")
    h = order // 2
    w = ordered(keys, yearweek, qty)
    full = F.avg(qty).over(w.rowsBetween(-h, h))
    if order % 2 == 1:
        return full
    pos = F.row_number().over(w) - 1
    n = F.count(F.lit(1)).over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    two_by_m = (F.avg(qty).over(w.rowsBetween(-h, h - 1))
                + F.avg(qty).over(w.rowsBetween(-h + 1, h))) / 2.0
    return F.when((pos >= h) & (pos <= n - 1 - h), two_by_m).otherwise(full)


def moving_average(df: DataFrame, order: int = REFERENCE_ORDER, keys=SERIES_KEYS,
                   yearweek: str = "yearweek", qty: str = "qty", out: str = "ma",
                   short_series: str = "error") -> DataFrame:
    """Add the centred moving average column ``out`` to a series DataFrame.

    ``short_series`` (WIN-9, R17) handles series with fewer than ``order`` rows:
    ``"error"`` fails the job (the reference's behaviour), ``"drop"`` removes those
    series, ``"truncate"`` keeps them with the truncated frame.
    """
    if short_series not in SHORT_SERIES_POLICIES:
        raise ValueError(f"short_series must be one of {SHORT_SERIES_POLICIES}")
    ma = centred_ma(qty, order, keys, yearweek)
    if short_series == "truncate":
        return df.withColumn(out, ma)
    w = ordered(keys, yearweek, qty).rowsBetween(Window.unboundedPreceding,
                                                 Window.unboundedFollowing)
    n = F.count(F.lit(1)).over(w)
    if short_series == "drop":
        return (df.withColumn("_series_n", n).filter(F.col("_series_n") >= order)
                .withColumn(out, ma).drop("_series_n"))
    guarded = F.when(n < order, F.raise_error(
        F.concat(F.lit(f"series shorter than moving-average order {order}: "),
                 F.concat_ws("_", *[F.col(k) for k in names(keys)])))).otherwise(ma)
    return df.withColumn(out, guarded.cast("double"))


def moving_average_blocked(df: DataFrame, order: int = REFERENCE_ORDER, keys=SERIES_KEYS,
                           yearweek: str = "yearweek", qty: str = "qty", out: str = "ma",
                           idx: str = "idx", short_series: str = "error",
                           block_rows: int = BLOCK_ROWS) -> DataFrame:
    """:func:`moving_average` for series of any length, with the row index (WIN-4..7).

    Rows are numbered inside their series (:func:`numbering.with_group_position`); a window
    then sees one block of ``block_rows`` positions and ``order // 2`` rows of each
    neighbour, so one series is as many tasks as it has blocks. Same order, edges and
    policies as :func:`moving_average`; rows equal in yearweek and quantity are
    interchangeable.
    """
    if order <= 2:
        raise ValueError("moving-average order must be > 2")
    if short_series not in SHORT_SERIES_POLICIES:
        raise ValueError(f"short_series must be one of {SHORT_SERIES_POLICIES}")
    keys, h = names(keys), order // 2
    block_rows = max(block_rows, h)
    placed = with_group_position(df, keys, yearweek_int(yearweek), yearweek, qty, out=idx,
                                 size="_series_n")
    if short_series == "drop":
        placed = placed.filter(F.col("_series_n") >= order)
    spread = with_halo(placed, idx, block_rows, h, h, out="_block")
    w = Window.partitionBy(*keys, "_block").orderBy(idx)
    ma = F.avg(qty).over(w.rowsBetween(-h, h))
    if order % 2 == 0:
        two_by_m = (F.avg(qty).over(w.rowsBetween(-h, h - 1))
                    + F.avg(qty).over(w.rowsBetween(-h + 1, h))) / 2.0
        inner = (F.col(idx) >= h) & (F.col(idx) <= F.col("_series_n") - 1 - h)
        ma = F.when(inner, two_by_m).otherwise(ma)
    done = spread.withColumn(out, ma).filter(F.col("_block") == block_of(idx, block_rows))
    if short_series == "error":
        done = done.withColumn(out, F.when(F.col("_series_n") < order, F.raise_error(F.concat(
            F.lit(f"series shorter than moving-average order {order}: "),
            F.concat_ws("_", *keys)))).otherwise(F.col(out)).cast("double"))
    return done.select(*df.columns, idx, out)


def precondition(df: DataFrame, order: int = REFERENCE_ORDER, keys=SERIES_KEYS,
                 n: str = "n", accepted: str = "accepted") -> tuple[DataFrame, Observation]:
    """WIN-9 as a result: every series with its length and whether a moving average of
    ``order`` can be taken of it, and an observation that counts series and rows of both
    kinds in the pass that reads the result.

    The lengths are a partial aggregate, so a long series is not one task. A null key is a
    series.
    """
    if order <= 2:
        raise ValueError("moving-average order must be > 2")
    seen = Observation()
    sizes = group_stats(df, keys, stats=("size",)).withColumnRenamed("size", n)
    flagged = sizes.withColumn(accepted, F.col(n) >= order)
    good, rows = F.col(accepted), F.col(n)
    return flagged.observe(
        seen, F.count_if(good).alias("accepted_series"), F.count_if(~good).alias("rejected_series"),
        F.coalesce(F.sum(F.when(good, rows)), F.lit(0)).alias("accepted_rows"),
        F.coalesce(F.sum(F.when(~good, rows)), F.lit(0)).alias("rejected_rows")), seen


def accepted_rows(df: DataFrame, checked: DataFrame, keys=SERIES_KEYS,
                  accepted: str = "accepted") -> tuple[DataFrame, DataFrame]:
    """The rows of the accepted and of the rejected series of :func:`precondition`."""
    rows = attach(df, checked.select(*names(keys), F.col(accepted).alias("_ok")), keys)
    return rows.filter("_ok").drop("_ok"), rows.filter("NOT _ok").drop("_ok")


def ratio(volume: str = "qty", ma: str = "ma") -> Column:
    """WIN-8: ``volume / ma``, 1.0 when the moving average is zero."""
    return F.when(F.col(ma) != 0.0, F.col(volume) / F.col(ma)).otherwise(F.lit(1.0))


def seasonal_ratio(df: DataFrame, volume: str = "qty", ma: str = "ma", out: str = "ratio") -> DataFrame:
    return df.withColumn(out, ratio(volume, ma))


def seasonality_index(df: DataFrame, keys=SERIES_KEYS, yearweek: str = "yearweek",
                      volume: str = "qty", ma: str = "ma", ratio_col: str = "ratio") -> DataFrame:
    """AGG-10: average volume, moving average and ratio per series and week of year."""
    keys = names(keys)
    return (
        df.groupBy(*keys, week_text(yearweek).alias("week"))
        .agg(F.avg(volume).alias("avg_volume"), F.avg(ma).alias("avg_ma"),
             F.avg(ratio_col).alias("avg_ratio"))
    )


def seasonal_rows(sellout: DataFrame, order: int = REFERENCE_ORDER, cap_value: float | None = None,
                         products=None, max_week: int = 52, keys=SERIES_KEYS,
                         short_series: str = "error") -> DataFrame:
    """The flagship job: clean -> series -> moving average -> ratio (row level)."""
    from .cleaning import cap, drop_late_weeks, in_set

    df = drop_late_weeks(sellout, max_week)
    if products is not None:
        df = in_set(df, products)
    if cap_value is not None:
        df = cap(df, cap_value)  # per input row, as the reference caps before grouping
    df = series(df, keys)
    df = moving_average(df, order, keys, short_series=short_series)
    return seasonal_ratio(df)

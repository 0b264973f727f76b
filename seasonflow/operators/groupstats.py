"""Per-key statistics: flat, stretched onto rows, and nested (AGG-1..9, WIN-1..3).

The reference groups rows per key on one executor and loops over them. Here:

- flat statistics are ``groupBy().agg()`` with partial (map-side) aggregation, so a
  hot key is pre-aggregated in every task before the shuffle;
- "stretched" statistics (every row carries its group's numbers) are the flat result
  attached back with :func:`joins.attach` (null-safe on the keys; AQE broadcasts it
  when its real size allows). No window over an unbounded key partition is used, so a key
  holding a third of all rows is never one task;
- nested results collect per-key lists of *series* rows (one row per key and week,
  see ``seasonality.series``), so each list is bounded by the number of weeks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.util import names
from ..functions.yearweek import yearweek_int
from .joins import attach
from .numbering import block_of, with_group_position

STATS = ("size", "total", "average", "stddev", "dispersion")


def key_column(keys=("regionid", "product"), sep: str = "_") -> Column:
    """PRJ-3: composite key ``regionid || '_' || product`` (NULL in -> NULL out)."""
    return F.concat(*[x for k in names(keys) for x in (F.col(k), F.lit(sep))][:-1])


def stat_columns(value: str = "qty", stats=STATS) -> list[Column]:
    """Aggregate expressions for the named statistics.

    ``dispersion`` is the reference's non-standard ``sqrt(sum((x-mean)^2) / mean)``
    (AGG-6); it divides by the mean, not by n, and is NULL for a zero mean.
    """
    v = F.col(value)
    exprs = {
        "size": F.count(F.lit(1)).alias("size"),
        "total": F.sum(v).alias("total"),
        "average": F.avg(v).alias("average"),
        "stddev": F.stddev_samp(v).alias("stddev"),
        "dispersion": F.sqrt(F.var_pop(v) * F.count(v) / F.nullif(F.avg(v), F.lit(0.0)))
        .alias("dispersion"),
    }
    unknown = set(stats) - set(exprs)
    if unknown:
        raise ValueError(f"unknown statistics {sorted(unknown)}")
    return [exprs[s] for s in stats]


def group_stats(df: DataFrame, keys, value: str = "qty", stats=STATS) -> DataFrame:
    """One row per key with the requested statistics (AGG-2..6)."""
    return df.groupBy(*names(keys)).agg(*stat_columns(value, stats))


def stretch_stats(df: DataFrame, keys, value: str = "qty", stats=("size", "average")) -> DataFrame:
    """Every row with its group's statistics (WIN-1/2)."""
    return attach(df, group_stats(df, keys, value, stats), names(keys))


def ratio_to_mean(df: DataFrame, keys, value: str = "qty", out: str = "ratio",
                  stats=("size", "average", "stddev")) -> DataFrame:
    """WIN-3: rows with group size/mean/stddev and ``value / mean`` (NULL for mean 0)."""
    stats = tuple(dict.fromkeys((*stats, "average")))
    return stretch_stats(df, keys, value, stats).withColumn(
        out, F.col(value) / F.nullif(F.col("average"), F.lit(0.0)))


def nested(df: DataFrame, keys, fields, stats=(), value: str = "qty",
           yearweek: str = "yearweek", records: str = "records",
           record_stats: bool = False) -> DataFrame:
    """AGG-7..9: one row per key with its rows as an ordered list of structs.

    ``fields`` are the row columns kept in each record (ordered by yearweek);
    ``stats`` are computed in the same aggregation. With ``record_stats`` every record
    also carries the statistics (the reference repeats them per row). Input should be
    a series (one row per key and week) so that a list is bounded by the calendar.
    """
    fields = names(fields)
    rec = F.struct(yearweek_int(yearweek).alias("_order"), *[F.col(f) for f in fields])
    agg = df.groupBy(*names(keys)).agg(
        F.sort_array(F.collect_list(rec)).alias(records), *stat_columns(value, stats))
    if record_stats and stats:
        agg = agg.withColumn(records, F.transform(
            records, lambda r: F.struct(*[r[f].alias(f) for f in fields],
                                        *[F.col(s).alias(s) for s in stats])))
    else:
        agg = agg.withColumn(records, F.transform(
            records, lambda r: F.struct(*[r[f].alias(f) for f in fields])))
    return agg


def nested_chunks(df: DataFrame, keys, fields, order, chunk_rows: int = 1000, stats=(),
                  value: str = "qty", records: str = "records") -> DataFrame:
    """AGG-7..9 on raw rows: a key's records as lists of at most ``chunk_rows``, one row per
    (key, ``chunk``), with the key's ``stats``.

    Rows are numbered inside their key by ``order`` (ties by the fields), so chunk ``c`` has
    the positions from ``c * chunk_rows`` on. A key that holds a third of all rows is many
    chunks on many tasks; no cell grows with it. The statistics are a partial aggregate over
    the rows, attached to the chunks.
    """
    keys, fields = names(keys), names(fields)
    named = [c for c in order if isinstance(c, str)]
    placed = with_group_position(df, keys, *order, *[f for f in fields if f not in named],
                                 out="_idx")
    record = F.struct("_idx", *fields)
    chunks = (placed.withColumn("chunk", block_of("_idx", chunk_rows)).groupBy(*keys, "chunk")
              .agg(F.sort_array(F.collect_list(record)).alias(records))
              .withColumn(records, F.transform(
                  records, lambda r: F.struct(*[r[f].alias(f) for f in fields]))))
    return attach(chunks, group_stats(df, keys, value, stats), keys) if stats else chunks


# --- folds (AGG-14) -----------------------------------------------------------------

def product_parts(value: str = "qty") -> list[Column]:
    """Mergeable accumulators of a product: how many factors are zero and negative, and the
    sum of the logarithms of the others' magnitudes. Null factors are passed over."""
    v = F.col(value)
    return [F.count(v).alias("factors"), F.count_if(v == 0).alias("zeros"),
            F.count_if(v < 0).alias("negatives"),
            F.coalesce(F.sum(F.when(v != 0, F.ln(F.abs(v)))), F.lit(0.0)).alias("ln_magnitude")]


def _sign(negatives: Column) -> Column:
    return F.when(negatives % 2 == 1, -1.0).otherwise(1.0)


def fold_groups(df: DataFrame, keys, value: str = "qty", order=()) -> DataFrame:
    """AGG-14 at group level: the folds ``_ + _``, ``_ * _`` and ``_ / _`` of every group.

    One row per key with the accumulators of :func:`product_parts` and ``folded_sum``,
    ``folded_product``, ``folded_ratio`` (the first value by ``order``, ties by value, divided
    by all others; null if one of those is zero) and ``ln_ratio``. All are partial aggregates: no
    list, no order beyond the smallest row. A product beyond the range of doubles is infinite
    or zero; its sign and ``ln_magnitude`` stay right.
    """
    keys = names(keys)
    first = F.struct(*[F.col(c) if isinstance(c, str) else c for c in order], F.col(value))
    parts = df.groupBy(*keys).agg(
        F.sum(value).alias("folded_sum"), *product_parts(value),
        F.min_by(value, F.when(F.col(value).isNotNull(), first)).alias("first"))
    a = F.col("first")
    product = F.when(F.col("zeros") > 0, 0.0).otherwise(
        _sign(F.col("negatives")) * F.exp("ln_magnitude"))
    other_zeros = F.col("zeros") - F.when(a == 0, 1).otherwise(0)
    other_signs = _sign(F.col("negatives") - F.when(a < 0, 1).otherwise(0))
    ln_a = F.when(a != 0, F.ln(F.abs(a)))
    ln_ratio = F.when((other_zeros == 0) & (a != 0), ln_a * 2 - F.col("ln_magnitude"))
    ratio = (F.when(other_zeros > 0, F.lit(None)).when(a == 0, 0.0)
             .otherwise(F.signum(a) * other_signs * F.exp(ln_ratio)))
    empty = F.col("factors") == 0
    return parts.select(
        *keys, "folded_sum", F.when(~empty, product).alias("folded_product"),
        F.when(~empty, ratio).alias("folded_ratio"),
        "factors", "zeros", "negatives", "ln_magnitude", ln_ratio.alias("ln_ratio"))


def flatten(df: DataFrame, keys, records: str = "records", pos: str = "pos") -> DataFrame:
    """Explode a nested list back to rows with its 0-based position."""
    return df.select(*names(keys), F.posexplode(records).alias(pos, "_rec")).select(
        *names(keys), F.col(pos).cast("bigint").alias(pos), "_rec.*")

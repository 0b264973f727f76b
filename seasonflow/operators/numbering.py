"""Positions over a whole table or inside groups, and blocks of rows with their neighbours.

A window without a bounded partition (``row_number`` over all rows, or over a series of any
length) is one task for everything it numbers. Here the rows are range partitioned and
sorted; ``monotonically_increasing_id`` in that same stage gives every row its partition and
its place there; the rows are written once, so that both stay what they are; and the sizes
of the partitions, one number each, are summed up to the position each partition begins at.
Order columns are followed by a salt, so that equal rows, which are interchangeable, may be
split over partitions too.

Blocks are ranges of positions. A computation that looks ``before`` and ``after`` rows around
each row gets its block plus that many rows of the neighbouring blocks (a halo exchange): a
row is sent to at most three blocks, whatever the length of its series.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.util import names
from .joins import attach, materialize

#: ``monotonically_increasing_id`` has the partition above this bit, the place below it.
PLACE_BITS = 33
SALTS = 1024


def _ascending(c) -> Column:
    return F.asc(c) if isinstance(c, str) else c


def with_position(df: DataFrame, *order, out: str = "pos") -> DataFrame:
    """Add the 0-based position of every row in the order (SRT-1 made visible).

    ``order`` are column names (ascending, nulls first) or sort expressions; rows that are
    equal in all of them are numbered arbitrarily among themselves. The result reads the
    written rows; what goes through the driver is one number per partition.
    """
    by = [*map(_ascending, order), F.asc("_salt")]
    salted = df.withColumn("_salt", F.pmod(F.monotonically_increasing_id(), F.lit(SALTS)))
    marked = materialize(
        salted.repartitionByRange(*by).sortWithinPartitions(*by)
        .withColumn("_id", F.monotonically_increasing_id()).drop("_salt"))
    part = F.shiftright("_id", PLACE_BITS)
    sizes = marked.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n")).collect()
    starts, total = [], 0
    for row in sorted(sizes):
        starts.append((row.part, total))
        total += row.n
    begins = df.sparkSession.createDataFrame(starts, "_part long, _begin long")
    place = F.col("_id").bitwiseAND(F.lit((1 << PLACE_BITS) - 1))
    # as many rows as partitions: broadcast
    return (marked.withColumn("_part", part).join(F.broadcast(begins), "_part")
            .withColumn(out, F.col("_begin") + place).drop("_id", "_part", "_begin"))


def with_group_position(df: DataFrame, keys, *order, out: str = "idx",
                        size: str | None = None) -> DataFrame:
    """Add the 0-based position of every row inside its group (WIN-4 for groups of any
    length), and the group's number of rows as ``size`` if named.

    Rows are sorted by the keys and then ``order``, so a group that holds a third of all rows
    lies in many partitions. A null key is a group.
    """
    keys = names(keys)
    placed = with_position(df, *keys, *order, out="_pos")
    groups = placed.groupBy(*keys).agg(F.min("_pos").alias("_start"),
                                       F.count(F.lit(1)).alias("_size"))
    out_size = [F.col("_size").alias(size)] if size else []
    return attach(placed, groups, keys).select(
        *df.columns, (F.col("_pos") - F.col("_start")).alias(out), *out_size)


def block_of(position: str, block_rows: int) -> Column:
    return F.floor(F.col(position) / F.lit(block_rows)).cast("bigint")


def with_halo(df: DataFrame, position: str, block_rows: int, before: int, after: int,
              out: str = "block") -> DataFrame:
    """Send every row to its block and to the neighbours that need it: the last ``before``
    rows of a block also to the next one, the first ``after`` rows also to the previous one.

    Keep the rows with ``out == block_of(position, block_rows)`` after the computation.
    """
    if block_rows < max(before, after, 1):
        raise ValueError("a block must be as long as its halo")
    home = block_of(position, block_rows)
    place = F.col(position) - home * block_rows
    targets = F.array_compact(F.array(
        home, F.when((place < after) & (home > 0), home - 1),
        F.when(place >= block_rows - before, home + 1)))
    return df.withColumn(out, F.explode(targets))

"""Helpers shared by the operators: words, written intermediate tables, components."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir

# Word separators: space and the ASCII control characters 0x09-0x0D. `bytes.split()`
# without argument splits on exactly these, so both sides agree.
WORD_SEPARATORS = r"[\x20\x09-\x0D]+"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words(text: Column) -> Column:
    """Array of the words `[^\\x20\\x09-\\x0D]+` of a text; empty for a null text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), WORD_SEPARATORS), "")


def under(name: str, df: DataFrame, keep: list[str] | None = None) -> Column:
    """Columns ``keep`` (default all) of ``df`` as one struct, so that their names cannot
    clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in (df.columns if keep is None else keep)]).alias(name)


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """What the queries inside the block shuffle is deleted as each of them ends, not when the
    driver happens to collect garbage."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage: a lost executor costs a re-read, not the computation. Unlike an
    RDD checkpoint the table is columnar, so readers prune columns.
    """
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    with _shuffles_removed(spark):
        df.write.parquet(path)
    _note(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` in the shared checkpoint folder as a table bucketed by ``key`` and read
    it back. Joins and groupings on ``key`` then move only the other, narrow side: the
    texts of a corpus are shuffled once, however often they are joined."""
    spark = df.sparkSession
    buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
    table = f"{name}_{uuid.uuid4().hex[:12]}"
    path = f"{checkpoint_dir(spark)}/{table}"
    with _shuffles_removed(spark):
        (df.repartition(buckets, key).write.bucketBy(buckets, key).format("parquet")
         .option("compression", "zstd").option("path", path).saveAsTable(table))
    _note(path)
    return spark.table(table)


_collectors: list[list[str]] = []


def _note(path: str) -> None:
    for made in _collectors:
        made.append(path)


@contextmanager
def tables_made() -> Iterator[list[str]]:
    """Collects the paths of the tables written inside the block."""
    made: list[str] = []
    _collectors.append(made)
    try:
        yield made
    finally:
        _collectors.remove(made)


def delete(spark: SparkSession, paths: list[str]) -> None:
    """Delete written tables that nothing will read again, from the catalog too."""
    for name in paths:
        table = name.rsplit("/", 1)[-1]
        if "-" not in table:  # a bucketed one
            spark.sql(f"DROP TABLE IF EXISTS `{table}`")
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def discard(df: DataFrame) -> None:
    """Delete a table made by :func:`written` that nothing will read again."""
    delete(df.sparkSession, [file.rsplit("/", 1)[0] for file in df.inputFiles()[:1]])


def small_side(df: DataFrame, max_rows: int = 20_000) -> DataFrame:
    """Mark a written table of narrow rows for broadcast if it has at most ``max_rows``
    rows; beyond that the planner's shuffle join is used."""
    return F.broadcast(df) if df.offset(max_rows).isEmpty() else df


def components(edges: DataFrame) -> DataFrame:
    """Connected components of undirected ``edges`` (a, b): rows (node, component), one
    per node that has an edge to another node; ``component`` is its smallest node.

    Alternating large-star and small-star rounds (Kiveris et al., 2014): every round
    is a grouped minimum joined back to the edges, so no adjacency list is collected;
    each round's edges are written to the shared folder. Ends when a round changes
    nothing, i.e. every node points at the smallest node of its component.
    """
    state = written(
        edges.where("a <> b")
        .select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .distinct(), "edges")
    mark = _fingerprint(state)
    while mark[0]:
        both = state.select("u", "v").union(state.select(F.col("v"), F.col("u")))
        low = both.groupBy("u").agg(F.min(F.least("u", "v")).alias("m"))
        large = (both.where("v > u").join(low, "u")
                 .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        new = written(
            large.join(low, "u").where("v <> m")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .union(low.select("u", "m")).distinct(), "edges")
        new_mark = _fingerprint(new)
        discard(state)
        state = new
        if new_mark == mark:
            break
        mark = new_mark
    return (state.select(F.col("u").alias("node"), F.col("v").alias("component"))
            .union(state.select(F.col("v"), F.col("v")).distinct()))


def _fingerprint(edges: DataFrame) -> tuple:
    """Row count and order-free hash of a set of edges."""
    row = edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v")),
                    F.bit_xor(F.xxhash64("v", "u"))).first()
    return tuple(row)

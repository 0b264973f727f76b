"""Writers (SNK-1..7): JDBC tables and CSV files, overwrite or append.

``single_file`` (the reference's ``coalesce(1)``) is off by default: it funnels the
whole output through one task and should be used only for small reports.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MODES = ("overwrite", "append", "error", "ignore")


def _check_mode(mode: str) -> str:
    if mode not in MODES:
        raise ValueError(f"mode must be one of {MODES}")
    return mode


def write_csv(df: DataFrame, path: str, header: bool = True, mode: str = "overwrite",
              sep: str = ",", single_file: bool = False, **options) -> str:
    """SNK-4/5/6/7: CSV with or without a header line."""
    out = df.coalesce(1) if single_file else df
    w = out.write.mode(_check_mode(mode)).option("header", str(header).lower()).option("sep", sep)
    for k, v in options.items():
        w = w.option(k, v)
    w.csv(path)
    return path


def append_batch(df: DataFrame, path: str, batch_id: str, fmt: str = "parquet",
                 batch: str = "batch", **options) -> str:
    """SNK-7: append a batch so that sending it again does no harm.

    The batch is a partition folder of its own (``batch=<id>``) that a retry replaces
    (dynamic partition overwrite), where a plain append would double its rows. Other
    batches are not touched. Readers see the id as the column ``batch``, or drop it.
    """
    if batch in df.columns:
        raise ValueError(f"the rows have a column {batch!r} already")
    w = (df.withColumn(batch, F.lit(batch_id)).write.mode("overwrite").format(fmt)
         .option("partitionOverwriteMode", "dynamic").partitionBy(batch))
    for k, v in options.items():
        w = w.option(k, v)
    w.save(path)
    return path


def write_text(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """One line per row of a single string column."""
    df.write.mode(_check_mode(mode)).text(path)
    return path


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", partition_by=None) -> str:
    """Columnar output for large results (optionally partitioned, e.g. by region)."""
    w = df.write.mode(_check_mode(mode))
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    w.parquet(path)
    return path


def save_bucketed(df: DataFrame, table: str, buckets: int, by=("regionid", "product"),
                  sort_by=("regionid", "product", "yearweek"), mode: str = "overwrite",
                  path: str | None = None, fmt: str = "parquet") -> str:
    """Persist a table bucketed (and sorted) by the series key.

    Later jobs that partition by the bucket columns (the moving-average windows, the
    series and index aggregations) read it without any shuffle. ``path`` places the
    files in a shared location (otherwise the session's warehouse folder).
    """
    by = [by] if isinstance(by, str) else list(by)
    w = df.write.mode(_check_mode(mode)).format(fmt).bucketBy(buckets, *by)
    if sort_by:
        w = w.sortBy(*([sort_by] if isinstance(sort_by, str) else list(sort_by)))
    if path:
        w = w.option("path", path)
    w.saveAsTable(table)
    return table


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "overwrite", *,
               user: str | None = None, password: str | None = None, driver: str | None = None,
               truncate: bool = False, batch_size: int | None = None,
               num_partitions: int | None = None, **options) -> None:
    """SNK-1/2/3: write a table over JDBC.

    ``truncate=True`` with overwrite keeps the table definition (TRUNCATE instead of
    DROP/CREATE). ``num_partitions`` caps the concurrent connections.
    """
    props = {}
    if user is not None:
        props["user"] = user
    if password is not None:
        props["password"] = password
    if driver is not None:
        props["driver"] = driver
    if truncate:
        props["truncate"] = "true"
    if batch_size is not None:
        props["batchsize"] = str(batch_size)
    if num_partitions is not None:
        props["numPartitions"] = str(num_partitions)
    props.update({k: str(v) for k, v in options.items()})
    df.write.mode(_check_mode(mode)).jdbc(url, table, properties=props)

"""Readers (SRC-1..8): CSV, delimited text, plain text, JDBC and parquet.

Every reader takes an explicit schema where the format allows one (no inference
pass over the data). JDBC reads are parallel when a numeric/date partition column
and bounds are given; otherwise Spark reads a table through one connection, which
is the reference's behaviour and does not scale.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None,
             header: bool = True, sep: str = ",", **options) -> DataFrame:
    """SRC-1/2: CSV or delimited text with a header.

    Without a schema every column is a string (the reference never infers types).
    """
    reader = spark.read.option("header", str(header).lower()).option("sep", sep)
    for k, v in options.items():
        reader = reader.option(k, v)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.csv(path)


def read_delimited(spark: SparkSession, path: str, sep: str = ";", **kw) -> DataFrame:
    """SRC-2: ``;``-separated file with a header."""
    return read_csv(spark, path, sep=sep, **kw)


def read_text(spark: SparkSession, path: str) -> DataFrame:
    """SRC-3: one row per line in a string column ``value``."""
    return spark.read.text(path)


def read_parquet(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    return spark.read.parquet(path).select(*columns) if columns else spark.read.parquet(path)


def read_jdbc(spark: SparkSession, url: str, table: str, *, user: str | None = None,
              password: str | None = None, driver: str | None = None,
              partition_column: str | None = None, lower_bound=None, upper_bound=None,
              num_partitions: int | None = None, fetch_size: int | None = None,
              **options) -> DataFrame:
    """SRC-4..8: a table (or ``(subquery) alias``) from any JDBC database.

    PostgreSQL, MySQL, SQL Server and Oracle differ only in ``url``/``driver``.
    Credentials come from the caller. With ``partition_column`` + bounds +
    ``num_partitions`` the scan is split into parallel range queries; filters and
    projections on the result are pushed into the SQL sent to the database.
    """
    opts = {"url": url, "dbtable": table}
    if user is not None:
        opts["user"] = user
    if password is not None:
        opts["password"] = password
    if driver is not None:
        opts["driver"] = driver
    if partition_column is not None:
        if lower_bound is None or upper_bound is None or not num_partitions:
            raise ValueError("partition_column needs lower_bound, upper_bound and num_partitions")
        opts.update(partitionColumn=partition_column, lowerBound=str(lower_bound),
                    upperBound=str(upper_bound), numPartitions=str(num_partitions))
    if fetch_size is not None:
        opts["fetchsize"] = str(fetch_size)
    opts.update({k: str(v) for k, v in options.items()})
    return spark.read.format("jdbc").options(**opts).load()

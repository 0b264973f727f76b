"""Temp views and SQL text over DataFrames (SRC-9..12).

Library code passes DataFrames, not global names: :func:`sql` substitutes DataFrames
into the statement (``{name}`` placeholders) and binds values as named parameters
(``:name``), so nothing is spliced into SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def register(df: DataFrame, name: str) -> str:
    """SRC-9/10: register or replace a session temp view; returns the name."""
    df.createOrReplaceTempView(name)
    return name


def register_if_absent(spark: SparkSession, df: DataFrame, name: str) -> bool:
    """SRC-11: create the view only when no view of that name exists."""
    if spark.catalog.tableExists(name):
        return False
    df.createTempView(name)
    return True


def drop_view(spark: SparkSession, name: str) -> bool:
    """SRC-11: drop a temp view (False when it did not exist)."""
    return bool(spark.catalog.dropTempView(name))


def sql(spark: SparkSession, text: str, frames: dict[str, DataFrame] | None = None,
        **params) -> DataFrame:
    """SRC-12: run SQL with DataFrames substituted for ``{name}`` and ``:param`` bound."""
    return spark.sql(text, args=params or None, **(frames or {}))

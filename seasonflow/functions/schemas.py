"""Schemas: declared input/output shapes and checked re-typing (PRJ-13..16).

The reference finds columns by ordinal (``columns.indexOf``) and later imposes a
``StructType`` positionally. Here columns are resolved by name up front (a missing
one is an error before any job runs) and re-typing is a ``select`` of casts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SELLOUT_SCHEMA = T.StructType([
    T.StructField("regionid", T.StringType()),
    T.StructField("product", T.StringType()),
    T.StructField("yearweek", T.StringType()),
    T.StructField("qty", T.DoubleType()),
])

# The reference's seasonal intermediate and index outputs (values kept as doubles).
SEASONAL_RATIO_SCHEMA = T.StructType([
    T.StructField("REGIONID", T.StringType()),
    T.StructField("PRODUCT", T.StringType()),
    T.StructField("YEARWEEK", T.StringType()),
    T.StructField("WEEK", T.StringType()),
    T.StructField("VOLUME", T.DoubleType()),
    T.StructField("MA", T.DoubleType()),
    T.StructField("RATIO", T.DoubleType()),
])

CLEANED_SELLOUT_SCHEMA = T.StructType([
    T.StructField("KEY", T.StringType()),
    T.StructField("REGIONID", T.StringType()),
    T.StructField("PRODUCT", T.StringType()),
    T.StructField("YEARWEEK", T.StringType()),
    T.StructField("VOLUME", T.DoubleType()),
    T.StructField("PRODUCTNAME", T.StringType()),
])


def column_index(df: DataFrame, name: str, case_insensitive: bool = False) -> int:
    """PRJ-14/15: ordinal of a column, -1 when absent (``indexOf``)."""
    cols = [c.lower() for c in df.columns] if case_insensitive else df.columns
    key = name.lower() if case_insensitive else name
    return cols.index(key) if key in cols else -1


def by_ordinal(df: DataFrame, *ordinals: int) -> DataFrame:
    """PRJ-14/15: project the columns at the given ordinals; -1, a name that is absent, is an
    error before any job runs."""
    absent = [i for i in ordinals if not 0 <= i < len(df.columns)]
    if absent:
        raise ValueError(f"no column at {absent}; have {df.columns}")
    return df.select(*[F.col(f"`{df.columns[i]}`") for i in ordinals])


def require_columns(df: DataFrame, *names: str, case_insensitive: bool = True) -> DataFrame:
    """Fail early when a required column is missing."""
    missing = [n for n in names if column_index(df, n, case_insensitive) < 0]
    if missing:
        raise ValueError(f"missing columns {missing}; have {df.columns}")
    return df


def lower_columns(df: DataFrame) -> DataFrame:
    """PRJ-15: lower-case every column name."""
    return df.toDF(*[c.lower() for c in df.columns])


def impose_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """PRJ-16: positional rename + cast to ``schema`` (column count must match)."""
    if len(df.columns) != len(schema.fields):
        raise ValueError(f"schema has {len(schema.fields)} fields, frame has {len(df.columns)}")
    return df.select(*[F.col(c).cast(f.dataType).alias(f.name)
                       for c, f in zip(df.columns, schema.fields)])


def positional(df: DataFrame, *cols: str) -> DataFrame:
    """PRJ-13: project columns to tuple-style names ``_1, _2, ...``."""
    return df.select(*[F.col(c).alias(f"_{i}") for i, c in enumerate(cols, start=1)])

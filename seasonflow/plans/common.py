"""Shared inputs of the catalogue queries (all derived by Spark from the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.cleaning import cap, drop_late_weeks
from ..operators.joins import materialize
from ..sources.tables import sellout, table
from . import params as P


def clean_sellout(spark: SparkSession, sf_dir: str, materialized: bool = False) -> DataFrame:
    """Sell-out with weeks <= 52 and quantities capped (the reference's ``mapRdd``).

    ``materialized`` checkpoints the (aggregated, hence small) sell-out first, for
    queries that read it more than once: the lineitem joins then run once.
    """
    base = sellout(spark, sf_dir)
    if materialized:
        base = materialize(base)
    return cap(drop_late_weeks(base), P.CAP)


PARAMETER_SCHEMA = "param_category string, param_name string, param_value string, use_yn string"


def parameter_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parameter table in the reference's shape, derived from ``part``.

    One ``VALID_PRODUCT`` row per part type (active for the two reference products,
    inactive otherwise) plus the ``VALID_WEEK`` / ``VALID_YEAR`` scalars.
    """
    products = (
        table(spark, sf_dir, "part", "p_type").distinct()
        .select(F.lit("COMMON").alias("param_category"),
                F.lit("VALID_PRODUCT").alias("param_name"),
                F.col("p_type").alias("param_value"),
                F.when(F.col("p_type").isin(list(P.PRODUCTS)), "Y").otherwise("N").alias("use_yn"))
    )
    scalars = spark.createDataFrame(
        [("COMMON", "VALID_WEEK", str(P.BAD_WEEK), "Y"),
         ("COMMON", "VALID_YEAR", str(P.MIN_YEAR), "Y")], PARAMETER_SCHEMA)
    return products.unionByName(scalars)

"""Loaders for the parquet tables and the derived weekly sell-out fact.

The reference reads a weekly sales fact ``(regionid, product, yearweek, qty)`` from a
database. Here it is derived from the star schema: region name x part type x ISO
yearweek of the order date, summing line quantities.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.yearweek import iso_yearweek, week_dates
from ..operators.joins import Size, fits, lookup_join, measure_once

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

SELLOUT_COLUMNS = ("regionid", "product", "yearweek", "qty")

# Declared schemas of the star-schema tables: reads skip footer-based inference and a
# file with a drifted schema fails instead of silently changing types.
SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, "
                "c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
            "p_retailprice double",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
              "o_orderdate timestamp_ntz, o_orderpriority string",
    "lineitem": "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz",
}


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one parquet table; ``columns`` prunes the scan's ReadSchema."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    reader = spark.read
    if name in SCHEMAS:
        reader = reader.schema(SCHEMAS[name])
    df = reader.parquet(os.path.join(sf_dir, f"{name}.parquet"))
    return df.select(*columns) if columns else df


def _small(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> Size | None:
    """Measured size of a base table's columns, once per session and state of its files."""
    path = os.path.join(sf_dir, f"{name}.parquet")
    return measure_once(table(spark, sf_dir, name, *columns), path, columns)


def customer_region(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """``c_custkey -> r_name`` and whether that is small enough to broadcast.

    Regions and nations are broadcast if each of them has been measured to fit, with the
    region's widest row added to every nation; likewise the result has a customer's row
    and a region's widest row at most for each customer.
    """
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    region = table(spark, sf_dir, "region", "r_regionkey", "r_name")
    nations = _small(spark, sf_dir, "nation", "n_nationkey", "n_regionkey")
    regions = _small(spark, sf_dir, "region", "r_regionkey", "r_name")
    customers = _small(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    geo = (lookup_join(nation, region, F.col("n_regionkey") == F.col("r_regionkey"), "inner",
                       fits(regions))
           .select(F.col("n_nationkey").alias("c_nationkey"), "r_name"))
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    joined = lookup_join(cust, geo, "c_nationkey", "inner", fits(_widened(nations, regions)))
    return joined.select("c_custkey", "r_name"), fits(_widened(customers, regions))


def _widened(size: Size | None, by: Size | None) -> Size | None:
    """Size of a table each of whose rows gets at most one row of the other."""
    if size is None or by is None:
        return None
    return Size(size.rows, size.bytes + size.rows * by.widest, size.widest + by.widest)


def _weekly_lines(spark: SparkSession, sf_dir: str, *line_columns: str,
                  weeks: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Line items tagged with (regionid, product, yearweek).

    ``weeks`` bounds the yearweeks (inclusive): the dates they imply are pushed to the
    scan of orders. Orders are reduced to ``orderkey -> (region, yearweek)`` first.
    A small part table is looked up before orders, so that a product filter cuts the
    line items before their shuffle; a large one is joined after it.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    first, end = week_dates(*weeks)
    if first is not None:
        orders = orders.filter(F.col("o_orderdate") >= F.lit(first).cast("timestamp_ntz"))
    if end is not None:
        orders = orders.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp_ntz"))
    customers, small = customer_region(spark, sf_dir)
    orders = (
        lookup_join(orders, customers.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey",
                    "inner", small)
        .select(F.col("o_orderkey").alias("l_orderkey"),
                F.col("r_name").alias("regionid"),
                iso_yearweek("o_orderdate").alias("yearweek"))
    )
    items = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", *line_columns)
    parts = table(spark, sf_dir, "part", "p_partkey", "p_type").select(
        F.col("p_partkey").alias("l_partkey"), F.col("p_type").alias("product"))
    if fits(_small(spark, sf_dir, "part", "p_partkey", "p_type")):
        lines = lookup_join(items, parts, "l_partkey", "inner", True).join(orders, "l_orderkey")
    else:
        lines = items.join(orders, "l_orderkey").join(parts, "l_partkey")
    low, high = weeks
    if low is not None:
        lines = lines.filter(F.col("yearweek") >= low)
    if high is not None:
        lines = lines.filter(F.col("yearweek") <= high)
    return lines


def sellout(spark: SparkSession, sf_dir: str,
            weeks: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Weekly sell-out: one row per (regionid, product, yearweek), ``qty`` a double,
    for the yearweeks within ``weeks``.

    The aggregation is partial (map-side) before its shuffle, so a hot
    (region, product, week) group is pre-summed in every task.
    """
    return (_weekly_lines(spark, sf_dir, "l_quantity", weeks=weeks)
            .groupBy("regionid", "product", "yearweek")
            .agg(F.sum("l_quantity").alias("qty")))


def weekly_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw rows behind the sell-out, one per line item: (regionid, product, yearweek,
    qty) with repeated weeks."""
    return _weekly_lines(spark, sf_dir, "l_quantity").select(
        "regionid", "product", "yearweek", F.col("l_quantity").alias("qty"))


def weekly_features(spark: SparkSession, sf_dir: str,
                    weeks: tuple[str | None, str | None] = (None, None)) -> DataFrame:
    """Sell-out plus ``pro_percent`` (mean line discount), the forecast input's shape.

    Discounts are whole percents; the mean is taken over integer cents (an exact sum
    in any order) and divided once, so the value does not depend on summation order.
    """
    cents = F.round(F.col("l_discount") * 100).cast("bigint")
    return (_weekly_lines(spark, sf_dir, "l_quantity", "l_discount", weeks=weeks)
            .groupBy("regionid", "product", "yearweek")
            .agg(F.sum("l_quantity").alias("qty"),
                 (F.sum(cents) / F.count(cents) / 100.0).alias("pro_percent")))


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product master ``(product_id, product_name)`` derived from ``part``: one row per part
    type; the name is the type in title case."""
    return (
        table(spark, sf_dir, "part", "p_type")
        .select(F.col("p_type").alias("product_id"))
        .distinct()
        .select("product_id", F.initcap("product_id").alias("product_name"))
    )


def region_master(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """Region master ``(regionid, regionkey)`` and whether it is small enough to broadcast."""
    master = table(spark, sf_dir, "region", "r_regionkey", "r_name").select(
        F.col("r_name").alias("regionid"), F.col("r_regionkey").cast("bigint").alias("regionkey"))
    return master, fits(_small(spark, sf_dir, "region", "r_regionkey", "r_name"))


def part_names(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """Part master ``(p_partkey, p_name)`` and whether it is small enough to broadcast."""
    return (table(spark, sf_dir, "part", "p_partkey", "p_name"),
            fits(_small(spark, sf_dir, "part", "p_partkey", "p_name")))

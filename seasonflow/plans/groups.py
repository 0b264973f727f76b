"""Catalogue: group statistics, flat / stretched / nested (AGG-1..9, AGG-12/13, WIN-1..3)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rounding import report
from ..operators import cleaning as C
from ..operators import groupstats as G
from ..operators.seasonality import series
from ..functions.yearweek import yearweek_int
from ..sources.tables import sellout, weekly_lines
from . import params as P
from .common import clean_sellout, parameter_table
from .registry import PARAMS_SQL, query, with_lines, with_sellout

KEYS = ["regionid", "product"]
_KEY_SQL = "regionid || '_' || product"
_DISP_SQL = "sqrt(var_pop(qty) * count(qty) / nullif(avg(qty), 0))"


def _keyed(spark, sf_dir, materialized=False):
    return clean_sellout(spark, sf_dir, materialized)


@query("agg_count", oracle=with_sellout("SELECT count(*) AS n FROM clean", clean=True))
def agg_count(spark, sf_dir):
    """AGG-1: row count of the cleaned fact."""
    return _keyed(spark, sf_dir).agg(F.count(F.lit(1)).alias("n"))


@query("agg_group_count", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, count(*) AS size FROM clean GROUP BY regionid, product
""", clean=True))
def agg_group_count(spark, sf_dir):
    """AGG-2: rows per key."""
    g = G.group_stats(_keyed(spark, sf_dir), KEYS, stats=("size",))
    return g.select(G.key_column().alias("keycol"), "size")


@query("agg_group_mean", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, count(*) AS size, sum(qty) AS total, round(avg(qty), 6) AS average
FROM clean GROUP BY regionid, product
""", clean=True))
def agg_group_mean(spark, sf_dir):
    """AGG-3: size, sum and mean per key."""
    g = G.group_stats(_keyed(spark, sf_dir), KEYS, stats=("size", "total", "average"))
    return g.select(G.key_column().alias("keycol"), "size", "total", report("average").alias("average"))


@query("agg_group_stats", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, count(*) AS size, round(avg(qty), 6) AS average,
       round(stddev_samp(qty), 6) AS stddev
FROM clean GROUP BY regionid, product
""", clean=True))
def agg_group_stats(spark, sf_dir):
    """AGG-4/5: (size, mean, sample stddev) per key."""
    g = G.group_stats(_keyed(spark, sf_dir), KEYS, stats=("size", "average", "stddev"))
    return g.select(G.key_column().alias("keycol"), "size", report("average").alias("average"),
                    report("stddev").alias("stddev"))


@query("agg_group_stats_region", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, count(*) AS size, round(avg(qty), 6) AS average,
       round(stddev_samp(qty), 6) AS stddev
FROM clean WHERE 1 = 1 AND regionid = 'AFRICA' AND product IN ('PROMO', 'SMALL')
GROUP BY regionid, product
""", clean=True))
def agg_group_stats_region(spark, sf_dir):
    """AGG-4 on the quiz job's slice: one region, the two analysed products (FLT-8, FLT-4)."""
    c = C.in_set(_keyed(spark, sf_dir).filter(F.col("regionid") == P.REGION), P.PRODUCTS)
    g = G.group_stats(c, KEYS, stats=("size", "average", "stddev"))
    return g.select(G.key_column().alias("keycol"), "size", report("average").alias("average"),
                    report("stddev").alias("stddev"))


@query("agg_group_dispersion", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, count(*) AS size, round(avg(qty), 6) AS average,
       round({_DISP_SQL}, 6) AS dispersion
FROM clean GROUP BY regionid, product
""", clean=True))
def agg_group_dispersion(spark, sf_dir):
    """AGG-6: the reference's dispersion ``sqrt(sum((x-mean)^2)/mean)`` per key."""
    g = G.group_stats(_keyed(spark, sf_dir), KEYS, stats=("size", "average", "dispersion"))
    return g.select(G.key_column().alias("keycol"), "size", report("average").alias("average"),
                    report("dispersion").alias("dispersion"))


@query("agg_distinct", oracle=with_sellout("SELECT DISTINCT product FROM sellout"))
def agg_distinct(spark, sf_dir):
    """AGG-13: distinct products."""
    return sellout(spark, sf_dir).select("product").distinct()


@query("win_group_mean", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, regionid AS accountid, product, yearweek, qty,
       round(avg(qty) OVER (PARTITION BY regionid, product), 6) AS average
FROM clean
""", clean=True))
def win_group_mean(spark, sf_dir):
    """WIN-1: every row with its key's mean."""
    s = G.stretch_stats(_keyed(spark, sf_dir, True), KEYS, stats=("average",))
    return s.select(G.key_column().alias("keycol"), F.col("regionid").alias("accountid"),
                    "product", "yearweek", "qty", report("average").alias("average"))


@query("win_group_dispersion", oracle=with_sellout(f"""
WITH g AS (SELECT regionid, product, count(*) AS size, avg(qty) AS average,
                  {_DISP_SQL} AS dispersion FROM clean GROUP BY ALL)
SELECT clean.regionid || '_' || clean.product AS keycol, yearweek, qty, size, round(average, 6) AS average,
       round(dispersion, 6) AS dispersion
FROM clean JOIN g ON clean.regionid IS NOT DISTINCT FROM g.regionid
                  AND clean.product IS NOT DISTINCT FROM g.product
""", clean=True))
def win_group_dispersion(spark, sf_dir):
    """WIN-2: every row with its key's size, mean and dispersion."""
    s = G.stretch_stats(_keyed(spark, sf_dir, True), KEYS, stats=("size", "average", "dispersion"))
    return s.select(G.key_column().alias("keycol"), "yearweek", "qty", "size",
                    report("average").alias("average"), report("dispersion").alias("dispersion"))


@query("win_ratio_to_mean", oracle=with_sellout(f"""
WITH g AS (SELECT regionid, product, count(*) AS size, avg(qty) AS average,
                  stddev_samp(qty) AS stddev FROM clean GROUP BY ALL)
SELECT clean.regionid || '_' || clean.product AS keycol, yearweek, qty, size, round(average, 6) AS average,
       round(stddev, 6) AS stddev, round(qty / nullif(average, 0), 6) AS ratio
FROM clean JOIN g ON clean.regionid IS NOT DISTINCT FROM g.regionid
                  AND clean.product IS NOT DISTINCT FROM g.product
""", clean=True))
def win_ratio_to_mean(spark, sf_dir):
    """WIN-3: every row with size, mean, sample stddev and its ratio to the mean."""
    s = G.ratio_to_mean(_keyed(spark, sf_dir, True), KEYS)
    return s.select(G.key_column().alias("keycol"), "yearweek", "qty", "size",
                    report("average").alias("average"), report("stddev").alias("stddev"),
                    report("ratio").alias("ratio"))


def _nested_sql(cols: str, stats: str) -> str:
    return with_sellout(f"""
WITH s AS (SELECT regionid, product, yearweek, sum(qty) AS qty FROM clean GROUP BY ALL),
g AS (SELECT regionid, product, {stats} FROM s GROUP BY ALL)
SELECT {_KEY_SQL} AS keycol,
       row_number() OVER (PARTITION BY regionid, product ORDER BY CAST(yearweek AS INTEGER)) - 1 AS pos,
       {cols}
FROM s JOIN g USING (regionid, product)
""", clean=True)


@query("agg_nested_mean", oracle=_nested_sql(
    "yearweek, qty, round(average, 6) AS average", "avg(qty) AS average"))
def agg_nested_mean(spark, sf_dir):
    """AGG-7: per key, all records nested with the key's mean (flattened for checking)."""
    s = series(_keyed(spark, sf_dir), KEYS)
    n = G.nested(s, KEYS, ["yearweek", "qty"], stats=("average",))
    n = n.withColumn("records", F.transform(
        "records", lambda r: F.struct(r["yearweek"].alias("yearweek"), r["qty"].alias("qty"),
                                      report(F.col("average")).alias("average"))))
    return G.flatten(n.select(G.key_column().alias("keycol"), "records"), ["keycol"])


@query("agg_nested_stats", oracle=_nested_sql(
    "yearweek, size, round(average, 6) AS average, round(stddev, 6) AS stddev",
    "count(*) AS size, avg(qty) AS average, stddev_samp(qty) AS stddev"))
def agg_nested_stats(spark, sf_dir):
    """AGG-8: per key, a list with (size, mean, stddev) repeated for every record."""
    s = series(_keyed(spark, sf_dir), KEYS)
    n = G.nested(s, KEYS, ["yearweek"], stats=("size", "average", "stddev"), record_stats=True)
    f = G.flatten(n.select(G.key_column().alias("keycol"), "records"), ["keycol"])
    return f.select("keycol", "pos", "yearweek", "size", report("average").alias("average"),
                    report("stddev").alias("stddev"))


@query("agg_nested_dispersion", oracle=_nested_sql(
    "yearweek, size, round(average, 6) AS average, round(dispersion, 6) AS dispersion",
    f"count(*) AS size, avg(qty) AS average, {_DISP_SQL} AS dispersion"))
def agg_nested_dispersion(spark, sf_dir):
    """AGG-9: as AGG-8 with the reference's dispersion."""
    s = series(_keyed(spark, sf_dir), KEYS)
    n = G.nested(s, KEYS, ["yearweek"], stats=("size", "average", "dispersion"), record_stats=True)
    f = G.flatten(n.select(G.key_column().alias("keycol"), "records"), ["keycol"])
    return f.select("keycol", "pos", "yearweek", "size", report("average").alias("average"),
                    report("dispersion").alias("dispersion"))


@query("agg_nested_chunks", oracle=with_lines(f"""
, g AS (SELECT regionid, product, count(*) AS size, avg(qty) AS average,
               stddev_samp(qty) AS stddev, {_DISP_SQL} AS dispersion FROM lines GROUP BY ALL),
r AS (SELECT *, row_number() OVER (PARTITION BY regionid, product
        ORDER BY CAST(yearweek AS INTEGER), yearweek, qty) - 1 AS idx FROM lines)
SELECT {_KEY_SQL} AS keycol, idx // {P.CHUNK_ROWS} AS chunk, idx % {P.CHUNK_ROWS} AS pos, yearweek, qty,
       size, round(average, 6) AS average, round(stddev, 6) AS stddev, round(dispersion, 6) AS dispersion
FROM r JOIN g USING (regionid, product)
"""))
def agg_nested_chunks(spark, sf_dir):
    """AGG-7/8/9 on the raw rows: a key's records in lists of bounded length (flattened for
    checking)."""
    stats = ("size", "average", "stddev", "dispersion")
    n = G.nested_chunks(weekly_lines(spark, sf_dir), KEYS, ["yearweek", "qty"],
                        [yearweek_int("yearweek"), "yearweek", "qty"], P.CHUNK_ROWS, stats)
    rows = n.select(G.key_column().alias("keycol"), "chunk", "records", "size",
                    *[report(s).alias(s) for s in stats[1:]])
    return G.flatten(rows, ["keycol", "chunk", *stats])


_FOLD_SQL = f"""
SELECT {_KEY_SQL} AS keycol, sum(v) AS total, count(*) AS factors,
       count(*) FILTER (WHERE v = 0) AS zeros, count(*) FILTER (WHERE v < 0) AS negatives,
       round(sum(CASE WHEN v <> 0 THEN ln(abs(v)) ELSE 0 END), 6) AS ln_magnitude,
       CASE WHEN bool_or(v = 0) THEN 0 WHEN count(*) FILTER (WHERE v < 0) % 2 = 1 THEN -1 ELSE 1 END AS sign,
       round(CASE WHEN count(*) FILTER (WHERE v = 0) = (CASE WHEN first = 0 THEN 1 ELSE 0 END) AND first <> 0
                  THEN 2 * ln(abs(first)) - sum(CASE WHEN v <> 0 THEN ln(abs(v)) ELSE 0 END) END, 6) AS ln_ratio
FROM (SELECT *, qty - {P.FOLD_BASE} AS v, first_value(qty - {P.FOLD_BASE}) OVER (
        PARTITION BY regionid, product ORDER BY CAST(yearweek AS INTEGER), yearweek, qty) AS first FROM sellout)
GROUP BY regionid, product, first
"""


@query("agg_fold", oracle=with_sellout(_FOLD_SQL))
def agg_fold(spark, sf_dir):
    """AGG-14: sum, product and ratio of every group's quantities, less a base so that there
    are zeros and negative factors."""
    rows = sellout(spark, sf_dir).withColumn("v", F.col("qty") - P.FOLD_BASE)
    folded = G.fold_groups(rows, KEYS, "v", [yearweek_int("yearweek"), "yearweek"])
    return folded.select(
        G.key_column().alias("keycol"), F.col("folded_sum").alias("total"), "factors", "zeros", "negatives",
        report("ln_magnitude").alias("ln_magnitude"),
        F.when(F.col("zeros") > 0, 0).when(F.col("negatives") % 2 == 1, -1).otherwise(1).alias("sign"),
        report("ln_ratio").alias("ln_ratio"))


@query("agg_param_lists", oracle=f"""
WITH params AS ({PARAMS_SQL})
, r AS (
SELECT *, (row_number() OVER (PARTITION BY param_category, param_name ORDER BY param_value) - 1)
          // {P.CHUNK_ROWS} AS chunk FROM params WHERE use_yn = 'Y')
SELECT param_category, param_name, chunk, count(*) AS n_values,
       string_agg(param_value, ',' ORDER BY param_value) AS param_values
FROM r GROUP BY 1, 2, 3
""")
def agg_param_lists(spark, sf_dir):
    """AGG-12: active parameter values collected per (category, name), sorted, in lists of
    bounded length."""
    p = parameter_table(spark, sf_dir).filter(F.col("use_yn") == "Y")
    n = G.nested_chunks(p, ["param_category", "param_name"], ["param_value"], ["param_value"],
                        P.CHUNK_ROWS)
    return n.select("param_category", "param_name", "chunk",
                    F.size("records").cast("bigint").alias("n_values"),
                    F.array_join("records.param_value", ",").alias("param_values"))


@query("agg_param_lookup", oracle=f"""
WITH params AS ({PARAMS_SQL})
SELECT CAST(max(CASE WHEN param_name = 'VALID_WEEK' THEN param_value END) AS INTEGER) AS valid_week,
       CAST(max(CASE WHEN param_name = 'VALID_YEAR' THEN param_value END) AS INTEGER) AS valid_year,
       CAST(NULL AS INTEGER) AS missing, 2 AS n_values
FROM params WHERE use_yn = 'Y'
""")
def agg_param_lookup(spark, sf_dir):
    """AGG-12: scalar parameters as a one-row map, read by name."""
    found = C.parameter_lookup(parameter_table(spark, sf_dir), ("VALID_WEEK", "VALID_YEAR", "OTHER"))
    value = lambda name, out: F.try_element_at("values", F.lit(name)).alias(out)
    return found.select(value("VALID_WEEK", "valid_week"), value("VALID_YEAR", "valid_year"),
                        value("OTHER", "missing"), F.size("values").alias("n_values"))

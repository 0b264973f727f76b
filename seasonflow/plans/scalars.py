"""Catalogue: scalar, rounding, share and array functions (FN-*, AGG-14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import arrays as A
from ..functions.rounding import report, round_half_up
from ..functions.yearweek import week_of, week_text, year_of, yearweek_int
from ..operators.groupstats import key_column
from ..operators.joins import materialize
from ..operators.reshape import shares_with_residual
from ..operators.seasonality import series
from ..sources.tables import sellout
from . import params as P
from .common import clean_sellout
from .registry import query, with_sellout

KEYS = ["regionid", "product"]
_KEY_SQL = "regionid || '_' || product"
_RN = "row_number() OVER (PARTITION BY regionid, product ORDER BY CAST(yearweek AS INTEGER))"


def _lists(spark, sf_dir, value=None):
    """Per key: the cleaned weekly quantities as an array ordered by yearweek."""
    s = series(clean_sellout(spark, sf_dir), KEYS)
    v = F.col("qty") if value is None else value
    return s.groupBy(*KEYS).agg(A.ordered_list(v, yearweek_int("yearweek")).alias("arr")).select(
        key_column().alias("keycol"), "arr")


def _weeks(spark, sf_dir):
    """Per key: its yearweeks in order, a list bounded by the calendar."""
    return series(clean_sellout(spark, sf_dir), KEYS).groupBy(*KEYS).agg(
        A.ordered_list("yearweek", yearweek_int("yearweek")).alias("weeks")).select(
        key_column().alias("keycol"), "weeks")


# --- scalars -----------------------------------------------------------------------

@query("fn_yearweek_parts", oracle=with_sellout("""
SELECT regionid, product, yearweek,
       TRY_CAST(substring(yearweek, 1, 4) AS INTEGER) AS year,
       TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) AS week,
       substring(yearweek, 5, 2) AS week_text
FROM sellout
"""))
def fn_yearweek_parts(spark, sf_dir):
    """FN-2/3/4: year and week parsed from ``YYYYWW``."""
    return sellout(spark, sf_dir).select(
        "regionid", "product", "yearweek", year_of("yearweek").alias("year"),
        week_of("yearweek").alias("week"), week_text("yearweek").alias("week_text"))


@query("fn_key_split", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, split_part({_KEY_SQL}, '_', 1) AS region_part,
       split_part({_KEY_SQL}, '_', 2) AS product_part, yearweek
FROM sellout
"""))
def fn_key_split(spark, sf_dir):
    """FN-1/6: composite key built with concat and split back on ``_``."""
    k = key_column()
    parts = F.split(k, "_")
    return sellout(spark, sf_dir).select(
        k.alias("keycol"), parts.getItem(0).alias("region_part"),
        parts.getItem(1).alias("product_part"), "yearweek")


@query("fn_case", oracle=with_sellout("""
SELECT regionid, product, lower(product) AS product_lower, upper(lower(product)) AS product_upper,
       lower(regionid) = lower(upper(regionid)) AS same_ignoring_case
FROM sellout
"""))
def fn_case(spark, sf_dir):
    """FN-7/8: lower / upper case and case-insensitive equality."""
    return sellout(spark, sf_dir).select(
        "regionid", "product", F.lower("product").alias("product_lower"),
        F.upper(F.lower("product")).alias("product_upper"),
        (F.lower("regionid") == F.lower(F.upper("regionid"))).alias("same_ignoring_case"))


@query("fn_round_half_up", oracle=with_sellout("""
SELECT regionid, product, yearweek, (qty - 150) / 4 AS x,
       floor(((qty - 150) / 4) * 10.0 + 0.5) / 10.0 AS half_up
FROM sellout
"""))
def fn_round_half_up(spark, sf_dir):
    """FN-10 / UDF-1: round half toward +inf to one digit (-0.25 -> -0.2)."""
    x = (F.col("qty") - 150) / 4
    return sellout(spark, sf_dir).select("regionid", "product", "yearweek", x.alias("x"),
                                         round_half_up(x, 1).alias("half_up"))


@query("fn_math", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, sum(qty) AS total, sum(pow(qty, 2)) AS sum_sq,
       round(sqrt(sum(qty)), 6) AS root_total, CAST(floor(avg(qty)) AS BIGINT) AS floor_mean
FROM clean GROUP BY regionid, product
""", clean=True))
def fn_math(spark, sf_dir):
    """FN-11: power, square root, floor and sum."""
    c = clean_sellout(spark, sf_dir)
    return c.groupBy(*KEYS).agg(
        F.sum("qty").alias("total"), F.sum(F.pow("qty", 2)).alias("sum_sq"),
        F.avg("qty").alias("_mean")).select(
        key_column().alias("keycol"), "total", "sum_sq",
        report(F.sqrt("total")).alias("root_total"), F.floor("_mean").cast("bigint").alias("floor_mean"))


@query("fn_share_residual", oracle=with_sellout("""
WITH t AS (SELECT regionid, product, sum(qty) AS qty FROM sellout GROUP BY ALL),
s AS (SELECT *, floor((100.0 * qty / sum(qty) OVER (PARTITION BY regionid)) * 100.0 + 0.5) / 100.0 AS share FROM t),
f AS (SELECT regionid, floor((100.0 - sum(share)) * 100.0 + 0.5) / 100.0 AS residual,
             min(product) AS first_item FROM s GROUP BY regionid)
SELECT s.regionid, s.product, s.qty,
       round(CASE WHEN s.product = f.first_item THEN s.share + f.residual ELSE s.share END, 6) AS share
FROM s JOIN f ON s.regionid IS NOT DISTINCT FROM f.regionid
"""))
def fn_share_residual(spark, sf_dir):
    """FN-12: product shares of each region's volume, summing to exactly 100."""
    t = materialize(sellout(spark, sf_dir).groupBy(*KEYS).agg(F.sum("qty").alias("qty")))
    s = shares_with_residual(t, "regionid", "product", "qty")
    return s.select("regionid", "product", "qty", report("share").alias("share"))


# --- arrays ------------------------------------------------------------------------

_SERIES_SQL = "WITH s AS (SELECT regionid, product, yearweek, sum(qty) AS qty FROM clean GROUP BY ALL)\n"


@query("arr_filter", oracle=with_sellout(_SERIES_SQL + f"""
, l AS (SELECT {_KEY_SQL} AS keycol,
               list(CAST(qty AS BIGINT) ORDER BY CAST(yearweek AS INTEGER)) AS arr
        FROM s GROUP BY regionid, product)
SELECT keycol, CAST(len(list_filter(arr, lambda x: right(CAST(x AS VARCHAR), 1) = '0')) AS BIGINT) AS n_kept,
       array_to_string(list_filter(arr, lambda x: right(CAST(x AS VARCHAR), 1) = '0'), ',') AS kept
FROM l
""", clean=True))
def arr_filter(spark, sf_dir):
    """FN-13/8/5: keep quantities whose last digit is 0."""
    lists = _lists(spark, sf_dir, F.col("qty").cast("bigint"))
    kept = A.keep_last_digit_zero("arr")
    return lists.select("keycol", F.size(kept).cast("bigint").alias("n_kept"),
                        F.array_join(kept, ",").alias("kept"))


@query("arr_transform", oracle=with_sellout(_SERIES_SQL + f"""
SELECT {_KEY_SQL} AS keycol, {_RN} - 1 AS pos, round(qty - qty * 0.2, 6) AS price
FROM s
""", clean=True))
def arr_transform(spark, sf_dir):
    """FN-14: 20 % discount applied to every element, exploded with positions."""
    lists = _lists(spark, sf_dir).select("keycol", A.discounted("arr", P.DISCOUNT).alias("arr"))
    return lists.select("keycol", F.posexplode("arr").alias("pos", "price")).select(
        "keycol", F.col("pos").cast("bigint").alias("pos"), report("price").alias("price"))


@query("arr_fold_concat", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, string_agg(yearweek, '' ORDER BY CAST(yearweek AS INTEGER)) AS names
FROM (SELECT DISTINCT regionid, product, yearweek FROM clean) GROUP BY regionid, product
""", clean=True))
def arr_fold_concat(spark, sf_dir):
    """FN-15: the yearweeks of a key folded into one string."""
    return _weeks(spark, sf_dir).select("keycol", A.fold_concat("weeks").alias("names"))


@query("arr_reduce", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, sum(qty) AS total, max(qty) AS peak
FROM (SELECT regionid, product, yearweek, sum(qty) AS qty FROM clean GROUP BY ALL)
GROUP BY regionid, product
""", clean=True))
def arr_reduce(spark, sf_dir):
    """FN-16 / AGG-14: reduce with + and with max."""
    return _lists(spark, sf_dir).select("keycol", A.reduce_sum("arr").alias("total"),
                                        A.reduce_max("arr").alias("peak"))


@query("arr_explode", oracle=with_sellout(_SERIES_SQL + f"""
SELECT {_KEY_SQL} AS keycol, {_RN} - 1 AS pos, qty,
       count(*) OVER (PARTITION BY regionid, product) AS n
FROM s
""", clean=True))
def arr_explode(spark, sf_dir):
    """FN-17: size, element positions and iteration (``posexplode``)."""
    lists = _lists(spark, sf_dir)
    return lists.select("keycol", F.size("arr").cast("bigint").alias("n"),
                        F.posexplode("arr").alias("pos", "qty")).select(
        "keycol", F.col("pos").cast("bigint").alias("pos"), "qty", "n")


@query("arr_concat_reverse_zip", oracle=with_sellout(_SERIES_SQL + f"""
SELECT {_KEY_SQL} AS keycol, {_RN} - 1 AS pos, yearweek, qty,
       round(avg(qty) OVER (PARTITION BY regionid, product ORDER BY CAST(yearweek AS INTEGER)
                            ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING), 6) AS ma
FROM s
""", clean=True))
def arr_concat_reverse_zip(spark, sf_dir):
    """FN-18: ``pre ++ inner ++ post.reverse`` over whole series, zipped with their rows."""
    s = series(clean_sellout(spark, sf_dir), KEYS)
    by_week = yearweek_int("yearweek")
    lists = s.groupBy(*KEYS).agg(A.ordered_list("yearweek", by_week).alias("yearweek"),
                                 A.ordered_list("qty", by_week).alias("qty"))
    rows = A.zipped(yearweek="yearweek", qty="qty", ma=A.edged_means("qty", P.ORDER // 2))
    return lists.select(key_column().alias("keycol"), F.posexplode(rows).alias("pos", "r")).select(
        "keycol", F.col("pos").cast("bigint").alias("pos"), "r.yearweek", "r.qty",
        report(F.col("r.ma")).alias("ma"))


@query("arr_contains", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, count(DISTINCT yearweek) AS n_weeks,
       bool_or(yearweek = '{P.YEARWEEK_FROM}') AS has_week
FROM clean GROUP BY regionid, product
""", clean=True))
def arr_contains(spark, sf_dir):
    """FN-19: array to set and membership test."""
    return _weeks(spark, sf_dir).select(
        "keycol", F.size(F.array_distinct("weeks")).cast("bigint").alias("n_weeks"),
        A.as_set_contains("weeks", F.lit(P.YEARWEEK_FROM)).alias("has_week"))


@query("arr_join_split", oracle=with_sellout(f"""
SELECT {_KEY_SQL} AS keycol, string_agg(yearweek, ',' ORDER BY CAST(yearweek AS INTEGER)) AS joined,
       count(*) AS n_parts
FROM (SELECT DISTINCT regionid, product, yearweek FROM clean) GROUP BY regionid, product
""", clean=True))
def arr_join_split(spark, sf_dir):
    """FN-20: join a list with a delimiter and split it back."""
    return _weeks(spark, sf_dir).select(
        "keycol", F.array_join("weeks", ",").alias("joined"),
        F.size(A.join_split("weeks", ",")).cast("bigint").alias("n_parts"))

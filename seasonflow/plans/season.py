"""Catalogue: seasonality job (WIN-4..10, AGG-10/11)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rounding import report
from ..functions.yearweek import week_text
from ..operators import seasonality as S
from ..sources.tables import sellout, weekly_lines
from . import params as P
from .common import clean_sellout
from .registry import query, with_lines, with_sellout

_ORDER_BY = "ORDER BY CAST(yearweek AS INTEGER), yearweek, qty"
_W = f"PARTITION BY regionid, product {_ORDER_BY}"


def _ratio_rows(spark, sf_dir):
    return S.seasonal_rows(sellout(spark, sf_dir), order=P.ORDER, cap_value=P.CAP)


_RATIO_SQL = f"""
WITH s AS (SELECT regionid, product, yearweek, sum(qty) AS qty FROM clean GROUP BY ALL),
m AS (SELECT *, avg(qty) OVER ({_W} ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS ma FROM s),
r AS (SELECT *, CASE WHEN ma <> 0 THEN qty / ma ELSE 1.0 END AS ratio FROM m)
"""


@query("seasonality_index", oracle=with_sellout(_RATIO_SQL + """
SELECT regionid AS REGIONID, product AS PRODUCT, substring(yearweek, 5, 2) AS WEEK,
       round(avg(qty), 6) AS AVG_VOLUME, round(avg(ma), 6) AS AVG_MA,
       round(avg(ratio), 6) AS AVG_RATIO
FROM r GROUP BY 1, 2, 3
""", clean=True))
def seasonality_index(spark, sf_dir):
    """Flagship: week-of-year seasonality index per (region, product)."""
    idx = S.seasonality_index(_ratio_rows(spark, sf_dir))
    return idx.select(
        F.col("regionid").alias("REGIONID"), F.col("product").alias("PRODUCT"),
        F.col("week").alias("WEEK"), report("avg_volume").alias("AVG_VOLUME"),
        report("avg_ma").alias("AVG_MA"), report("avg_ratio").alias("AVG_RATIO"))


_RATIO_PRODUCTS_SQL = _RATIO_SQL.replace("FROM clean GROUP BY ALL",
                                         "FROM clean WHERE product IN ('PROMO', 'SMALL') GROUP BY ALL")


@query("seasonality_index_products", oracle=with_sellout(_RATIO_PRODUCTS_SQL + """
SELECT regionid AS REGIONID, product AS PRODUCT, substring(yearweek, 5, 2) AS WEEK,
       round(avg(qty), 6) AS AVG_VOLUME, round(avg(ma), 6) AS AVG_MA,
       round(avg(ratio), 6) AS AVG_RATIO
FROM r GROUP BY 1, 2, 3
""", clean=True))
def seasonality_index_products(spark, sf_dir):
    """The flagship job exactly as the reference runs it: only the two analysed products."""
    rows = S.seasonal_rows(sellout(spark, sf_dir), order=P.ORDER, cap_value=P.CAP, products=P.PRODUCTS)
    idx = S.seasonality_index(rows)
    return idx.select(
        F.col("regionid").alias("REGIONID"), F.col("product").alias("PRODUCT"),
        F.col("week").alias("WEEK"), report("avg_volume").alias("AVG_VOLUME"),
        report("avg_ma").alias("AVG_MA"), report("avg_ratio").alias("AVG_RATIO"))


@query("seasonal_ma", oracle=with_sellout(_RATIO_SQL + """
SELECT regionid, product, yearweek, qty, round(ma, 6) AS ma FROM r
""", clean=True))
def seasonal_ma(spark, sf_dir):
    """Order-17 centred moving average with truncated edges (WIN-5/7, AGG-11)."""
    return _ratio_rows(spark, sf_dir).select(
        "regionid", "product", "yearweek", "qty", report("ma").alias("ma"))


@query("seasonal_ratio", oracle=with_sellout(_RATIO_SQL + """
SELECT regionid AS REGIONID, product AS PRODUCT, yearweek AS YEARWEEK,
       substring(yearweek, 5, 2) AS WEEK, qty AS VOLUME, round(ma, 6) AS MA,
       round(ratio, 6) AS RATIO
FROM r
""", clean=True))
def seasonal_ratio(spark, sf_dir):
    """The reference's intermediate table (WIN-8/10, PRJ-16) with double values."""
    r = _ratio_rows(spark, sf_dir)
    return r.select(
        F.col("regionid").alias("REGIONID"), F.col("product").alias("PRODUCT"),
        F.col("yearweek").alias("YEARWEEK"), week_text("yearweek").alias("WEEK"),
        F.col("qty").alias("VOLUME"), report("ma").alias("MA"), report("ratio").alias("RATIO"))


@query("win_ma_odd", oracle=with_sellout(f"""
SELECT regionid, product, yearweek, qty,
       round(avg(qty) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING), 6) AS ma
FROM sellout
"""))
def win_ma_odd(spark, sf_dir):
    """Odd-order (5) centred moving average on the raw sell-out (WIN-5/7)."""
    df = S.moving_average(sellout(spark, sf_dir), order=P.ODD_ORDER)
    return df.select("regionid", "product", "yearweek", "qty", report("ma").alias("ma"))


@query("win_ma_even", oracle=with_sellout(f"""
WITH w AS (
  SELECT regionid, product, yearweek, qty,
         row_number() OVER ({_W}) - 1 AS pos,
         count(*) OVER (PARTITION BY regionid, product) AS n,
         avg(qty) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS full_ma,
         avg(qty) OVER ({_W} ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS lo_ma,
         avg(qty) OVER ({_W} ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS hi_ma
  FROM sellout)
SELECT regionid, product, yearweek, qty,
       round(CASE WHEN pos >= 2 AND pos <= n - 3 THEN (lo_ma + hi_ma) / 2.0 ELSE full_ma END, 6) AS ma
FROM w
"""))
def win_ma_even(spark, sf_dir):
    """Even-order (4) 2x4 centred moving average (WIN-6/7)."""
    df = S.moving_average(sellout(spark, sf_dir), order=P.EVEN_ORDER)
    return df.select("regionid", "product", "yearweek", "qty", report("ma").alias("ma"))


@query("win_row_index", oracle=with_sellout(f"""
SELECT regionid, product, yearweek, qty,
       CAST(row_number() OVER ({_W}) - 1 AS BIGINT) AS idx
FROM clean
""", clean=True))
def win_row_index(spark, sf_dir):
    """Row index inside each (region, product) series ordered by yearweek (WIN-4, SRT-2)."""
    return clean_sellout(spark, sf_dir).select(
        "regionid", "product", "yearweek", "qty", S.row_index().alias("idx"))


@query("win_ma_blocked", oracle=with_lines(f"""
SELECT regionid, product, yearweek, qty, row_number() OVER w - 1 AS idx,
       round(avg(qty) OVER (w ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING), 6) AS ma,
       round(qty / avg(qty) OVER (w ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING), 6) AS ratio
FROM lines WINDOW w AS ({_W})
"""))
def win_ma_blocked(spark, sf_dir):
    """WIN-4/5/7/8 on the raw rows: series of any length in blocks with halos."""
    rows = S.moving_average_blocked(weekly_lines(spark, sf_dir), order=P.ORDER)
    return S.seasonal_ratio(rows).select("regionid", "product", "yearweek", "qty", "idx",
                                         report("ma").alias("ma"), report("ratio").alias("ratio"))


@query("win_ma_blocked_even", oracle=with_lines(f"""
, w AS (
  SELECT regionid, product, yearweek, qty, row_number() OVER w - 1 AS idx,
         count(*) OVER (PARTITION BY regionid, product) AS n,
         avg(qty) OVER (w ROWS BETWEEN 2 PRECEDING AND 2 FOLLOWING) AS full_ma,
         avg(qty) OVER (w ROWS BETWEEN 2 PRECEDING AND 1 FOLLOWING) AS lo_ma,
         avg(qty) OVER (w ROWS BETWEEN 1 PRECEDING AND 2 FOLLOWING) AS hi_ma
  FROM lines WINDOW w AS ({_W}))
SELECT regionid, product, yearweek, qty, idx,
       round(CASE WHEN idx >= 2 AND idx <= n - 3 THEN (lo_ma + hi_ma) / 2.0 ELSE full_ma END, 6) AS ma
FROM w
"""))
def win_ma_blocked_even(spark, sf_dir):
    """WIN-6/7 on the raw rows: the even order, whose edges need the series' length."""
    rows = S.moving_average_blocked(weekly_lines(spark, sf_dir), order=P.EVEN_ORDER)
    return rows.select("regionid", "product", "yearweek", "qty", "idx", report("ma").alias("ma"))


@query("win_precondition", oracle=with_sellout(f"""
SELECT regionid, product, count(*) AS n, count(*) >= {P.LONG_ORDER} AS accepted
FROM clean GROUP BY regionid, product
""", clean=True))
def win_precondition(spark, sf_dir):
    """WIN-9: series that are long enough for a moving average, and those that are not."""
    return S.precondition(clean_sellout(spark, sf_dir), P.LONG_ORDER)[0]

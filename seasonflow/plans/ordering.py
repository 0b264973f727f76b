"""Catalogue: sorting, top-k and the actual-vs-predicted long table (SRT-*, SET-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rounding import report
from ..operators import numbering as N
from ..operators import reshape as R
from ..operators import seasonality as S
from ..operators.joins import materialize
from ..sources.tables import sellout
from . import params as P
from .registry import query, with_sellout

@query("srt_yearweek", oracle=with_sellout("SELECT regionid, product, yearweek, qty FROM sellout"))
def srt_yearweek(spark, sf_dir):
    """SRT-1: global ascending sort by yearweek (ties by region, product)."""
    return R.sort_total(sellout(spark, sf_dir), "yearweek", "regionid", "product")

@query("srt_position", oracle=with_sellout("""
SELECT row_number() OVER (ORDER BY yearweek, regionid, product) - 1 AS pos,
       regionid, product, yearweek, qty FROM sellout
"""))
def srt_position(spark, sf_dir):
    """SRT-1 with the order shown: every row's place in the global sort."""
    return N.with_position(sellout(spark, sf_dir), "yearweek", "regionid", "product").select(
        "pos", "regionid", "product", "yearweek", "qty")

@query("srt_topk", oracle=with_sellout(f"""
SELECT regionid, product, yearweek, qty FROM sellout
ORDER BY qty DESC, regionid, product, yearweek LIMIT {P.TOP_K}
"""))
def srt_topk(spark, sf_dir):
    """SRT-3: the k largest weekly quantities (first / take n with a total order)."""
    return R.top_k(sellout(spark, sf_dir), P.TOP_K, "qty", ["regionid", "product", "yearweek"])

def _actual_vs_ma(spark, sf_dir):
    return S.seasonal_rows(sellout(spark, sf_dir), order=P.ORDER, cap_value=P.CAP).select(
        "regionid", "product", "yearweek", "qty", report("ma").alias("ma"))

_LONG_SQL = """
WITH s AS (SELECT regionid, product, yearweek, sum(qty) AS qty FROM clean GROUP BY ALL),
m AS (SELECT *, round(avg(qty) OVER (PARTITION BY regionid, product
        ORDER BY CAST(yearweek AS INTEGER), yearweek, qty
        ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING), 6) AS ma FROM s)
SELECT 'REAL-QTY' AS MEASURE, regionid AS REGIONID, product AS PRODUCT, yearweek AS YEARWEEK,
       qty AS SALES FROM m
UNION ALL
SELECT 'PREDICTION-QTY' AS MEASURE, regionid AS REGIONID, product AS PRODUCT, yearweek AS YEARWEEK,
       ma AS SALES FROM m
"""

def _ids():
    return [F.col("regionid").alias("REGIONID"), F.col("product").alias("PRODUCT"),
            F.col("yearweek").alias("YEARWEEK")]

@query("reshape_measures", oracle=with_sellout(_LONG_SQL, clean=True))
def reshape_measures(spark, sf_dir):
    """SET-1 + PRJ-7/17: UNION ALL of real and predicted measures, upper-case labels.

    Both branches read the same checkpointed series (one row per key and week) instead
    of recomputing the sell-out joins twice.
    """
    df = materialize(_actual_vs_ma(spark, sf_dir).select(*_ids(), "qty", "ma"))
    return R.measures_union(df, ["REGIONID", "PRODUCT", "YEARWEEK"], "qty", "ma")

@query("reshape_unpivot", oracle=with_sellout(_LONG_SQL, clean=True))
def reshape_unpivot(spark, sf_dir):
    """SET-2 / ML-11: the same long table from a single scan with ``unpivot``."""
    df = _actual_vs_ma(spark, sf_dir).select(*_ids(), "qty", "ma")
    return R.measures_unpivot(df, ["REGIONID", "PRODUCT", "YEARWEEK"], "qty", "ma")

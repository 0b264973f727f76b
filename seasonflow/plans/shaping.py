"""Catalogue: projections, filters and joins (PRJ-*, FLT-*, JN-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.schemas import (
    CLEANED_SELLOUT_SCHEMA, by_ordinal, column_index, impose_schema, positional,
)
from ..functions.yearweek import yearweek_range
from ..operators import cleaning as C
from ..operators import enrich as E
from ..operators.joins import lookup_join
from ..sources.tables import part_names, product_master, region_master, sellout, table
from . import params as P
from .common import parameter_table
from .registry import PARAMS_SQL, query, with_sellout

_BASE = "regionid, product, yearweek, qty"
_IN = "('PROMO', 'SMALL')"
_MASTER_SQL = """
SELECT DISTINCT p_type AS product_id,
       upper(substring(p_type, 1, 1)) || lower(substring(p_type, 2)) AS product_name
FROM part
"""
_RAW_SQL = f"""
WITH mst AS ({_MASTER_SQL}),
raw AS (
  SELECT a.regionid || '_' || a.product AS keycol, a.regionid AS accountid, a.product,
         a.yearweek, CAST(a.qty AS DOUBLE) AS qty, b.product_name AS productname
  FROM sellout a LEFT JOIN mst b ON a.product = b.product_id)
"""


def _base(df):
    return df.select("regionid", "product", "yearweek", "qty")


def _raw(spark, sf_dir):
    return E.raw_data(sellout(spark, sf_dir), product_master(spark, sf_dir))


# --- projections -------------------------------------------------------------------

@query("prj_rawdata", oracle=with_sellout(_RAW_SQL + "SELECT * FROM raw"))
def prj_rawdata(spark, sf_dir):
    """JN-5 + PRJ-2/3/4: keyed, renamed and typed fact with the product name."""
    return _raw(spark, sf_dir)


@query("prj_cast_roundtrip", oracle=with_sellout(f"""
SELECT {_BASE}, CAST(qty AS VARCHAR) AS qty_text,
       CAST(CAST(qty AS VARCHAR) AS DOUBLE) AS qty_parsed,
       CAST(CAST(qty AS VARCHAR) AS DOUBLE) = qty AS same
FROM sellout
"""))
def prj_cast_roundtrip(spark, sf_dir):
    """PRJ-5 / FN-9: number -> string -> number leaves the value unchanged."""
    s = sellout(spark, sf_dir)
    text = F.col("qty").cast("string")
    return _base(s).select("*", text.alias("qty_text"), text.try_cast("double").alias("qty_parsed"),
                           (text.try_cast("double") == F.col("qty")).alias("same"))


@query("prj_uplift", oracle=with_sellout(f"SELECT {_BASE}, qty * 1.2 AS new_qty FROM sellout"))
def prj_uplift(spark, sf_dir):
    """PRJ-8: arithmetic projection ``qty * 1.2``."""
    return _base(sellout(spark, sf_dir)).withColumn("new_qty", F.col("qty") * F.lit(P.UPLIFT))


@query("prj_flags", oracle=with_sellout(f"""
SELECT {_BASE},
       CASE WHEN product = 'PROMO' THEN 1 ELSE 0 END AS promotioncode,
       CASE WHEN TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) IN (1, 51, 52) THEN 1 ELSE 0 END AS holidaycode
FROM sellout
"""))
def prj_flags(spark, sf_dir):
    """PRJ-9: 0/1 codes from conditions (promotion product, holiday week)."""
    s = _base(sellout(spark, sf_dir))
    return s.select("*", E.flag(F.col("product") == "PROMO").alias("promotioncode"),
                    E.holiday_flag().alias("holidaycode"))


@query("prj_grade_case", oracle=with_sellout(f"""
SELECT {_BASE},
       CASE WHEN qty > 200 THEN '수' WHEN qty > 100 AND qty <= 200 THEN '우' ELSE '양' END AS grade
FROM sellout
"""))
def prj_grade_case(spark, sf_dir):
    """PRJ-10: three-tier grade of the weekly quantity."""
    s = _base(sellout(spark, sf_dir))
    return s.withColumn("grade", E.grade("qty", 200, 100))


@query("prj_cap", oracle=with_sellout("""
SELECT regionid, product, yearweek, CASE WHEN NOT isnan(qty) AND qty > 300 THEN 300.0 ELSE qty END AS qty FROM sellout
"""))
def prj_cap(spark, sf_dir):
    """PRJ-11: cap quantities above the threshold."""
    return C.cap(_base(sellout(spark, sf_dir)), P.CAP)


@query("prj_cap_keep_original", oracle=with_sellout("""
SELECT regionid, product, yearweek, CASE WHEN NOT isnan(qty) AND qty > 300 THEN 300.0 ELSE qty END AS qty,
       qty AS original_qty
FROM sellout
"""))
def prj_cap_keep_original(spark, sf_dir):
    """PRJ-12: capped quantity with the original kept beside it."""
    return C.cap_keep_original(_base(sellout(spark, sf_dir)), P.CAP)


_SQL_FILTER = f"""
SELECT {_BASE}, qty * 1.2 AS new_qty FROM sellout
WHERE 1 = 1
  AND TRY_CAST(substring(yearweek, 1, 4) AS INTEGER) >= 2000
  AND TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) != 52
  AND product IN {_IN}
"""


def _sql_filter(spark, sf_dir):
    """FLT-10 as a bound-parameter SQL statement over a temp view (SRC-9/12)."""
    from ..sources.views import sql

    return sql(spark, """
        SELECT regionid, product, yearweek, qty, qty * :uplift AS new_qty
        FROM {keydata}
        WHERE 1 = 1
          AND try_cast(substring(yearweek, 1, 4) AS INT) >= :min_year
          AND try_cast(substring(yearweek, 5, 2) AS INT) != :bad_week
          AND product IN (:p1, :p2)""",
               frames={"keydata": sellout(spark, sf_dir, weeks=(f"{P.MIN_YEAR}01", None))},
               uplift=P.UPLIFT, min_year=P.MIN_YEAR, bad_week=P.SQL_BAD_WEEK,
               p1=P.PRODUCTS[0], p2=P.PRODUCTS[1])


@query("prj_positional", oracle=with_sellout(
    f"SELECT regionid AS _1, product AS _2 FROM ({_SQL_FILTER})"))
def prj_positional(spark, sf_dir):
    """PRJ-13: tuple-style projection ``(_1, _2)`` of the SQL-filtered rows."""
    return positional(_sql_filter(spark, sf_dir), "regionid", "product")


@query("prj_by_ordinal", oracle=with_sellout("""
SELECT regionid, qty, 0 AS regionid_at, 3 AS qty_at, -1 AS exact_at FROM sellout
"""))
def prj_by_ordinal(spark, sf_dir):
    """PRJ-14/15: columns looked up by name, exactly and without regard to case, and projected
    by their ordinals."""
    df = _base(sellout(spark, sf_dir))
    at = {name: column_index(df, name.upper(), True) for name in ("regionid", "qty")}
    exact = column_index(df, "QTY")
    return by_ordinal(df, *at.values()).select(
        "*", *[F.lit(i).alias(f"{name}_at") for name, i in at.items()], F.lit(exact).alias("exact_at"))


@query("prj_final_schema", oracle=with_sellout(_RAW_SQL + f"""
SELECT keycol AS KEY, accountid AS REGIONID, product AS PRODUCT, yearweek AS YEARWEEK,
       qty AS VOLUME, productname AS PRODUCTNAME
FROM raw WHERE product IN {_IN}
"""))
def prj_final_schema(spark, sf_dir):
    """PRJ-16 + FLT-3: product-filtered raw data re-typed to the output schema."""
    return impose_schema(C.in_set(_raw(spark, sf_dir), P.PRODUCTS), CLEANED_SELLOUT_SCHEMA)


# --- filters -----------------------------------------------------------------------

@query("flt_yearweek_len", oracle=with_sellout(
    f"SELECT {_BASE} FROM sellout WHERE length(yearweek) = 6"))
def flt_yearweek_len(spark, sf_dir):
    """FLT-1: well-formed yearweek."""
    return C.valid_yearweek(_base(sellout(spark, sf_dir)))


@query("flt_week52", oracle=with_sellout(
    f"SELECT {_BASE} FROM sellout WHERE TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) <= 52"))
def flt_week52(spark, sf_dir):
    """FLT-2: drop weeks above 52."""
    return C.drop_late_weeks(_base(sellout(spark, sf_dir)))


@query("flt_product_set", oracle=with_sellout(f"SELECT {_BASE} FROM sellout WHERE product IN {_IN}"))
def flt_product_set(spark, sf_dir):
    """FLT-3/4: product set membership."""
    return C.in_set(_base(sellout(spark, sf_dir)), P.PRODUCTS)


@query("flt_product_or", oracle=with_sellout(
    f"SELECT {_BASE} FROM sellout WHERE product = 'PROMO' OR product = 'SMALL'"))
def flt_product_or(spark, sf_dir):
    """FLT-5: OR of equalities."""
    return C.any_equal(_base(sellout(spark, sf_dir)), P.PRODUCTS)


@query("flt_precedence", oracle=with_sellout(f"""
SELECT {_BASE} FROM sellout
WHERE (TRY_CAST(substring(yearweek, 1, 4) AS INTEGER) >= 2000
       AND TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) != 53
       AND product = 'PROMO')
   OR product = 'SMALL'
"""))
def flt_precedence(spark, sf_dir):
    """FLT-6: ``A && B && C || D`` with the reference's precedence."""
    return C.precedence_filter(_base(sellout(spark, sf_dir)), P.MIN_YEAR, P.BAD_WEEK, *P.PRODUCTS)


@query("flt_over_cap", oracle=with_sellout(f"SELECT {_BASE} FROM sellout WHERE qty > 300"))
def flt_over_cap(spark, sf_dir):
    """FLT-7: rows above the cap."""
    return C.over(_base(sellout(spark, sf_dir)), P.CAP)


@query("flt_region", oracle=with_sellout(f"""
SELECT regionid || '_' || product AS keycol, regionid AS accountid, product, yearweek, qty,
       'test' AS productname
FROM sellout WHERE 1 = 1 AND regionid = 'AFRICA' AND product IN {_IN}
"""))
def flt_region(spark, sf_dir):
    """FLT-8 + PRJ-7: region equality and product IN list, constant column."""
    s = sellout(spark, sf_dir)
    s = C.in_set(s.filter(F.lit(1) == F.lit(1)).filter(F.col("regionid") == P.REGION), P.PRODUCTS)
    return s.select(E.key_column().alias("keycol"), F.col("regionid").alias("accountid"),
                    "product", "yearweek", "qty", F.lit("test").alias("productname"))


@query("flt_yearweek_between", oracle=with_sellout(f"""
SELECT {_BASE} FROM sellout WHERE yearweek BETWEEN '{P.YEARWEEK_FROM}' AND '{P.YEARWEEK_TO}'
"""))
def flt_yearweek_between(spark, sf_dir):
    """FLT-9: inclusive lexicographic range on the yearweek string."""
    weeks = (P.YEARWEEK_FROM, P.YEARWEEK_TO)
    return _base(sellout(spark, sf_dir, weeks)).filter(yearweek_range(*weeks))


@query("flt_year_week_sql", oracle=with_sellout(_SQL_FILTER))
def flt_year_week_sql(spark, sf_dir):
    """FLT-10 (+ FN-3, FLT-4, PRJ-8): the SQL-text filter with bound parameters."""
    return _sql_filter(spark, sf_dir)


@query("flt_param_driven", oracle=with_sellout(f"""
WITH params AS ({PARAMS_SQL}),
act AS (SELECT * FROM params WHERE use_yn = 'Y' AND param_category = 'COMMON'),
sc AS (SELECT coalesce(min(CASE WHEN param_name = 'VALID_WEEK' THEN TRY_CAST(param_value AS INTEGER) END), 53) AS vw,
              coalesce(min(CASE WHEN param_name = 'VALID_YEAR' THEN TRY_CAST(param_value AS INTEGER) END), 2016) AS vy
       FROM act)
SELECT regionid, product, yearweek, qty AS volume, qty * 1.2 AS new_qty
FROM sellout
WHERE product IN (SELECT param_value FROM act WHERE param_name = 'VALID_PRODUCT')
  AND TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) < (SELECT vw FROM sc)
  AND TRY_CAST(substring(yearweek, 1, 4) AS INTEGER) >= (SELECT vy FROM sc)
"""))
def flt_param_driven(spark, sf_dir):
    """FLT-12/13 + JN-6: week/year/product filter read from the parameter table."""
    s = _base(sellout(spark, sf_dir))
    kept = C.parameter_filter(s, parameter_table(spark, sf_dir))
    return kept.select("regionid", "product", "yearweek", F.col("qty").alias("volume"),
                       (F.col("qty") * F.lit(P.UPLIFT)).alias("new_qty"))


# --- joins -------------------------------------------------------------------------

def _star(spark, sf_dir, how):
    items = table(spark, sf_dir, "lineitem")
    parts, small = part_names(spark, sf_dir)
    j = lookup_join(items, parts, items["l_partkey"] == parts["p_partkey"], how, small)
    return j.select(*[items[c] for c in items.columns], parts["p_name"])


_STAR_SQL = """
SELECT a.*, b.p_name FROM lineitem a {how} JOIN part b
ON a.l_partkey = b.p_partkey
"""


@query("join_left_star", oracle=_STAR_SQL.format(how="LEFT"))
def join_left_star(spark, sf_dir):
    """JN-1 + PRJ-1: ``select a.*, b.name`` with a left outer join."""
    return _star(spark, sf_dir, "left")


@query("join_inner_star", oracle=_STAR_SQL.format(how="INNER"))
def join_inner_star(spark, sf_dir):
    """JN-2: the same with an inner join."""
    return _star(spark, sf_dir, "inner")


_REGION_SQL = """
SELECT a.regionid, a.product, a.yearweek, a.qty, b.regionkey
FROM sellout a {how} JOIN (SELECT r_name AS regionid, CAST(r_regionkey AS BIGINT) AS regionkey
                           FROM region) b
ON a.regionid = b.regionid
"""


@query("join_left_region", oracle=with_sellout(_REGION_SQL.format(how="LEFT")))
def join_left_region(spark, sf_dir):
    """JN-3: fact left-joined to the region master, projected."""
    master, small = region_master(spark, sf_dir)
    return lookup_join(_base(sellout(spark, sf_dir)), master, "regionid", "left", small)


@query("join_inner_region", oracle=with_sellout(_REGION_SQL.format(how="INNER")))
def join_inner_region(spark, sf_dir):
    """JN-4: the same with an inner join."""
    master, small = region_master(spark, sf_dir)
    return lookup_join(_base(sellout(spark, sf_dir)), master, "regionid", "inner", small)


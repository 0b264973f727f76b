"""Catalogue: forecast input, split, metrics and the three regression models (ML-*)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.rounding import report
from ..operators import forecast as M
from ..operators import seasonality as S
from ..operators.joins import materialize
from ..sources.tables import sellout, weekly_features
from . import params as P
from .registry import query, with_sellout

_FEATURES_SQL = f"""
WITH feat AS (
  SELECT r_name AS regionid, p_type AS product,
         CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS VARCHAR) AS yearweek,
         sum(l_quantity) AS qty,
         sum(CAST(round(l_discount * 100) AS BIGINT)) / count(l_discount) / 100.0 AS pro_percent
  FROM lineitem
  JOIN orders ON l_orderkey = o_orderkey
  JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey
  JOIN part ON l_partkey = p_partkey
  GROUP BY 1, 2, 3),
inp AS (
  SELECT regionid, product, yearweek,
         CAST(TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) AS DOUBLE) AS week,
         qty, pro_percent,
         CASE WHEN product = 'PROMO' THEN 1 ELSE 0 END AS promotioncode,
         CASE WHEN TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) IN (1, 51, 52) THEN 1 ELSE 0 END AS holidaycode
  FROM feat WHERE yearweek BETWEEN '{P.YEARWEEK_FROM}' AND '{P.YEARWEEK_TO}')
"""


def _input(spark, sf_dir):
    weeks = (P.YEARWEEK_FROM, P.YEARWEEK_TO)
    return M.model_input(weekly_features(spark, sf_dir, weeks), *weeks)


@query("ml_input", oracle=_FEATURES_SQL + "SELECT * FROM inp")
def ml_input(spark, sf_dir):
    """ML-1 (+ PRJ-4/6/9, FLT-9): model input with casts, codes and the year window."""
    return _input(spark, sf_dir)


@query("ml_split", oracle=_FEATURES_SQL + f"""
SELECT *, CASE WHEN CAST(yearweek AS INTEGER) <= {P.SPLIT_YEARWEEK} THEN 'train' ELSE 'test' END AS split
FROM inp
""")
def ml_split(spark, sf_dir):
    """ML-2 / FLT-11: complementary train / test filters on the integer yearweek."""
    return M.split_label(_input(spark, sf_dir), P.SPLIT_YEARWEEK)


@query("ml_metrics", oracle=with_sellout("""
WITH s AS (SELECT regionid, product, yearweek, sum(qty) AS qty FROM clean GROUP BY ALL),
m AS (SELECT *, avg(qty) OVER (PARTITION BY regionid, product
        ORDER BY CAST(yearweek AS INTEGER), yearweek, qty
        ROWS BETWEEN 8 PRECEDING AND 8 FOLLOWING) AS ma FROM s)
SELECT count(*) AS n, round(sqrt(avg((qty - ma) * (qty - ma))), 6) AS rmse,
       round(avg(abs(qty - ma)), 6) AS mae
FROM m
""", clean=True))
def ml_metrics(spark, sf_dir):
    """ML-8: RMSE / MAE of the moving average as a deterministic prediction."""
    r = S.seasonal_rows(sellout(spark, sf_dir), order=P.ORDER, cap_value=P.CAP)
    m = M.error_metrics(r, "qty", "ma")
    return m.select("n", report("rmse").alias("rmse"), report("mae").alias("mae"))


def _predictions(spark, sf_dir, kind, ordered=True):
    train, test = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    model = M.fit(train, kind)
    return M.predict(model, test, ordered).select(
        "regionid", "product", "yearweek", "qty", "prediction")


# Ordinary least squares of qty on three features by the normal equations of the centred
# moments, solved by Cramer's rule.
_OLS_SQL = _FEATURES_SQL + f""",
tr AS (SELECT week AS a, pro_percent AS b, CAST(holidaycode AS DOUBLE) AS c, qty AS y
       FROM inp WHERE CAST(yearweek AS INTEGER) <= {P.SPLIT_YEARWEEK}),
mo AS (SELECT avg(a) AS ma, avg(b) AS mb, avg(c) AS mc, avg(y) AS my,
              var_pop(a) AS aa, var_pop(b) AS bb, var_pop(c) AS cc,
              covar_pop(a, b) AS ab, covar_pop(a, c) AS ac, covar_pop(b, c) AS bc,
              covar_pop(a, y) AS ay, covar_pop(b, y) AS by_, covar_pop(c, y) AS cy FROM tr),
det AS (SELECT *, aa * (bb * cc - bc * bc) - ab * (ab * cc - bc * ac) + ac * (ab * bc - bb * ac) AS d
        FROM mo),
co AS (SELECT ma, mb, mc, my,
         (ay * (bb * cc - bc * bc) - ab * (by_ * cc - bc * cy) + ac * (by_ * bc - bb * cy)) / d AS ka,
         (aa * (by_ * cc - bc * cy) - ay * (ab * cc - bc * ac) + ac * (ab * cy - by_ * ac)) / d AS kb,
         (aa * (bb * cy - by_ * bc) - ab * (ab * cy - by_ * ac) + ay * (ab * bc - bb * ac)) / d AS kc
       FROM det),
pr AS (SELECT regionid, product, yearweek, qty,
              my + ka * (week - ma) + kb * (pro_percent - mb) + kc * (holidaycode - mc) AS p
       FROM inp, co WHERE CAST(yearweek AS INTEGER) > {P.SPLIT_YEARWEEK})
"""


@query("ml_dt")
def ml_dt(spark, sf_dir):
    """ML-3/4/7: decision-tree pipeline, predictions on the test weeks."""
    return _predictions(spark, sf_dir, "decision_tree")


# The best first split: for every feature and every value but the largest, the drop in
# variance when rows up to that value go left.
_STUMP_SQL = _FEATURES_SQL + f""",
tr AS (SELECT week, pro_percent, CAST(holidaycode AS DOUBLE) AS holidaycode, qty AS y
       FROM inp WHERE CAST(yearweek AS INTEGER) <= {P.SPLIT_YEARWEEK}),
per AS (SELECT f, v, count(*) AS n, sum(y) AS s, sum(y * y) AS q
        FROM (SELECT 0 AS f, week AS v, y FROM tr UNION ALL SELECT 1, pro_percent, y FROM tr
              UNION ALL SELECT 2, holidaycode, y FROM tr) GROUP BY f, v),
cum AS (SELECT f, v, lead(v) OVER w AS next, sum(n) OVER w AS n, sum(s) OVER w AS s, sum(q) OVER w AS q,
               sum(n) OVER a AS nn, sum(s) OVER a AS ss, sum(q) OVER a AS qq
        FROM per WINDOW w AS (PARTITION BY f ORDER BY v), a AS (PARTITION BY f)),
best AS (SELECT f, (v + next) / 2 AS t, s / n AS lo, (ss - s) / (nn - n) AS hi,
                (q - s * s / n + (qq - q) - (ss - s) * (ss - s) / (nn - n)) AS rest
         FROM cum WHERE next IS NOT NULL ORDER BY rest, f, v LIMIT 1)
"""


@query("ml_dt_stump", oracle=_STUMP_SQL + f"""
SELECT regionid, product, yearweek, qty,
       round(CASE WHEN CASE f WHEN 0 THEN week WHEN 1 THEN pro_percent ELSE holidaycode END <= t
                  THEN lo ELSE hi END, 6) AS prediction
FROM inp, best WHERE CAST(yearweek AS INTEGER) > {P.SPLIT_YEARWEEK}
""")
def ml_dt_stump(spark, sf_dir):
    """ML-4 held against SQL: a tree of depth one that may split at any value."""
    train, test = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    model = M.fit(train, "decision_tree", maxDepth=1, maxBins=M.exact_bins(train))
    return M.predict(model, test).select("regionid", "product", "yearweek", "qty",
                                         report("prediction").alias("prediction"))


@query("ml_stump_nodes", oracle=_STUMP_SQL + """
SELECT 0 AS node, ['week', 'pro_percent', 'holidaycode'][f + 1] AS feature, round(t, 6) AS threshold,
       round(nn_y, 6) AS prediction, nn AS rows
FROM best, (SELECT count(*) AS nn, avg(y) AS nn_y FROM tr)
UNION ALL SELECT 1, NULL, NULL, round(lo, 6), (SELECT count(*) FROM tr, best WHERE
  CASE f WHEN 0 THEN week WHEN 1 THEN pro_percent ELSE holidaycode END <= t) FROM best
UNION ALL SELECT 2, NULL, NULL, round(hi, 6), (SELECT count(*) FROM tr, best WHERE
  CASE f WHEN 0 THEN week WHEN 1 THEN pro_percent ELSE holidaycode END > t) FROM best
""")
def ml_stump_nodes(spark, sf_dir):
    """ML-10 held against SQL: the node table of the tree of depth one."""
    train, _ = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    model = M.fit(train, "decision_tree", maxDepth=1, maxBins=M.exact_bins(train))
    return M.tree_nodes(model).select("node", "feature", report("threshold").alias("threshold"),
                                      report("prediction").alias("prediction"), "rows")


@query("ml_tree_nodes")
def ml_tree_nodes(spark, sf_dir):
    """ML-10: the fitted forest's nodes as a table."""
    train, _ = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    return M.tree_nodes(M.fit(train, "random_forest"))


@query("ml_lr", oracle=_OLS_SQL
       + "SELECT regionid, product, yearweek, qty, round(p, 4) AS prediction FROM pr")
def ml_lr(spark, sf_dir):
    """ML-5: linear-regression pipeline."""
    return _predictions(spark, sf_dir, "linear_regression").withColumn(
        "prediction", F.round("prediction", 4))


@query("ml_compare_linear", oracle=_OLS_SQL + """
SELECT count(*) AS n, round(sqrt(avg((qty - p) * (qty - p))), 4) AS rmse,
       round(avg(abs(qty - p)), 4) AS mae FROM pr
""")
def ml_compare_linear(spark, sf_dir):
    """ML-9: the linear model's row of the comparison."""
    split = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    row = M.compare(*split, kinds=("linear_regression",))
    return row.select("n", F.round("rmse", 4).alias("rmse"), F.round("mae", 4).alias("mae"))


@query("ml_rf")
def ml_rf(spark, sf_dir):
    """ML-6: random-forest pipeline with an explicit seed."""
    return _predictions(spark, sf_dir, "random_forest")


@query("ml_dt_long")
def ml_dt_long(spark, sf_dir):
    """ML-11: decision-tree actual vs predicted as the reference's long table."""
    return M.actual_vs_predicted(_predictions(spark, sf_dir, "decision_tree", ordered=False))


@query("ml_compare")
def ml_compare(spark, sf_dir):
    """ML-9: RMSE and MAE of the three models on the same split."""
    train, test = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    return M.compare(train, test)


@query("ml_lr_one_feature", oracle=_FEATURES_SQL + f"""
SELECT round(regr_slope(qty, week), 6) AS slope, round(regr_intercept(qty, week), 6) AS intercept
FROM inp WHERE CAST(yearweek AS INTEGER) <= {P.SPLIT_YEARWEEK}
""")
def ml_lr_one_feature(spark, sf_dir):
    """ML-5 with one feature: coefficients equal ordinary least squares."""
    train, _ = M.time_split(materialize(_input(spark, sf_dir)), P.SPLIT_YEARWEEK)
    lr = M.fit(train, "linear_regression", features=("week",)).stages[-1]
    return spark.range(1).select(F.round(F.lit(float(lr.coefficients[0])), 6).alias("slope"),
                                 F.round(F.lit(float(lr.intercept)), 6).alias("intercept"))

"""Query catalogue registry.

Each registered query is a callable ``(spark, sf_dir) -> DataFrame`` over the parquet
tables in ``sf_dir`` (or data Spark derives from them). The optional oracle is an
equivalent DuckDB SQL text over the same tables, used for correctness checks; the
two sides alias every computed column to the same name.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    """Register ``fn`` under ``name`` with its oracle SQL (None: rows-only check)."""

    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name!r}")
        QUERIES[name] = fn
        if oracle is not None:
            ORACLE[name] = oracle
        return fn

    return deco


# --- shared oracle fragments (DuckDB dialect) -------------------------------------

SELLOUT_SQL = """
SELECT r_name AS regionid, p_type AS product,
       CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS VARCHAR) AS yearweek,
       sum(l_quantity) AS qty
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2, 3
"""

# The raw rows behind it: one per line item.
LINES_SQL = """
SELECT r_name AS regionid, p_type AS product,
       CAST(isoyear(o_orderdate) * 100 + week(o_orderdate) AS VARCHAR) AS yearweek,
       l_quantity AS qty
FROM lineitem
JOIN orders ON l_orderkey = o_orderkey
JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey
JOIN region ON n_regionkey = r_regionkey
JOIN part ON l_partkey = p_partkey
"""

# Cleaned fact used by most reference jobs: weeks <= 52, quantity capped.
CLEAN_SQL = """
SELECT regionid, product, yearweek,
       CASE WHEN NOT isnan(qty) AND qty > 300 THEN 300.0 ELSE qty END AS qty
FROM sellout
WHERE TRY_CAST(substring(yearweek, 5, 2) AS INTEGER) <= 52
"""

# Parameter table: one VALID_PRODUCT row per part type (PROMO and SMALL active),
# plus the VALID_WEEK / VALID_YEAR scalars.
PARAMS_SQL = """
SELECT 'COMMON' AS param_category, 'VALID_PRODUCT' AS param_name, p_type AS param_value,
       CASE WHEN p_type IN ('PROMO', 'SMALL') THEN 'Y' ELSE 'N' END AS use_yn
FROM (SELECT DISTINCT p_type FROM part)
UNION ALL SELECT 'COMMON', 'VALID_WEEK', '53', 'Y'
UNION ALL SELECT 'COMMON', 'VALID_YEAR', '2000', 'Y'
"""


def with_lines(body: str) -> str:
    """Prefix ``body`` with the ``lines`` CTE."""
    return f"WITH lines AS ({LINES_SQL})\n" + body.strip()


def with_sellout(body: str, clean: bool = False) -> str:
    """Prefix ``body`` with the ``sellout`` (and optionally ``clean``) CTEs."""
    ctes = f"sellout AS ({SELLOUT_SQL})"
    if clean:
        ctes += f",\nclean AS ({CLEAN_SQL})"
    body = body.strip()
    if body.upper().startswith("WITH "):
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"

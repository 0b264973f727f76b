"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math

import duckdb

from seasonflow.sources.tables import TABLES


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    return v


def canonical(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


SPARK_TO_DUCK = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR",
                 "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "date": "DATE"}


def assert_same(df, con, sql):
    res = con.execute(sql)
    dcols = [d[0] for d in res.description]
    dtypes = {d[0]: str(d[1]).upper() for d in res.description}
    drows = res.fetchall()
    srows = [tuple(r) for r in df.collect()]
    assert sorted(df.columns) == sorted(dcols)
    for name, t in df.dtypes:
        assert SPARK_TO_DUCK.get(t, t.upper()) == dtypes[name], (name, t, dtypes[name])
    assert len(srows) == len(drows)
    assert canonical(df.columns, srows) == canonical(dcols, drows)

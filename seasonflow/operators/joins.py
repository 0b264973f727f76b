"""Joins whose broadcast is bounded in measured rows and bytes.

A base table is broadcast only after its rows and the bytes of its values have been
measured against a bound; each table is measured once per session and state of its files. Derived
sides (aggregates, distincts) are never sized in advance: AQE sees the real size of
their shuffle and then broadcasts them or joins by shuffle, splitting hot keys.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.util import names
from ..session import scratch_path

# Broadcast bounds for lookup sides: both hold.
DEFAULT_BROADCAST_ROWS = 200_000
DEFAULT_BROADCAST_BYTES = 64 * 1024 * 1024

_FIXED_WIDTH = {"boolean": 1, "tinyint": 1, "smallint": 2, "int": 4, "bigint": 8, "float": 4,
                "double": 8, "date": 4, "timestamp": 8, "timestamp_ntz": 8}
_ROW_OVERHEAD = 16


@dataclass(frozen=True)
class Size:
    """Measured size of a table: rows, bytes of all values, bytes of its widest row."""

    rows: int
    bytes: int
    widest: int


def _bytes_of(df: DataFrame) -> Column:
    """Bytes of a row's values: real lengths for strings, binary and nested values."""
    width = F.lit(_ROW_OVERHEAD).cast("long")
    for f in df.schema.fields:
        name, c = f.dataType.simpleString(), F.col(f"`{f.name}`")
        if name in _FIXED_WIDTH:
            width = width + _FIXED_WIDTH[name]
        elif name.startswith("decimal"):
            width = width + 16
        elif name in ("string", "binary") or name.startswith(("char", "varchar")):
            width = width + F.coalesce(F.octet_length(c), F.lit(0))
        else:
            # JSON text is about as long as the nested values; counted twice to be safe
            width = width + 2 * F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
    return width


def measure(df: DataFrame, max_rows: int = DEFAULT_BROADCAST_ROWS) -> Size | None:
    """Measured size of ``df``, or None if it has more than ``max_rows`` rows.

    ``offset(max_rows).isEmpty()`` scans partitions incrementally and stops at row
    ``max_rows + 1``, so a huge table is not scanned; only a table within the row bound
    has its bytes summed.
    """
    if not df.offset(max_rows).isEmpty():
        return None
    row = df.select(_bytes_of(df).alias("w")).agg(F.count("*"), F.sum("w"), F.max("w")).first()
    return Size(row[0], row[1] or 0, row[2] or 0)


_MEASURED: dict[tuple, Size | None] = {}


def listing(spark: SparkSession, path: str) -> tuple:
    """The data files under ``path`` with their lengths and times of change."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).listFiles(at, True)
    found = []
    while files.hasNext():
        file = files.next()
        found.append((file.getPath().toString(), file.getLen(), file.getModificationTime()))
    return tuple(sorted(found))


def measure_once(df: DataFrame, path: str, *key) -> Size | None:
    """:func:`measure` of a table at ``path``, remembered per session under ``key`` (table,
    columns) for as long as the table's files are the same."""
    spark = df.sparkSession
    key = (spark.sparkContext.applicationId, listing(spark, path), *key)
    if key not in _MEASURED:
        _MEASURED[key] = measure(df)
    return _MEASURED[key]


def fits(size: Size | None, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
    return size is not None and size.bytes <= max_bytes


def materialize(df: DataFrame) -> DataFrame:
    """Write a derived table as Parquet in the shared folder and read it back.

    Used where several passes read the same result: it is computed once, a lost executor
    costs a re-read, and readers still prune columns and push filters.
    """
    path = scratch_path(df.sparkSession, f"table-{uuid.uuid4().hex[:6]}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def lookup_join(fact: DataFrame, dim: DataFrame, on, how: str = "left",
                small: bool = False) -> DataFrame:
    """Join a fact table to a lookup side.

    ``small`` says that the lookup side has been measured and :func:`fits`: it is then
    broadcast. Otherwise the planner decides, at run time on real sizes with AQE.
    ``how`` is one of the join types where the lookup is the build side
    (``inner``, ``left``, ``left_semi``, ``left_anti``).
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "semi", "left_anti", "anti"):
        raise ValueError(f"lookup_join builds on the right side; unsupported how={how!r}")
    return fact.join(F.broadcast(dim) if small else dim, on, how)


def attach(fact: DataFrame, per_key: DataFrame, keys) -> DataFrame:
    """Attach one-row-per-key results (an aggregate) back onto the rows of ``fact``.

    Keys are compared null-safe, so rows of a null key keep their group's results. AQE
    broadcasts the aggregate if its measured size allows, else it splits skewed fact
    partitions and replicates the one matching row, so a hot key is not one task.
    """
    keys = names(keys)
    same = reduce(lambda a, b: a & b,
                  [F.col(f"f.{k}").eqNullSafe(F.col(f"k.{k}")) for k in keys])
    values = [F.col(f"k.{c}") for c in per_key.columns if c not in keys]
    return fact.alias("f").join(per_key.alias("k"), same).select("f.*", *values)

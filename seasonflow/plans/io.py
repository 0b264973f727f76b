"""Catalogue: write/read round trips through the shared scratch folder (SRC-1..3, SNK-4/5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.schemas import SELLOUT_SCHEMA
from ..session import scratch_path
from ..sources.readers import read_csv, read_delimited, read_text
from ..sources.tables import sellout
from ..sources import views as V
from ..sources.writers import append_batch, write_csv, write_text
from . import params as P
from .registry import query, with_sellout


@query("src_csv_roundtrip", oracle=with_sellout("SELECT regionid, product, yearweek, qty FROM sellout"))
def src_csv_roundtrip(spark, sf_dir):
    """Write the sell-out as CSV with a header, read it back with an explicit schema."""
    path = write_csv(sellout(spark, sf_dir), scratch_path(spark, "sellout-csv"), header=True)
    return read_csv(spark, path, schema=SELLOUT_SCHEMA, header=True)


@query("src_delimited_roundtrip", oracle=with_sellout("SELECT regionid, product, yearweek, qty FROM sellout"))
def src_delimited_roundtrip(spark, sf_dir):
    """SRC-2 / SNK-4: a ``;``-separated file with a header, written and read back."""
    path = write_csv(sellout(spark, sf_dir), scratch_path(spark, "sellout-semi"), header=True, sep=";")
    return read_delimited(spark, path, schema=SELLOUT_SCHEMA, header=True)


@query("src_text_lines", oracle=with_sellout(
    "SELECT regionid || ',' || product || ',' || yearweek || ',' || CAST(qty AS VARCHAR) AS value FROM sellout"))
def src_text_lines(spark, sf_dir):
    """SNK-5 + SRC-3: CSV without a header, read back as plain text lines."""
    path = write_csv(sellout(spark, sf_dir), scratch_path(spark, "sellout-lines"), header=False)
    return read_text(spark, path)


@query("snk_text_to_csv", oracle=with_sellout(
    "SELECT regionid || ',' || product || ',' || yearweek || ',' || CAST(qty AS VARCHAR) AS value FROM sellout"))
def snk_text_to_csv(spark, sf_dir):
    """SRC-3 -> SNK-5: text lines (containing commas) written as a one-column CSV.

    The CSV sink quotes each line because it contains the separator; reading the CSV
    back with a one-column schema returns the original lines.
    """
    lines = sellout(spark, sf_dir).select(F.concat_ws(",", "regionid", "product", "yearweek",
                                                      F.col("qty").cast("string")).alias("value"))
    text_path = write_text(lines, scratch_path(spark, "sellout-text"))
    csv_path = write_csv(read_text(spark, text_path), scratch_path(spark, "text-csv"), header=False)
    return read_csv(spark, csv_path, schema="value string", header=False)


@query("snk_append_roundtrip", oracle=with_sellout("""
SELECT CASE WHEN yearweek < '199800' THEN 'a' ELSE 'b' END AS batch, regionid, product, yearweek, qty
FROM sellout"""))
def snk_append_roundtrip(spark, sf_dir):
    """SNK-7: two batches appended as CSV, the first one sent twice."""
    path = scratch_path(spark, "appended")
    early = F.col("yearweek") < "199800"
    for batch_id, part in (("a", early), ("b", ~early), ("a", early)):
        append_batch(sellout(spark, sf_dir).filter(part), path, batch_id, "csv", header="true")
    return read_csv(spark, path, schema="regionid string, product string, yearweek string,"
                                        " qty double, batch string", header=True)


@query("src_views", oracle=with_sellout(f"""
SELECT regionid, product, sum(qty) AS total, 'sellout_view' AS name, false AS created_again,
       true AS dropped FROM sellout WHERE product IN {P.PRODUCTS} GROUP BY regionid, product
"""))
def src_views(spark, sf_dir):
    """SRC-9/10/11: register a view, query it by name, find it there, drop it."""
    name = V.register(sellout(spark, sf_dir), "sellout_view")
    again = V.register_if_absent(spark, spark.range(1), name)
    rows = V.sql(spark, f"SELECT regionid, product, sum(qty) AS total FROM {name}"
                        " WHERE array_contains(:products, product) GROUP BY regionid, product",
                 products=F.array(*[F.lit(p) for p in P.PRODUCTS]))
    dropped = V.drop_view(spark, name)
    return rows.select("*", F.lit(name).alias("name"), F.lit(again).alias("created_again"),
                       F.lit(dropped).alias("dropped"))

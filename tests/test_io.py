"""Sources and sinks: CSV (`,` and `;`), text, JDBC through embedded in-memory Derby
(no network port), temp views and bound-parameter SQL."""

import os
import uuid

import pytest
from pyspark.sql import functions as F

from seasonflow.functions.schemas import SELLOUT_SCHEMA
from seasonflow.sources import readers, views, writers

DERBY_DRIVER = "org.apache.derby.iapi.jdbc.AutoloadedDriver"


def _sample(spark):
    return spark.createDataFrame(
        [("A01", "PRODUCT1", "201401", 10.0), ("A01", "PRODUCT2", "201402", 20.5),
         ("A02, x", 'say "hi"', "201403", None)], SELLOUT_SCHEMA)


def _path(scratch, name):
    return os.path.join(scratch, f"{name}-{uuid.uuid4().hex[:8]}")


def test_csv_roundtrip_with_header(spark, scratch):
    p = writers.write_csv(_sample(spark), _path(scratch, "csv"), header=True)
    back = readers.read_csv(spark, p, schema=SELLOUT_SCHEMA)
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, _sample(spark).collect()), key=str)
    untyped = readers.read_csv(spark, p)
    assert dict(untyped.dtypes)["qty"] == "string"


def test_delimited_semicolon_and_single_file(spark, scratch):
    p = writers.write_csv(_sample(spark), _path(scratch, "semi"), sep=";", single_file=True)
    parts = [f for f in os.listdir(p) if f.startswith("part-")]
    assert len(parts) == 1
    back = readers.read_delimited(spark, p, schema=SELLOUT_SCHEMA)
    assert back.count() == 3


def test_csv_without_header_and_append(spark, scratch):
    p = _path(scratch, "nohdr")
    writers.write_csv(_sample(spark), p, header=False)
    writers.write_csv(_sample(spark), p, header=False, mode="append")
    assert readers.read_csv(spark, p, schema=SELLOUT_SCHEMA, header=False).count() == 6


def test_text_lines(spark, scratch):
    p = _path(scratch, "txt")
    os.makedirs(p)
    with open(os.path.join(p, "a.txt"), "w") as fh:
        fh.write("# title\n\nline, with comma\n")
    df = readers.read_text(spark, p)
    assert df.columns == ["value"] and df.count() == 3


def test_jdbc_roundtrip_partitioned(spark):
    url = f"jdbc:derby:memory:sf{uuid.uuid4().hex[:8]};create=true"
    df = spark.range(200).select(F.col("id").alias("ID"), (F.col("id") * 1.5).alias("QTY"))
    writers.write_jdbc(df, url, "SELLOUT", driver=DERBY_DRIVER)
    back = readers.read_jdbc(spark, url, "SELLOUT", driver=DERBY_DRIVER, partition_column="ID",
                             lower_bound=0, upper_bound=200, num_partitions=4)
    assert back.rdd.getNumPartitions() == 4
    assert back.count() == 200
    filtered = back.filter(F.col("ID") < 10)
    assert "PushedFilters: [*IsNotNull(ID), *LessThan(ID,10)]" in filtered._jdf.queryExecution().executedPlan().toString()
    assert filtered.count() == 10
    writers.write_jdbc(df.limit(5), url, "SELLOUT", driver=DERBY_DRIVER, truncate=True)
    assert readers.read_jdbc(spark, url, "SELLOUT", driver=DERBY_DRIVER).count() == 5


def test_jdbc_parameter_table_drives_the_filter(spark):
    """SRC-8 + FLT-12: a parameter table read over JDBC filters the fact."""
    from seasonflow.operators.cleaning import parameter_filter

    url = f"jdbc:derby:memory:pt{uuid.uuid4().hex[:8]};create=true"
    rows = [("COMMON", "VALID_WEEK", "20", "Y"), ("COMMON", "VALID_YEAR", "2015", "Y"),
            ("COMMON", "VALID_PRODUCT", "A", "Y"), ("COMMON", "VALID_PRODUCT", "B", "N"),
            ("OTHER", "VALID_PRODUCT", "C", "Y")]
    params = spark.createDataFrame(
        rows, "param_category string, param_name string, param_value string, use_yn string")
    # Derby compares VARCHAR, not the CLOB that strings become by default
    writers.write_jdbc(params, url, "PARAMETERS", driver=DERBY_DRIVER, createTableColumnTypes=", ".join(
        f"{c} VARCHAR(40)" for c in params.columns))
    back = readers.read_jdbc(spark, url, "PARAMETERS", driver=DERBY_DRIVER)
    fact = spark.createDataFrame(
        [("A", "201510"), ("A", "201420"), ("A", "201520"), ("B", "201510"), ("C", "201510")],
        "product string, yearweek string")
    got = parameter_filter(fact, back.toDF(*[c.lower() for c in back.columns])).collect()
    assert [(r["product"], r["yearweek"]) for r in got] == [("A", "201510")]


def test_views_and_bound_sql(spark):
    df = _sample(spark)
    name = f"keydata_{uuid.uuid4().hex[:8]}"
    views.register(df, name)
    assert not views.register_if_absent(spark, df, name)
    out = views.sql(spark, f"SELECT count(*) AS n FROM {name} WHERE product IN (:a, :b)", a="PRODUCT1", b="PRODUCT2")
    assert out.first()["n"] == 2
    assert views.drop_view(spark, name)
    assert views.register_if_absent(spark, df, name)
    out = views.sql(spark, "SELECT count(*) AS n FROM {t} WHERE qty > :q", frames={"t": df}, q=15)
    assert out.first()["n"] == 1
    views.drop_view(spark, name)


def test_parquet_partitioned_output_prunes_on_read(spark, scratch):
    from conftest import SF_SMALL

    from seasonflow.plans import QUERIES
    from seasonflow.plans.inspect import plan_text

    idx = QUERIES["seasonality_index"](spark, SF_SMALL)
    p = writers.write_parquet(idx, _path(scratch, "index"), partition_by="REGIONID")
    back = readers.read_parquet(spark, p).filter(F.col("REGIONID") == "AFRICA")
    assert "PartitionFilters: [isnotnull(REGIONID" in plan_text(back)
    assert back.count() == idx.filter(F.col("REGIONID") == "AFRICA").count() > 0


def test_append_batch_may_be_sent_again(spark, scratch):
    from seasonflow.sources.writers import append_batch

    path = os.path.join(scratch, "appended")
    rows = spark.createDataFrame([(1, "a"), (2, None), (2, None)], "n int, t string")
    for batch_id in ("b1", "b2", "b1"):
        append_batch(rows, path, batch_id)
    got = spark.read.parquet(path)
    assert sorted((r.batch, r.n) for r in got.collect()) == [
        ("b1", 1), ("b1", 2), ("b1", 2), ("b2", 1), ("b2", 2), ("b2", 2)]
    append_batch(rows.limit(0), path, "b3")  # an empty batch adds nothing
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        append_batch(rows.withColumnRenamed("n", "batch"), path, "b4")

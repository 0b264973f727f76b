"""Positions, blocks with halos, chunked nesting and folds without a window over a group."""

import math
import random
from fractions import Fraction

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from conftest import SF_SMALL

from seasonflow.operators import groupstats as G
from seasonflow.operators import numbering as N
from seasonflow.operators import seasonality as S
from seasonflow.plans import QUERIES
from seasonflow.plans.inspect import count_nodes, plan_text

SCHEMA = "regionid string, product string, yearweek string, qty double"


def series_rows(n, seed=1, keys=(("A", "x"), ("A", "y"), (None, "x"))):
    rng = random.Random(seed)
    return [(*rng.choice(keys), str(199801 + rng.randint(0, 30)), float(rng.randint(0, 20)))
            for _ in range(n)]


def test_positions_are_the_sort_order(spark):
    rows = [(i % 7, None if i % 11 == 0 else i % 5) for i in range(1000)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(5)
    got = N.with_position(df, "a", F.desc_nulls_last("b")).collect()
    assert sorted(r.pos for r in got) == list(range(1000))
    order = [(r.a, r.b is None, -(r.b or 0)) for r in sorted(got, key=lambda r: r.pos)]
    assert order == sorted(order)


def test_positions_of_an_empty_table_and_of_one_hot_value(spark):
    assert N.with_position(spark.createDataFrame([], "a int"), "a").collect() == []
    hot = spark.range(20_000).select(F.lit(1).alias("a"))
    got = N.with_position(hot, "a").select("pos", F.spark_partition_id().alias("p"))
    assert got.agg(F.count_distinct("pos"), F.max("pos")).first() == (20_000, 19_999)


def test_equal_values_are_split_over_partitions(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        hot = spark.range(20_000, numPartitions=4).select(F.lit(1).alias("a"))
        placed = N.with_position(hot, "a")
        files = {r[0] for r in placed.select(F.input_file_name()).distinct().collect()}
        assert len(files) >= 6
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")


def test_no_window_over_everything(spark):
    for name in ("srt_position", "win_ma_blocked", "agg_nested_chunks", "agg_fold"):
        text = plan_text(QUERIES[name](spark, SF_SMALL))
        assert "SinglePartition" not in text, name
    assert count_nodes(QUERIES["srt_position"](spark, SF_SMALL), "Window") == 0
    assert count_nodes(QUERIES["agg_fold"](spark, SF_SMALL), "Window") == 0


def test_group_positions_keep_null_keys(spark):
    rows = series_rows(600)
    df = spark.createDataFrame(rows, SCHEMA)
    got = N.with_group_position(df, S.SERIES_KEYS, "yearweek", "qty", size="n").collect()
    for key in {r[:2] for r in rows}:
        own = sorted((r for r in got if (r.regionid, r["product"]) == key), key=lambda r: r.idx)
        assert [r.idx for r in own] == list(range(len(own)))
        assert {r.n for r in own} == {len(own)}
        assert [(r.yearweek, r.qty) for r in own] == sorted((r.yearweek, r.qty) for r in own)


@pytest.mark.parametrize("order", [3, 4, 17, 24])
@pytest.mark.parametrize("block_rows", [1, 13, 4096])
def test_blocked_average_equals_the_window(spark, order, block_rows):
    df = spark.createDataFrame(series_rows(300), SCHEMA)
    plain = df.select("*", S.row_index().alias("idx"), S.centred_ma(order=order).alias("ma"))
    got = S.moving_average_blocked(df, order, block_rows=block_rows)
    assert sorted(map(str, got.collect())) == sorted(map(str, plain.collect()))


def test_one_long_series_is_many_tasks(spark):
    n = 1_000_000
    df = spark.range(n).select(
        F.lit("A").alias("regionid"), F.lit("x").alias("product"),
        (F.lit(199801) + F.col("id") % 52).cast("string").alias("yearweek"),
        (F.xxhash64("id") % 100).cast("double").alias("qty"))
    conf = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(conf, "false")  # small partitions would be put together
    try:
        got = S.moving_average_blocked(df, 17).withColumn("task", F.spark_partition_id())
        rows, tasks, total = got.agg(F.count("*"), F.count_distinct("task"), F.sum("ma")).first()
        largest = got.groupBy("task").count().agg(F.max("count")).first()[0]
    finally:
        spark.conf.unset(conf)
    w = Window.partitionBy("regionid").orderBy("yearweek", "qty").rowsBetween(-8, 8)
    expected = df.select(F.avg("qty").over(w).alias("ma")).agg(F.sum("ma")).first()[0]
    assert (rows, tasks >= 8, largest < n / 4) == (n, True, True)
    assert math.isclose(total, expected, rel_tol=1e-9)


def test_blocked_policies_for_short_series(spark):
    rows = [("A", "x", str(199801 + i), float(i)) for i in range(5)] + [("B", "x", "199801", 1.0)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert S.moving_average_blocked(df, 4, short_series="drop").count() == 5
    assert S.moving_average_blocked(df, 4, short_series="truncate").count() == 6
    with pytest.raises(Exception, match="series shorter"):
        S.moving_average_blocked(df, 4).collect()
    with pytest.raises(ValueError):
        S.moving_average_blocked(df, 2)


def test_precondition_counts_both_kinds_in_one_pass(spark):
    rows = [("A", "x", str(199801 + i), 1.0) for i in range(9)] + [(None, "x", "199801", 1.0)] * 3
    df = spark.createDataFrame(rows, SCHEMA)
    checked, seen = S.precondition(df, 4)
    assert {(r.regionid, r["product"], r.n, r.accepted) for r in checked.collect()} == {
        ("A", "x", 9, True), (None, "x", 3, False)}
    assert seen.get == {"accepted_series": 1, "rejected_series": 1, "accepted_rows": 9,
                        "rejected_rows": 3}
    good, bad = S.accepted_rows(df, checked)
    assert (good.count(), bad.count()) == (9, 3)


def test_chunks_are_bounded_and_whole(spark):
    rows = series_rows(1000, keys=(("A", "x"),) * 9 + (("B", None),))
    df = spark.createDataFrame(rows, SCHEMA)
    got = G.nested_chunks(df, S.SERIES_KEYS, ["yearweek", "qty"], ["yearweek", "qty"], 64,
                          ("size", "average")).collect()
    for key in {r[:2] for r in rows}:
        own = sorted((r for r in got if (r.regionid, r["product"]) == key), key=lambda r: r.chunk)
        expected = sorted(r[2:] for r in rows if r[:2] == key)
        assert [tuple(x) for r in own for x in r.records] == expected
        assert all(len(r.records) == 64 for r in own[:-1]) and len(own[-1].records) <= 64
        assert {r.size for r in own} == {len(expected)}
        assert math.isclose(own[0].average, sum(x[1] for x in expected) / len(expected))


def test_folds_of_zeros_signs_and_nulls(spark):
    groups = {
        "plain": [2.0, 3.0, 4.0], "negative": [-2.0, 3.0, -4.0, -0.5], "zero": [5.0, 0.0, -1.0],
        "leading zero": [0.0, 3.0, -4.0], "two zeros": [0.0, 0.0, 2.0], "null": [None, 6.0, 2.0],
        "all null": [None, None], "one": [-7.0],
    }
    rows = [(k, i, v) for k, values in groups.items() for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "k string, i int, v double").repartition(3)
    got = {r.k: r for r in G.fold_groups(df, "k", "v", ["i"]).collect()}
    for k, values in groups.items():
        found = [Fraction(v) for v in values if v is not None]
        r = got[k]
        if not found:
            assert r.folded_sum is r.folded_product is r.folded_ratio is None
            continue
        assert math.isclose(r.folded_sum, sum(found))
        assert math.isclose(r.folded_product, math.prod(found), rel_tol=1e-12)
        if 0 in found[1:]:
            assert r.folded_ratio is None
        else:
            assert math.isclose(r.folded_ratio, found[0] / math.prod(found[1:]), rel_tol=1e-12)


def test_products_beyond_doubles_keep_sign_and_magnitude(spark):
    df = spark.range(4001).select(F.lit("a").alias("k"), F.lit(-1e300).alias("v"))
    r = G.fold_groups(df, "k", "v").first()
    assert r.folded_product == -math.inf and r.negatives == 4001
    assert math.isclose(r.ln_magnitude, 4001 * 300 * math.log(10), rel_tol=1e-9)

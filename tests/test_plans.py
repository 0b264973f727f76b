"""Plan checks: pushdown, pruning, shuffle count, no Python in any catalogue plan."""

import pytest

from conftest import SF_SMALL

from seasonflow.operators import cleaning as C
from seasonflow.operators import seasonality as S
from seasonflow.plans import QUERIES
from seasonflow.plans.inspect import count_nodes, plan_text, pushed_filters
from seasonflow.sources.tables import table

NO_ML = sorted(q for q in QUERIES if not q.startswith("ml_"))


@pytest.mark.parametrize("name", NO_ML)
def test_plan_is_jvm_side_and_pruned(spark, name):
    """No Python evaluation in any plan; outside the `a.*` star joins, every plan
    reads at most four of lineitem's eleven columns."""
    import re

    text = plan_text(QUERIES[name](spark, SF_SMALL))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas|MapInPandas", text)
    if not name.endswith("_star"):
        for block in text.split("\n\n"):
            if "lineitem.parquet" in block:
                schema = re.search(r"ReadSchema: struct<(.*)>", block).group(1)
                assert len(schema.split(",")) <= 4, (name, schema)


def test_filters_and_columns_reach_the_scan(spark):
    df = C.in_set(table(spark, SF_SMALL, "part", "p_partkey", "p_type", "p_size")
                  .withColumnRenamed("p_type", "product"), ["PROMO", "SMALL"])
    df = df.filter("p_size <= 25").select("p_partkey")
    text = plan_text(df)
    pushed = " ".join(pushed_filters(df))
    assert "In(p_type" in pushed and "LessThanOrEqual(p_size,25)" in pushed
    assert "ReadSchema: struct<p_partkey:bigint,p_type:string,p_size:int>" in text


def test_seasonality_index_single_shuffle_after_series(spark):
    rows = [("R", "P", f"20{y:02d}{w:02d}", float(w)) for y in range(14, 17) for w in range(1, 53)]
    df = spark.createDataFrame(rows, "regionid string, product string, yearweek string, qty double")
    idx = S.seasonality_index(S.seasonal_ratio(S.moving_average(S.series(df), order=17)))
    # one exchange for the (partial -> final) series aggregation, one for the window;
    # the index aggregation reuses the window's (regionid, product) partitioning
    assert count_nodes(idx, "Exchange") == 2
    tree = [ln.strip(" +-:") for ln in plan_text(idx).split("\n\n\n")[0].splitlines()]
    top = [ln.split(" (")[0] for ln in tree[2:8]]
    assert top[:2] == ["HashAggregate", "HashAggregate"] and "Window" in top


def test_sellout_aggregates_before_its_shuffle(spark):
    from seasonflow.sources.tables import sellout

    tree = plan_text(sellout(spark, SF_SMALL)).split("\n\n\n")[0]
    top = tree.splitlines()[:5]
    assert "HashAggregate" in top[2] and "Exchange" in top[3] and "HashAggregate" in top[4]


def test_lookup_broadcast_is_asked_for(spark):
    from seasonflow.operators.joins import lookup_join

    fact = table(spark, SF_SMALL, "lineitem", "l_partkey")
    dim = table(spark, SF_SMALL, "part", "p_partkey").withColumnRenamed("p_partkey", "l_partkey")
    assert count_nodes(lookup_join(fact, dim, "l_partkey", "inner", True), "BroadcastExchange") == 1
    assert count_nodes(lookup_join(fact, dim, "l_partkey", "inner"), "BroadcastExchange") == 0


def test_hot_key_is_not_one_task(spark):
    """A key holding a third of all rows: AQE sees that the aggregate is small
    and broadcasts it, so the rows are not joined (or windowed) by key."""
    from pyspark.sql import functions as F

    from seasonflow.operators import groupstats as G

    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") % 997).cast("string")).alias("regionid"),
        F.lit("P").alias("product"), (F.col("id") % 50).cast("double").alias("qty"))
    out = G.stretch_stats(df, ["regionid", "product"], stats=("size", "average"))
    assert len(out.collect()) == n
    assert "BroadcastHashJoin" in plan_text(out).split("== Initial Plan ==")[0]
    assert count_nodes(out, "Window") == 0
    hot = out.filter("regionid = 'HOT'").first()
    assert hot["size"] == n // 3


def test_bucketed_series_table_needs_no_shuffle(spark, scratch):
    import os
    import uuid

    from seasonflow.sources.tables import sellout
    from seasonflow.sources.writers import save_bucketed

    name = f"series_{uuid.uuid4().hex[:8]}"
    save_bucketed(sellout(spark, SF_SMALL), name, 4, path=os.path.join(scratch, name))
    t = spark.table(name)
    idx = S.seasonality_index(S.seasonal_ratio(S.moving_average(S.series(t), order=17)))
    assert count_nodes(idx, "Exchange") == 0
    assert idx.count() == S.seasonality_index(S.seasonal_ratio(
        S.moving_average(S.series(sellout(spark, SF_SMALL)), order=17))).count()
    spark.sql(f"DROP TABLE {name}")


def test_beyond_the_bound_hot_key_is_split_by_aqe(spark):
    """When the lookup is not known to be small, the shuffle join runs with AQE's skew
    handling: the partition of a key holding a third of the rows is split."""
    from pyspark.sql import functions as F

    from seasonflow.operators.joins import lookup_join

    conf = {"spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1k",
            "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
            "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
            "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        n = 300000
        fact = spark.range(n).select(
            F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000).alias("k"),
            F.col("id").alias("v"))
        dim = spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
        joined = lookup_join(fact, dim, "k", "inner")
        assert count_nodes(joined, "BroadcastExchange") == 0
        rows = joined.collect()
        assert len(rows) == n
        assert "SortMergeJoin(skew=true)" in plan_text(joined)
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)


def test_broadcast_is_bounded_in_measured_bytes(spark):
    """Few rows with long strings are not broadcast, however well they compress."""
    from pyspark.sql import functions as F

    from seasonflow.operators.joins import fits, lookup_join, measure

    narrow = spark.range(1000).selectExpr("id AS k", "'x' AS name")
    long = spark.range(5000).select(F.col("id").alias("k"), F.repeat(F.lit("x"), 20_000).alias("name"))
    assert measure(narrow).bytes == 1000 * (16 + 8 + 1) and fits(measure(narrow))
    assert measure(long).bytes > 64 * 1024 * 1024 and not fits(measure(long))
    assert measure(spark.range(300_000)) is None and not fits(None)
    nested = spark.range(10).select(F.array_repeat(F.lit("abc"), 1000).alias("a"))
    assert measure(nested).bytes > 10 * 3000
    joined = lookup_join(narrow, long, "k", "left", fits(measure(long)))
    assert count_nodes(joined, "BroadcastExchange") == 0
    joined = lookup_join(long, narrow, "k", "left", fits(measure(narrow)))
    assert count_nodes(joined, "BroadcastExchange") == 1


@pytest.mark.parametrize("name, low, high", [
    ("flt_yearweek_between", "1997-12-29", "2001-01-01"), ("ml_input", "1997-12-29", "2001-01-01"),
    ("ml_split", "1997-12-29", "2001-01-01"), ("flt_year_week_sql", "2000-01-03", None),
    ("prj_positional", "2000-01-03", None)])
def test_yearweek_bounds_reach_the_scan_of_orders(spark, name, low, high):
    pushed = " ".join(pushed_filters(QUERIES[name](spark, SF_SMALL)))
    assert f"GreaterThanOrEqual(o_orderdate,{low}T00:00" in pushed
    assert (f"LessThan(o_orderdate,{high}T00:00" in pushed) == (high is not None)


def test_week_dates_cover_iso_years():
    from datetime import date

    from seasonflow.functions.yearweek import week_dates

    assert week_dates("199801", "200052") == (date(1997, 12, 29), date(2001, 1, 1))
    assert week_dates("202053", "202053") == (date(2020, 12, 28), date(2021, 1, 4))
    assert week_dates(None, None) == (None, None)


def test_product_filter_is_below_the_lineitem_exchange(spark):
    """The part lookup and the product filter come before line items are shuffled."""
    tree = plan_text(QUERIES["flt_product_set"](spark, SF_SMALL)).split("\n\n\n")[0]
    lines = [ln for ln in tree.splitlines() if "(" in ln]
    at = next(i for i, ln in enumerate(lines) if "SortMergeJoin" in ln)
    below = [ln.split("(")[0].strip(" +-:*") for ln in lines[at + 1:]]
    first_exchange = next(i for i, n in enumerate(below) if n.startswith("Exchange"))
    assert "BroadcastHashJoin" in " ".join(below[first_exchange:first_exchange + 5])


def test_building_a_query_again_starts_no_job(spark):
    """Base tables are measured once; after that a sell-out query is only a plan."""
    tracker = spark.sparkContext.statusTracker()
    names = ["seasonality_index", "flt_param_driven", "prj_rawdata", "join_left_star",
             "join_left_region"]
    for name in names:
        QUERIES[name](spark, SF_SMALL)
    spark.sparkContext.setJobGroup("again", "")
    try:
        for name in names:
            QUERIES[name](spark, SF_SMALL)
        assert list(tracker.getJobIdsForGroup("again")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_sorted_results_are_sorted(spark):
    got = [tuple(r) for r in QUERIES["srt_yearweek"](spark, SF_SMALL).select(
        "yearweek", "regionid", "product").collect()]
    assert got == sorted(got) and len(got) > 100
    got = [tuple(r) for r in QUERIES["ml_lr"](spark, SF_SMALL).select(
        "yearweek", "regionid", "product").collect()]
    assert got == sorted(got) and len(got) > 10


def test_a_table_that_changes_is_measured_again(spark, scratch):
    import os

    from seasonflow.operators.joins import measure_once

    path = os.path.join(scratch, "grows")
    spark.range(5).write.parquet(path)
    read = lambda: spark.read.parquet(path)
    assert measure_once(read(), path, "t").rows == 5
    spark.range(7).write.mode("append").parquet(path)
    assert measure_once(read(), path, "t").rows == 12
    spark.range(300_000).write.mode("overwrite").parquet(path)
    assert measure_once(read(), path, "t") is None

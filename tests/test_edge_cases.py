"""Edge cases on small literal DataFrames (the driver tables have none of these)."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from seasonflow.functions.rounding import round_half_up
from seasonflow.functions.schemas import column_index, impose_schema, lower_columns, positional, require_columns
from seasonflow.functions.schemas import SELLOUT_SCHEMA
from seasonflow.functions.yearweek import week_of, year_of
from seasonflow.operators import cleaning as C
from seasonflow.operators import enrich as E
from seasonflow.operators import groupstats as G
from seasonflow.operators import reshape as R
from seasonflow.operators import seasonality as S

SCHEMA = "regionid string, product string, yearweek string, qty double"


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_cap_keeps_null_and_caps_above(spark):
    df = frame(spark, [("A", "P", "201401", None), ("A", "P", "201402", 800000.0),
                       ("A", "P", "201403", 700000.0)])
    got = {r["yearweek"]: r["qty"] for r in C.cap(df, C.REFERENCE_CAP).collect()}
    assert got == {"201401": None, "201402": 700000.0, "201403": 700000.0}


def test_cap_leaves_nan(spark):
    df = frame(spark, [("A", "P", "201401", float("nan"))])
    assert str(C.cap(df, 300).first()["qty"]) == "nan"


def test_cap_keep_original(spark):
    df = frame(spark, [("A", "P", "201401", 900.0)])
    r = C.cap_keep_original(df, 300).first()
    assert (r["qty"], r["original_qty"]) == (300.0, 900.0)


def test_week_filters(spark):
    df = frame(spark, [("A", "P", "201453", 1.0), ("A", "P", "201452", 1.0),
                       ("A", "P", "20141", 1.0), ("A", "P", "2014xx", 1.0)])
    # substring(4) of a 5-character value is "1": only the length rule (FLT-1) drops it
    assert sorted(r["yearweek"] for r in C.drop_late_weeks(df).collect()) == ["20141", "201452"]
    assert sorted(r["yearweek"] for r in C.drop_late_weeks(C.valid_yearweek(df)).collect()) == ["201452"]
    assert C.valid_yearweek(df).count() == 3


def test_yearweek_parts_tolerate_garbage(spark):
    r = spark.createDataFrame([("2014xx",)], "yearweek string").select(
        year_of("yearweek").alias("y"), week_of("yearweek").alias("w")).first()
    assert (r["y"], r["w"]) == (2014, None)


def test_precedence_second_product_skips_year_test(spark):
    df = frame(spark, [("A", "P1", "201053", 1.0), ("A", "P2", "201053", 1.0),
                       ("A", "P1", "201652", 1.0)])
    got = sorted((r["product"], r["yearweek"]) for r in
                 C.precedence_filter(df, 2016, 53, "P1", "P2").collect())
    assert got == [("P1", "201652"), ("P2", "201053")]


def test_in_set_equals_or_form(spark):
    df = frame(spark, [("A", p, "201401", 1.0) for p in ["P1", "P2", "P3"]])
    a = sorted(r["product"] for r in C.in_set(df, ["P1", "P2"]).collect())
    b = sorted(r["product"] for r in C.any_equal(df, ["P1", "P2"]).collect())
    assert a == b == ["P1", "P2"]
    assert C.any_equal(df, []).count() == 0


def _params(spark, rows):
    return spark.createDataFrame(rows, "param_category string, param_name string, param_value string, use_yn string")


def test_parameter_filter_defaults_and_empty_product_list(spark):
    df = frame(spark, [("A", "P1", "201652", 1.0), ("A", "P1", "201553", 1.0)])
    no_products = _params(spark, [("COMMON", "VALID_WEEK", "53", "Y")])
    assert C.parameter_filter(df, no_products).count() == 0
    with_products = _params(spark, [("COMMON", "VALID_PRODUCT", "P1", "Y"),
                                    ("COMMON", "VALID_PRODUCT", "P2", "N")])
    # defaults: week < 53, year >= 2016
    got = [r["yearweek"] for r in C.parameter_filter(df, with_products).collect()]
    assert got == ["201652"]


def test_key_with_underscore_and_null(spark):
    df = spark.createDataFrame([("A_1", "P"), (None, "P")], "regionid string, product string")
    got = [r["k"] for r in df.select(G.key_column().alias("k")).collect()]
    assert got == ["A_1_P", None]


def test_stats_single_row_group_and_zero_mean(spark):
    df = frame(spark, [("A", "P", "201401", 5.0), ("B", "P", "201401", 0.0), ("B", "P", "201402", 0.0)])
    got = {r["regionid"]: r for r in G.group_stats(df, ["regionid", "product"]).collect()}
    assert got["A"]["size"] == 1 and got["A"]["stddev"] is None
    assert got["B"]["average"] == 0.0 and got["B"]["dispersion"] is None
    ratios = {r["regionid"]: r["ratio"] for r in G.ratio_to_mean(df, ["regionid", "product"]).collect()}
    assert ratios["A"] == 1.0 and ratios["B"] is None


def test_dispersion_formula(spark):
    vals = [1.0, 2.0, 3.0, 6.0]
    df = frame(spark, [("A", "P", f"2014{i:02d}", v) for i, v in enumerate(vals, 1)])
    mean = sum(vals) / len(vals)
    want = (sum((v - mean) ** 2 for v in vals) / mean) ** 0.5
    got = G.group_stats(df, ["regionid", "product"], stats=("dispersion",)).first()["dispersion"]
    assert got == pytest.approx(want)


def test_series_sums_duplicate_weeks(spark):
    df = frame(spark, [("A", "P", "201401", 1.0), ("A", "P", "201401", 2.0), ("A", "P", "201402", 4.0)])
    got = {r["yearweek"]: r["qty"] for r in S.series(df).collect()}
    assert got == {"201401": 3.0, "201402": 4.0}
    assert S.series(df, duplicates="keep").count() == 3


def test_short_series_policies(spark):
    df = frame(spark, [("A", "P", f"2014{i:02d}", float(i)) for i in range(1, 6)]
               + [("B", "P", f"2014{i:02d}", float(i)) for i in range(1, 20)])
    with pytest.raises(PySparkException):
        S.moving_average(df, order=17).collect()
    assert S.moving_average(df, order=17, short_series="drop").count() == 19
    assert S.moving_average(df, order=17, short_series="truncate").count() == 24


def test_ratio_zero_ma_is_one(spark):
    df = spark.createDataFrame([(0.0, 0.0), (4.0, 2.0)], "qty double, ma double")
    assert [r["ratio"] for r in S.seasonal_ratio(df).collect()] == [1.0, 2.0]


def test_round_half_up_negative_halves(spark):
    df = spark.createDataFrame([(-2.5,), (2.5,), (-0.25,), (15.125222,)], "x double")
    got = [r["r0"] for r in df.select(round_half_up("x", 0).alias("r0")).collect()]
    assert got == [-2.0, 3.0, -0.0, 15.0]
    assert df.select(round_half_up("x", 2).alias("r")).collect()[3]["r"] == 15.13


def test_share_residual_sums_to_total(spark):
    # three equal shares round to 33.33 each: the first item gets the missing 0.01
    df = spark.createDataFrame([("g", "x", 7.0), ("g", "y", 7.0), ("g", "z", 7.0)],
                               "grp string, item string, v double")
    got = {r["item"]: r["share"] for r in R.shares_with_residual(df, "grp", "item", "v").collect()}
    assert got["x"] == pytest.approx(33.34) and got["y"] == got["z"] == 33.33


def test_shares_of_awkward_groups(spark):
    rows = [(None, "a", 1.0), (None, "b", 3.0), ("zero", "a", 0.0), ("zero", "b", 0.0),
            ("twice", "a", 1.0), ("twice", "a", 1.0), ("twice", "b", 4.0)]
    df = spark.createDataFrame(rows, "grp string, item string, v double")
    got = {(r["grp"], r["item"]): r["share"]
           for r in R.shares_with_residual(df, "grp", "item", "v").collect()}
    assert got[None, "a"] == 25.0 and got[None, "b"] == 75.0
    assert got["zero", "a"] is None and got["zero", "b"] is None
    assert got["twice", "a"] == pytest.approx(33.33) and got["twice", "b"] == pytest.approx(66.67)
    assert len(got) == 6


def test_stretched_statistics_keep_null_keys(spark):
    from seasonflow.operators import groupstats as G

    rows = [(None, "p", 1.0), (None, "p", 3.0), ("r", None, 5.0), ("r", "p", 7.0)]
    df = spark.createDataFrame(rows, "regionid string, product string, qty double")
    got = G.stretch_stats(df, ["regionid", "product"], stats=("size", "average")).collect()
    assert sorted((r["qty"], r["size"], r["average"]) for r in got) == [
        (1.0, 2, 2.0), (3.0, 2, 2.0), (5.0, 1, 5.0), (7.0, 1, 7.0)]
    assert G.ratio_to_mean(df, ["regionid", "product"]).count() == 4


def test_joins_left_and_inner_differ_on_unmatched_rows(spark):
    fact = spark.createDataFrame([("A", 1.0), ("B", 2.0), (None, 3.0)], "product string, qty double")
    master = spark.createDataFrame([("A", "Name A"), ("C", "Name C")],
                                   "product_id string, product_name string")
    left = E.with_product_name(fact, master, "left").collect()
    inner = E.with_product_name(fact, master, "inner").collect()
    assert {(r["product"], r["productname"]) for r in left} == {("A", "Name A"), ("B", None), (None, None)}
    assert [(r["product"], r["productname"]) for r in inner] == [("A", "Name A")]


def test_grade_tiers(spark):
    df = spark.createDataFrame([(10.0,), (9.0,), (8.5,), (1.0,)], "score double")
    got = [r["g"] for r in df.select(E.grade("score", 9, 8).alias("g")).collect()]
    assert got == list(E.GRADE_LABELS[:1]) + [E.GRADE_LABELS[1]] * 2 + [E.GRADE_LABELS[2]]


def test_flags_null_is_zero(spark):
    df = spark.createDataFrame([("Y",), ("N",), (None,)], "promotion string")
    assert [r["c"] for r in df.select(E.yn_flag("promotion").alias("c")).collect()] == [1, 0, 0]


def test_schema_helpers(spark):
    df = spark.createDataFrame([("A", "P", "201401", "3")], "REGIONID string, Product string, yearweek string, qty string")
    assert column_index(df, "product") == -1
    assert column_index(df, "product", case_insensitive=True) == 1
    assert lower_columns(df).columns == ["regionid", "product", "yearweek", "qty"]
    typed = impose_schema(df, SELLOUT_SCHEMA)
    assert typed.schema == SELLOUT_SCHEMA and typed.first()["qty"] == 3.0
    assert positional(df, "REGIONID", "Product").columns == ["_1", "_2"]
    with pytest.raises(ValueError):
        require_columns(df, "missing")


def test_unpivot_equals_union(spark):
    df = spark.createDataFrame([("A", 1.0, 1.5), ("B", 2.0, None)], "k string, real double, pred double")
    u = sorted(map(tuple, R.measures_union(df, ["k"], "real", "pred").collect()), key=str)
    p = sorted(map(tuple, R.measures_unpivot(df, ["k"], "real", "pred").collect()), key=str)
    assert u == p and len(u) == 4


def test_top_k_total_order(spark):
    df = spark.createDataFrame([(i, float(i % 3)) for i in range(20)], "id int, v double")
    got = [r["id"] for r in R.top_k(df, 3, "v", ["id"]).collect()]
    assert got == [2, 5, 8]


def test_array_functions(spark):
    from seasonflow.functions import arrays as A

    df = spark.createDataFrame([([10, 7, 20, 31, 40], [5.0, 15.0, 25.0])],
                               "ints array<int>, prices array<double>")
    texts = F.transform("ints", lambda x: x.cast("string"))
    r = df.select(A.keep_last_digit_zero("ints").alias("f"), A.discounted("prices", 0.2).alias("d"),
                  A.reduce_sum("prices").alias("s"), A.reduce_max("ints").alias("m"),
                  A.fold_concat(texts).alias("c"), A.fold_concat(texts, "-").alias("c2"),
                  A.as_set_contains("ints", F.lit(31)).alias("has"),
                  A.join_split("ints").alias("js")).first()
    assert r["f"] == [10, 20, 40] and r["d"] == [4.0, 12.0, 20.0]
    assert r["s"] == 45.0 and r["m"] == 40
    assert r["c"] == "107203140" and r["c2"] == "10-7-20-31-40" and r["has"] is True
    assert r["js"] == ["10", "7", "20", "31", "40"]
    p = df.select(A.reduce_product("prices").alias("p"),
                  A.fold("ints", F.lit(0), lambda a, b: a - b).alias("m")).first()
    assert p["p"] == 1875.0 and p["m"] == -108


def test_array_functions_on_empty_and_short_arrays(spark):
    from seasonflow.functions import arrays as A

    df = spark.createDataFrame([([],), ([4.0],), ([4.0, 8.0],), ([1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0],)],
                               "a array<double>")
    got = df.select(A.reduce_max("a").alias("m"), A.edged_means("a", 3).alias("e"),
                    A.fold_concat(F.transform("a", lambda x: x.cast("int").cast("string")), ",").alias("c"),
                    A.zipped(x="a", y=A.edged_means("a", 3)).alias("z")).collect()
    assert [r["m"] for r in got] == [None, 4.0, 8.0, 7.0]
    assert [r["e"] for r in got] == [[], [4.0], [6.0, 6.0], [2.5, 3.0, 3.5, 4.0, 4.5, 5.0, 5.5]]
    assert [r["c"] for r in got] == ["", "4", "4,8", "1,2,3,4,5,6,7"]
    assert [(z["x"], z["y"]) for z in got[2]["z"]] == [(4.0, 6.0), (8.0, 6.0)]


def test_recommended_conf_sizes_partitions():
    from seasonflow.session import recommended_conf, shuffle_partitions_for

    assert shuffle_partitions_for(20 * 1024 ** 4) == 81920
    conf = recommended_conf(shuffle_bytes=20 * 1024 ** 4)
    assert conf["spark.sql.shuffle.partitions"] == "81920"
    assert conf["spark.sql.autoBroadcastJoinThreshold"] == "-1"
    assert recommended_conf(shuffle_partitions=8)["spark.sql.shuffle.partitions"] == "8"


def test_parameter_lookup_is_one_bounded_row(spark):
    rows = [("COMMON", "VALID_WEEK", "53", "Y"), ("COMMON", "VALID_WEEK", "50", "Y"),
            ("COMMON", "VALID_WEEK", "1", "N"), ("COMMON", "VALID_YEAR", "bad", "Y"),
            ("OTHER", "VALID_YEAR", "1999", "Y"), (None, "VALID_YEAR", None, None)]
    rows += [("COMMON", "VALID_PRODUCT", str(i), "Y") for i in range(500)]
    params = spark.createDataFrame(
        rows, "param_category string, param_name string, param_value string, use_yn string")
    assert C.parameter_lookup(params, ("VALID_WEEK", "VALID_YEAR")).collect() == [({"VALID_WEEK": 50},)]
    assert C.parameter_lookup(params.limit(0), ("VALID_WEEK",)).collect() == [({},)]

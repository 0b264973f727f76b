"""ML: seeded determinism, metric formula vs RegressionEvaluator, tree description."""

import pytest
from pyspark.ml.evaluation import RegressionEvaluator

from conftest import SF_SMALL

from seasonflow.operators import forecast as M
from seasonflow.plans import params as P
from seasonflow.plans.forecasting import _input


@pytest.fixture(scope="module")
def split(spark):
    inp = _input(spark, SF_SMALL).cache()
    return M.time_split(inp, P.SPLIT_YEARWEEK)


def test_split_is_complementary(spark, split):
    train, test = split
    full = _input(spark, SF_SMALL)
    assert train.count() + test.count() == full.count()


def test_split_label_matches_filters(spark, split):
    train, test = split
    labelled = M.split_label(_input(spark, SF_SMALL), P.SPLIT_YEARWEEK)
    got = {r["split"]: r["n"] for r in labelled.groupBy("split").agg({"*": "count"})
           .withColumnRenamed("count(1)", "n").collect()}
    assert got == {"train": train.count(), "test": test.count()}


@pytest.mark.parametrize("kind", M.MODELS)
def test_seeded_models_repeat(spark, split, kind):
    train, test = split
    a = [r["prediction"] for r in M.predict(M.fit(train, kind), test).collect()]
    b = [r["prediction"] for r in M.predict(M.fit(train, kind), test).collect()]
    assert a == b and len(a) == test.count()


def test_metrics_equal_evaluator(spark, split):
    train, test = split
    pred = M.fit(train, "decision_tree").transform(test)
    m = M.error_metrics(pred).first()
    ev = RegressionEvaluator(labelCol="qty", predictionCol="prediction")
    assert m["rmse"] == pytest.approx(ev.setMetricName("rmse").evaluate(pred), rel=1e-9)
    assert m["mae"] == pytest.approx(ev.setMetricName("mae").evaluate(pred), rel=1e-9)


def test_tree_description(spark, split):
    train, _ = split
    assert "DecisionTreeRegressionModel" in M.tree_description(M.fit(train, "decision_tree"))


def test_compare_has_three_models(spark, split):
    train, test = split
    rows = M.compare(train, test).collect()
    assert sorted(r["model"] for r in rows) == sorted(M.MODELS)


def test_long_table_written_over_jdbc(spark, split):
    import uuid

    from seasonflow.sources import readers, writers

    train, test = split
    long = M.actual_vs_predicted(M.predict(M.fit(train, "decision_tree"), test))
    assert long.columns == ["MEASURE", "REGIONID", "PRODUCT", "YEARWEEK", "SALES"]
    url = f"jdbc:derby:memory:ml{uuid.uuid4().hex[:8]};create=true"
    driver = "org.apache.derby.iapi.jdbc.AutoloadedDriver"
    writers.write_jdbc(long, url, "DT_RESULT_FINAL", driver=driver)
    back = readers.read_jdbc(spark, url, "DT_RESULT_FINAL", driver=driver)
    counts = {r["MEASURE"]: r["n"] for r in back.groupBy("MEASURE").count().withColumnRenamed("count", "n").collect()}
    assert counts == {"REAL-QTY": test.count(), "PREDICTION-QTY": test.count()}


@pytest.mark.parametrize("kind,params", [("decision_tree", {}), ("random_forest", {"numTrees": 5}),
                                         ("decision_tree", {"maxDepth": 0})])
def test_walking_the_node_table_gives_the_predictions(spark, split, kind, params):
    train, test = split
    model = M.fit(train, kind, **params)
    fitted = model.stages[-1]
    nodes = M.tree_nodes(model)
    trees = getattr(fitted, "trees", [fitted])
    assert nodes.count() == sum(t.numNodes for t in trees)
    walked = M.walk(nodes, test, max(t.depth for t in trees))
    order = ["regionid", "product", "yearweek"]
    got = [r.prediction for r in walked.orderBy(*order).collect()]
    expected = [r.prediction for r in model.transform(test).orderBy(*order).collect()]
    assert got == pytest.approx(expected, rel=1e-12) and len(got) > 10


def test_node_table_of_a_tree(spark, split):
    nodes = {r.node: r for r in M.tree_nodes(M.fit(split[0], "decision_tree")).collect()}
    inner = [r for r in nodes.values() if r.feature is not None]
    assert inner and all(r.feature in M.FEATURES and r.gain > 0 for r in inner)
    for r in inner:
        assert r.rows == nodes[r.left].rows + nodes[r.right].rows
    assert all(r.left is r.right is r.threshold is r.gain is None
               for r in nodes.values() if r.feature is None)


def test_exact_bins_cover_every_value(spark):
    df = spark.createDataFrame([(1.0, 1.0, 0.0), (2.0, 1.0, 0.0), (3.0, 1.0, None)],
                               "week double, pro_percent double, holidaycode double")
    assert M.exact_bins(df) == 4

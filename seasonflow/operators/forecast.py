"""Regression forecasts with Spark ML (ML-1..11).

Input: one row per (region, product, yearweek) with ``qty`` and ``pro_percent``.
Three pipelines (VectorAssembler + DecisionTree / LinearRegression / RandomForest)
are fitted on a time split and scored with RMSE and MAE. Materialise the prepared input
once and split that: every fit makes many passes over it.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor, LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.yearweek import week_of, yearweek_int, yearweek_range
from ..session import scratch_path
from .enrich import flag, holiday_flag

FEATURES = ("week", "pro_percent", "holidaycode")
MODELS = ("decision_tree", "linear_regression", "random_forest")
DEFAULT_SEED = 42


def model_input(weekly: DataFrame, lo: str, hi: str, promo_product: str = "PROMO") -> DataFrame:
    """ML-1: typed features, 0/1 codes and the yearweek window (BETWEEN, pushable)."""
    return weekly.filter(yearweek_range(lo, hi)).select(
        "regionid", "product", "yearweek",
        week_of("yearweek").cast("double").alias("week"),
        F.col("qty").cast("double").alias("qty"),
        F.col("pro_percent").cast("double").alias("pro_percent"),
        flag(F.col("product") == promo_product).alias("promotioncode"),
        holiday_flag("yearweek").alias("holidaycode"))


def time_split(df: DataFrame, split_at: int, yearweek: str = "yearweek") -> tuple[DataFrame, DataFrame]:
    """ML-2 / FLT-11: train ``yearweek <= split_at``, test ``> split_at`` (int compare)."""
    yw = yearweek_int(yearweek)
    return df.filter(yw <= split_at), df.filter(yw > split_at)


def split_label(df: DataFrame, split_at: int, yearweek: str = "yearweek", out: str = "split") -> DataFrame:
    """The same complementary split as one labelled pass (``train`` / ``test``).

    Rows whose yearweek does not parse fall in neither filter of ``time_split`` and
    are dropped here too.
    """
    yw = yearweek_int(yearweek)
    return (df.filter(yw.isNotNull())
            .withColumn(out, F.when(yw <= split_at, F.lit("train")).otherwise(F.lit("test"))))


def regressor(kind: str, label: str = "qty", features: str = "features", seed: int = DEFAULT_SEED,
              **params):
    """ML-4/5/6 with library defaults; tree models always get an explicit seed. ``params``
    are the estimator's own (``maxDepth``, ``maxBins``, ...)."""
    if kind == "decision_tree":
        return DecisionTreeRegressor(labelCol=label, featuresCol=features, seed=seed, **params)
    if kind == "linear_regression":
        return LinearRegression(labelCol=label, featuresCol=features, **params)
    if kind == "random_forest":
        return RandomForestRegressor(labelCol=label, featuresCol=features, seed=seed, **params)
    raise ValueError(f"unknown model {kind!r}; choose from {MODELS}")


def estimator(kind: str, features=FEATURES, label: str = "qty", seed: int = DEFAULT_SEED,
             handle_invalid: str = "error", **params) -> Pipeline:
    """ML-3/7: assembler + regressor. ``handle_invalid`` is VectorAssembler's policy."""
    assembler = VectorAssembler(inputCols=list(features), outputCol="features",
                                handleInvalid=handle_invalid)
    return Pipeline(stages=[assembler, regressor(kind, label, "features", seed, **params)])


def fit(train: DataFrame, kind: str, **kw) -> PipelineModel:
    return estimator(kind, **kw).fit(train)


def predict(model: PipelineModel, test: DataFrame, ordered: bool = True) -> DataFrame:
    """Predictions with the vector column dropped; ``ordered`` sorts them by yearweek (SRT-1)."""
    out = model.transform(test).drop("features")
    return out.orderBy(F.asc("yearweek"), "regionid", "product") if ordered else out


def error_metrics(pred: DataFrame, label: str = "qty", prediction: str = "prediction") -> DataFrame:
    """ML-8: RMSE and MAE as one aggregate (same numbers as RegressionEvaluator)."""
    err = F.col(label) - F.col(prediction)
    return pred.agg(F.count(F.lit(1)).alias("n"),
                    F.sqrt(F.avg(err * err)).alias("rmse"),
                    F.avg(F.abs(err)).alias("mae"))


def actual_vs_predicted(pred: DataFrame, ids=("regionid", "product", "yearweek"),
                        label: str = "qty", prediction: str = "prediction") -> DataFrame:
    """ML-11 / SET-2: long table (MEASURE, ids..., SALES) with the reference's
    upper-case measure labels and column names, ready for a writer (SNK-1)."""
    from .reshape import measures_unpivot

    upper = [F.col(c).alias(c.upper()) for c in ids]
    wide = pred.select(*upper, F.col(label).alias("_real"), F.col(prediction).alias("_pred"))
    return measures_unpivot(wide, [c.upper() for c in ids], "_real", "_pred")


def tree_description(model: PipelineModel) -> str:
    """ML-10: the fitted tree's debug string."""
    return model.stages[-1].toDebugString


def exact_bins(train: DataFrame, features=FEATURES) -> int:
    """``maxBins`` at which a tree tries every split between two values of a feature."""
    distinct = train.agg(*[F.count_distinct(f).alias(f) for f in features]).first()
    return max(2, *distinct) + 1


NO_CHILD = -1


def tree_nodes(model: PipelineModel, features=FEATURES) -> DataFrame:
    """ML-10 as a table: one row per node of the fitted tree or of every tree of a forest,
    read back from the saved model in the shared folder.

    Columns: ``tree``, ``node`` (0 is a tree's root), ``feature`` and ``threshold`` (a row
    goes left if its value is at most that), ``left``, ``right``, all four null for a leaf,
    ``prediction``, ``impurity``, ``gain`` (null for a leaf) and ``rows`` (training rows).
    """
    fitted = model.stages[-1]
    spark = SparkSession.getActiveSession()
    path = scratch_path(spark, "model")
    fitted.write().save(path)
    data = spark.read.parquet(f"{path}/data")
    if "nodeData" in data.columns:
        data = data.select(F.col("treeID").alias("tree"), "nodeData.*")
    else:
        data = data.withColumn("tree", F.lit(0))
    inner = F.col("leftChild") != NO_CHILD
    names = F.array(*[F.lit(f) for f in features])

    def of_inner(c, name):
        return F.when(inner, c).alias(name)

    return data.select(
        "tree", F.col("id").alias("node"),
        of_inner(F.get(names, F.col("split.featureIndex")), "feature"),
        of_inner(F.get("split.leftCategoriesOrThreshold", F.lit(0)), "threshold"),
        of_inner(F.col("leftChild"), "left"), of_inner(F.col("rightChild"), "right"),
        "prediction", "impurity", of_inner(F.col("gain"), "gain"), F.col("rawCount").alias("rows"))


def walk(nodes: DataFrame, rows: DataFrame, depth: int, features=FEATURES,
         prediction: str = "prediction") -> DataFrame:
    """Predictions of :func:`tree_nodes` for ``rows``: every tree is walked from its root, one
    lookup of the node table per level, and the trees' values are averaged.

    ``depth`` is the model's. A node table has at most ``2^(depth + 1)`` rows per tree, so
    AQE broadcasts it on its real size.
    """
    roots = nodes.where(F.col("node") == 0).select("tree")
    at = (rows.withColumn("_row", F.monotonically_increasing_id()).join(roots)
          .withColumn("node", F.lit(0)))
    steps = nodes.select("tree", "node", "feature", "threshold", "left", "right")
    values = F.map_from_arrays(F.array(*[F.lit(f) for f in features]),
                               F.array(*[F.col(f).cast("double") for f in features]))
    for _ in range(depth):
        here = at.join(steps, ["tree", "node"])
        value = F.try_element_at(values, F.col("feature"))
        at = here.withColumn("node", F.when(F.col("feature").isNull(), F.col("node"))
                             .when(value <= F.col("threshold"), F.col("left"))
                             .otherwise(F.col("right"))).select(*at.columns)
    leaf = nodes.select("tree", "node", F.col("prediction").alias("_value"))
    return (at.join(leaf, ["tree", "node"]).groupBy("_row", *rows.columns)
            .agg(F.avg("_value").alias(prediction)).drop("_row"))


def compare(train: DataFrame, test: DataFrame, kinds=MODELS, **kw) -> DataFrame:
    """ML-9: (model, n, rmse, mae) for each model on the same split.

    Every fit passes over ``train`` many times: split a materialised input. The
    independent fits are submitted from driver threads so their Spark jobs share the
    cluster instead of queueing.
    """
    with ThreadPoolExecutor(max_workers=len(kinds)) as pool:
        models = list(pool.map(lambda kind: fit(train, kind, **kw), kinds))
    out = None
    for kind, model in zip(kinds, models):
        m = error_metrics(model.transform(test)).select(
            F.lit(kind).alias("model"), "n", "rmse", "mae")
        out = m if out is None else out.unionByName(m)
    return out

"""Estimators by name, model comparison, importances, saved models."""

from __future__ import annotations

from functools import partial, reduce
from multiprocessing.pool import ThreadPool

from pyspark import inheritable_thread_target
from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LinearSVC,
    LogisticRegression,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.regression import LinearRegression, RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.operators.boosting import HistBoosterModel, hist_regressor, joint_classifier
from modelyard.operators.classification import accuracy
from modelyard.operators.kernel import CLASSES_AT_ONCE, kernel_svm
from modelyard.operators.regression import regression_metrics
from modelyard.operators.registry import leaderboard

SEED = 42
# Models of a comparison that are fitted side by side.
MODELS_AT_ONCE = 3


# --- estimators ------------------------------------------------------------


def scaled_linear(label: str, features: str = "features") -> list:
    scaler = StandardScaler(inputCol=features, outputCol="scaled", withMean=True, withStd=True)
    return [scaler, LinearRegression(labelCol=label, featuresCol="scaled", solver="normal")]


def forest_regressor(label: str, trees: int = 400, depth: int = 18, **params) -> list:
    settings = {"minInstancesPerNode": 2, "seed": SEED, **params}
    return [RandomForestRegressor(labelCol=label, numTrees=trees, maxDepth=depth, **settings)]


def boosted_regressor(label: str, iterations: int = 400, depth: int = 10, step: float = 0.08, **settings) -> list:
    return [hist_regressor(label, rounds=iterations, depth=depth, step=step, seed=SEED, **settings)]


def _forest_classifier(label: str, **params) -> Estimator:
    return RandomForestClassifier(labelCol=label, **{"numTrees": 100, "seed": SEED, **params})


def _logistic(label: str, **params) -> Estimator:
    return LogisticRegression(labelCol=label, **{"maxIter": 200, **params})


def _boosted_classifier(label: str, **settings) -> Estimator:
    """Trees for all classes in each round, from the slopes of their joint softmax."""
    return joint_classifier(label, seed=SEED, **settings)


def _tree(label: str, **params) -> Estimator:
    return DecisionTreeClassifier(labelCol=label, **{"seed": 33, **params})


def _linear_svm(label: str, **params) -> Estimator:
    """A linear support vector machine per class; ``kernel_svm`` is the one with a radial kernel."""
    return OneVsRest(labelCol=label, classifier=LinearSVC(**params), parallelism=CLASSES_AT_ONCE)


CLASSIFIERS = {
    "random_forest": _forest_classifier,
    "logistic_regression": _logistic,
    "xgboost": _boosted_classifier,
    "decision_tree": _tree,
    "linear_svm": _linear_svm,
    "kernel_svm": kernel_svm,
}


def classifier(kind: str, label: str, **params) -> Estimator:
    if kind not in CLASSIFIERS:
        raise ValueError(f"unsupported model type: {kind}")
    return CLASSIFIERS[kind](label, **params)


def assembled(features: list[str], stages: list) -> Pipeline:
    return Pipeline(stages=[VectorAssembler(inputCols=features, outputCol="features"), *stages])


# --- training and comparison -----------------------------------------------


def fit_all(train: DataFrame, models: dict[str, Pipeline]) -> dict[str, PipelineModel]:
    """The fitted models, a few fitted side by side: where one waits for its next pass, or has work for few tasks, others use the cores.

    Each fit reads the training rows several times, so they are kept meanwhile.
    """
    train = train.persist()
    fits = [inheritable_thread_target(train.sparkSession)(partial(pipeline.fit, train)) for pipeline in models.values()]
    try:
        with ThreadPool(MODELS_AT_ONCE) as pool:
            return dict(zip(models, pool.map(lambda fit: fit(), fits, chunksize=1)))
    finally:
        train.unpersist()


def compare_regressors(
    train: DataFrame, test: DataFrame, label: str, models: dict[str, Pipeline]
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    """Leaderboard (rank, model, rmse, mae, r2) by RMSE, and the fitted models."""
    fitted = fit_all(train, models)
    scored = [
        regression_metrics(model.transform(test), label, "prediction").select(
            F.lit(name).alias("model"), "rmse", "mae", "r2"
        )
        for name, model in fitted.items()
    ]
    board = leaderboard(reduce(DataFrame.unionByName, scored))
    return board.select("rank", "model", "rmse", "mae", "r2"), fitted


def compare_classifiers(
    train: DataFrame, test: DataFrame, label: str, models: dict[str, Pipeline]
) -> tuple[DataFrame, dict[str, PipelineModel]]:
    fitted = fit_all(train, models)
    scored = [
        accuracy(model.transform(test), label, "prediction").select(F.lit(name).alias("model"), "n", "accuracy")
        for name, model in fitted.items()
    ]
    return reduce(DataFrame.unionByName, scored), fitted


def depth_sweep(
    train: DataFrame, test: DataFrame, label: str, features: list[str], depths=range(1, 10)
) -> DataFrame:
    """Accuracy of a decision tree per maximum depth."""
    models = {str(d): assembled(features, [classifier("decision_tree", label, maxDepth=d)]) for d in depths}
    scored, _ = compare_classifiers(train, test, label, models)
    return scored.select(F.col("model").cast("int").alias("depth"), "accuracy")


# --- looking into models ---------------------------------------------------


def importances(spark: SparkSession, model: Transformer, features: list[str]) -> DataFrame:
    """(feature, importance): a tree model's own importances, else the size of a
    linear model's coefficients, else zeros."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if hasattr(last, "featureImportances"):
        values = last.featureImportances.toArray()
    elif hasattr(last, "coefficients"):
        values = abs(last.coefficients.toArray())
    else:
        values = [0.0] * len(features)
    rows = [(f, float(v)) for f, v in zip(features, values, strict=True)]
    return leaderboard(
        spark.createDataFrame(rows, "feature string, importance double"), "importance", "feature", descending=True
    )


def split_counts(spark: SparkSession, model: Transformer, features: list[str], path: str) -> DataFrame:
    """How many splits use each feature, read from the saved nodes of a tree
    model; 0 for a feature no split uses."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    names = spark.createDataFrame(list(enumerate(features)), "position int, feature string")
    if isinstance(last, HistBoosterModel):
        nodes = spark.createDataFrame([(f,) for f in last.split_features()], "position int")
        return _counted(names, nodes.groupBy("position").agg(F.count("*").alias("splits")))
    last.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    node = "nodeData" if "nodeData" in nodes.columns else None
    index = F.col(f"{node}.split.featureIndex" if node else "split.featureIndex")
    used = nodes.filter(index >= 0).groupBy(index.alias("position")).agg(F.count("*").alias("splits"))
    return _counted(names, used)


def tree_splits(spark: SparkSession, model: Transformer, features: list[str], path: str) -> DataFrame:
    """node, feature, threshold, gain: the numeric splits of a decision tree, read from its saved nodes; the root is node 0."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    last.write().overwrite().save(path)
    nodes = spark.read.parquet(f"{path}/data")
    nodes = nodes.select("nodeData.*") if "nodeData" in nodes.columns else nodes
    feature = F.element_at(F.array(*map(F.lit, features)), F.col("split.featureIndex") + 1)
    threshold = F.get("split.leftCategoriesOrThreshold", F.lit(0))
    return nodes.filter("split.featureIndex >= 0").select(
        F.col("id").alias("node"), feature.alias("feature"), threshold.alias("threshold"), "gain"
    )


def _counted(names: DataFrame, used: DataFrame) -> DataFrame:
    return names.join(used, "position", "left").select(
        "feature", F.coalesce("splits", F.lit(0)).cast("bigint").alias("splits")
    )


def effective_params(spark: SparkSession, estimator) -> DataFrame:
    """Every parameter with the value in force, set or default, as text."""
    rows = [(param.name, str(value)) for param, value in estimator.extractParamMap().items()]
    return spark.createDataFrame(sorted(rows), "param string, value string")


def save_and_load(model: PipelineModel, path: str) -> PipelineModel:
    model.write().overwrite().save(path)
    return PipelineModel.load(path)

"""Grid search and k-fold scores."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Estimator, Pipeline
from pyspark.ml.evaluation import Evaluator, RegressionEvaluator
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.functions.keys import fold_number

FOLD = "fold"


def grid(estimator: Estimator, **choices: list) -> list[dict]:
    builder = ParamGridBuilder()
    for name, values in choices.items():
        builder = builder.addGrid(estimator.getParam(name), values)
    return builder.build()


def with_fold(df: DataFrame, key: list[str], folds: int = 3, seed: int = 42) -> DataFrame:
    return df.withColumn(FOLD, fold_number(seed, folds, *key))


class LastStageValidator(CrossValidator):
    """Each fold's rows are kept with the columns that the model and the evaluator read, not whole."""

    def _fit(self, dataset: DataFrame) -> CrossValidatorModel:
        readers = [self.getEstimator(), self.getEvaluator()]
        read = [r.getOrDefault(p) for r in readers for p in r.params if p.name in ("featuresCol", "labelCol", "weightCol") and r.isDefined(p)]
        return super()._fit(dataset.select(*dict.fromkeys([*filter(None, read), self.getFoldCol()])))


def cross_validated(
    estimator: Estimator, param_maps: list[dict], evaluator: Evaluator, folds: int = 3, seed: int = 42,
    parallelism: int = 4, kind: type[CrossValidator] = CrossValidator,
) -> CrossValidator:
    """Rows must carry a ``fold`` column, so that folds do not depend on partitions."""
    return kind(
        estimator=estimator, estimatorParamMaps=param_maps, evaluator=evaluator, numFolds=folds,
        seed=seed, foldCol=FOLD, parallelism=parallelism,
    )


def search_inside(stages: list, model: Estimator, param_maps: list[dict], evaluator: Evaluator, **options):
    """Every fold learns the feature stages too: nothing leaks between folds."""
    return cross_validated(Pipeline(stages=[*stages, model]), param_maps, evaluator, **options)


def search_last(stages: list, model: Estimator, param_maps: list[dict], evaluator: Evaluator, **options) -> Pipeline:
    """Feature stages learnt once on all rows, then the search: quicker, but
    held-out rows have had a say in the features."""
    return Pipeline(stages=[*stages, cross_validated(model, param_maps, evaluator, kind=LastStageValidator, **options)])


def search_results(spark: SparkSession, fitted: CrossValidatorModel, metric: str = "rmse") -> DataFrame:
    """One row per parameter map: its values and its metric averaged over the folds."""
    names = sorted({p.name for m in fitted.getEstimatorParamMaps() for p in m})
    rows = [
        (*[str({p.name: v for p, v in m.items()}.get(n)) for n in names], float(score), float(spread))
        for m, score, spread in zip(fitted.getEstimatorParamMaps(), fitted.avgMetrics, fitted.stdMetrics)
    ]
    columns = ", ".join([*[f"{n} string" for n in names], f"avg_{metric} double", f"std_{metric} double"])
    return spark.createDataFrame(rows, columns)


def regression_scores(predictions: DataFrame, label: str) -> dict[str, float]:
    """RMSE and R2, each from an evaluator of its own."""
    return {
        m: RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName=m).evaluate(predictions)
        for m in ("rmse", "r2")
    }


def fold_scores(df: DataFrame, pipeline: Pipeline, score, key: list[str], folds: int = 5, seed: int = 42) -> DataFrame:
    """(fold, score): each fold scored by a model trained on the others.

    ``score`` turns the scored rows of a fold into a one-row frame with a
    ``score`` column.
    """
    marked = with_fold(df, key, folds, seed).persist()
    parts = []
    for fold in range(folds):
        model = pipeline.fit(marked.filter(F.col(FOLD) != fold))
        scored = score(model.transform(marked.filter(F.col(FOLD) == fold)))
        parts.append(scored.select(F.lit(fold).alias(FOLD), "score"))
    return reduce(DataFrame.unionByName, parts)

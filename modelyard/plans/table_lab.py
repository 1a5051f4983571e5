"""CSV to table to searched, saved and reloaded forest."""

from __future__ import annotations

from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import DataFrame, SparkSession

from modelyard.operators.contract import columns_by_type
from modelyard.operators.features import index_stages
from modelyard.operators.models import save_and_load
from modelyard.operators.regression import regression_metrics
from modelyard.operators.selection import grid, search_inside, search_last, search_results, with_fold
from modelyard.operators.splits import hash_split
from modelyard.sources.readers import read_csv, read_table
from modelyard.sources.sinks import save_table


def load(spark: SparkSession, csv_path: str, table: str, schema=None, path: str | None = None) -> DataFrame:
    read_csv(spark, csv_path, schema).createOrReplaceTempView(f"{table}_view")
    save_table(spark.table(f"{table}_view"), table, path)
    return read_table(spark, table)


def forest_search(df: DataFrame, label: str, key: list[str], inside: bool = True, folds: int = 3, seed: int = 42):
    """Two-by-two forest grid; ``inside`` keeps feature stages within each fold."""
    strings, numbers = columns_by_type(df.drop(*key), label)
    forest = RandomForestRegressor(labelCol=label, maxBins=40, seed=seed)
    maps = grid(forest, maxDepth=[2, 5], numTrees=[5, 10])
    evaluator = RegressionEvaluator(labelCol=label, predictionCol="prediction", metricName="rmse")
    build = search_inside if inside else search_last
    search = build(index_stages(strings, numbers), forest, maps, evaluator, folds=folds, seed=seed)
    train, test = hash_split(df, key, seed=seed)
    folded = with_fold(train, key, folds, seed + 1).persist()
    fitted = search.fit(folded)
    folded.unpersist()
    return fitted, (fitted if inside else fitted.stages[-1]), test


def run(df: DataFrame, label: str, key: list[str], path: str, inside: bool = True) -> tuple[DataFrame, DataFrame]:
    """(grid results, metrics on held-out rows of the saved and reloaded best model)."""
    fitted, searched, test = forest_search(df, label, key, inside)
    results = search_results(df.sparkSession, searched)
    best = fitted.bestModel if inside else fitted
    model = save_and_load(best, path)
    scored = model.transform(test)
    return results, regression_metrics(scored, label, "prediction").select("n", "rmse", "r2")

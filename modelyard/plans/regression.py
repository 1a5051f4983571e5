"""Regression from raw rows to a report, in five steps that hand over files.

Every step reads what the step before it wrote, so any of them can be run again
alone; gates stop the run by raising.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.operators.align import with_single
from modelyard.operators.contract import all_but, band_gate, contract_report, enforce_contract, require_band
from modelyard.operators.models import (
    assembled,
    boosted_regressor,
    compare_regressors,
    forest_regressor,
    importances,
    scaled_linear,
)
from modelyard.operators.regression import regression_metrics, residual_histogram
from modelyard.operators.report import bullet, markdown_table, section
from modelyard.operators.splits import exact_split, sample_rows, with_exact_split
from modelyard.operators.summary import label_summary
from modelyard.sources.readers import read_artifacts
from modelyard.sources.sinks import write_document, write_single_csv

SMOKE_ROWS = 3000


def default_models(features: list[str], label: str) -> dict[str, Pipeline]:
    return {
        "linear_regression": assembled(features, scaled_linear(label)),
        "random_forest": assembled(features, forest_regressor(label)),
        "hist_gradient_boosting": assembled(features, boosted_regressor(label)),
    }


@dataclass
class RegressionJob:
    spark: SparkSession
    root: str
    key: list[str]
    label: str
    features: list[str]
    label_range: tuple[float, float]
    rmse_band: tuple[float, float]
    models: dict[str, Pipeline] = field(default_factory=dict)
    test_fraction: float = 0.2
    seed: int = 42

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def _part(self, split: str) -> DataFrame:
        return self.spark.read.parquet(self.path("data")).filter(F.col("split") == split).drop("split")

    def prepare(self, df: DataFrame) -> None:
        """Split rows by exact share and write them with a summary."""
        marked = with_exact_split(df.select(*self.key, *self.features, self.label), self.key, self.test_fraction, self.seed)
        marked.write.mode("overwrite").partitionBy("split").parquet(self.path("data"))
        written = self.spark.read.parquet(self.path("data"))
        summary = label_summary(written, self.label).withColumns(
            {"target": F.lit(self.label), "columns": F.array(*[F.lit(c) for c in [*self.features, self.label]])}
        )
        write_document(summary, self.path("data_summary"))

    def validate(self) -> None:
        expected = [*self.key, *self.features, self.label]
        data = self.spark.read.parquet(self.path("data"))
        report = contract_report(data, expected, self.label, *self.label_range, split="split")
        write_document(report, self.path("data_validation"))
        enforce_contract(self.spark.read.schema(report.schema).json(self.path("data_validation")))

    def smoke(self) -> None:
        """A linear model on a small sample has to land inside the error band."""
        sample = sample_rows(self._part("train"), SMOKE_ROWS, self.key, self.seed).persist()
        train, held_out = exact_split(sample, self.key, 0.2, self.seed)
        model = assembled(self.features, scaled_linear(self.label)).fit(train)
        metrics = regression_metrics(model.transform(held_out), self.label, "prediction").select("rmse")
        low, high = self.rmse_band
        gated = band_gate(metrics, "rmse", low, high).withColumns(
            {
                "model": F.lit("scaled_linear"),
                "sample_size": F.lit(sample.count()),
                "check": F.lit(f"{low} < rmse < {high}"),
            }
        )
        write_document(gated, self.path("smoke_train"))
        sample.unpersist()
        require_band(self.spark.read.schema(gated.schema).json(self.path("smoke_train")), "rmse")

    def train(self) -> None:
        models = self.models or default_models(self.features, self.label)
        test = self._part("test")
        board, fitted = compare_regressors(self._part("train"), test, self.label, models)
        board = board.persist()  # three rows, for which all models score all held-out rows
        write_single_csv(board, self.path("leaderboard"))
        write_document(board, self.path("metrics"))
        board.unpersist()
        best = self.spark.read.schema(board.schema).json(self.path("metrics")).filter("rank = 1").first()["model"]
        model = fitted[best]
        model.write().overwrite().save(self.path("best_model"))
        write_single_csv(importances(self.spark, model, self.features), self.path("feature_importance"))
        low, high = self.label_range
        residuals = residual_histogram(model.transform(test), self.label, "prediction", low - high, high - low)
        write_document(residuals, self.path("residuals"))

    def report(self) -> DataFrame:
        """One row with the report text; an error names artifacts not there yet."""
        names = ("data_validation", "smoke_train", "metrics")
        schemas = {
            "data_validation": "split string, n_rows bigint, status string",
            "smoke_train": "status string, model string, sample_size bigint, rmse double",
            "metrics": "rank int, model string, rmse double, mae double, r2 double",
        }
        found = read_artifacts(self.spark, {n: self.path(n) for n in names}, schemas)
        rows = found["data_validation"].agg(
            F.min("status").alias("validation"),
            F.max(F.when(F.col("split") == "train", F.col("n_rows"))).alias("train_rows"),
            F.max(F.when(F.col("split") == "test", F.col("n_rows"))).alias("test_rows"),
        )
        smoke = found["smoke_train"].select(F.struct("*").alias("smoke"))
        table = markdown_table(found["metrics"], ["model", "rmse", "mae", "r2"])
        best = found["metrics"].filter("rank = 1").select(F.col("model").alias("best"))
        joined = with_single(with_single(with_single(rows, smoke, "smoke"), table, "markdown"), best, "best")
        data = section(
            "Input table",
            [
                bullet("contract", F.col("validation")),
                bullet("rows learnt from", F.col("train_rows")),
                bullet("rows held out", F.col("test_rows")),
            ],
        )
        trial = section(
            "Trial fit",
            [
                bullet("estimator", F.col("smoke.model")),
                bullet("rows sampled", F.col("smoke.sample_size")),
                bullet("root mean squared error", F.format_string("%.4f", F.col("smoke.rmse"))),
                bullet("outcome", F.col("smoke.status")),
            ],
        )
        ranking = section("Candidates, best first", [F.col("markdown"), F.concat(F.lit("Kept: `"), F.col("best"), F.lit("`"))])
        text = F.concat_ws("\n\n", ranking, data, trial)
        report = joined.select(text.alias("report"))
        report.coalesce(1).write.mode("overwrite").text(self.path("report"))
        return report

    def run(self, df: DataFrame) -> DataFrame:
        self.prepare(df)
        self.validate()
        self.smoke()
        self.train()
        return self.report()


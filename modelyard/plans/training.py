"""Train a classifier, record the run, and register it when it earns it."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline
from pyspark.ml.feature import IndexToString, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.operators.classification import averaged_metrics
from modelyard.operators.contract import drop_missing
from modelyard.operators.drift import bounded_profile, reference_profile
from modelyard.operators.models import classifier
from modelyard.operators.registry import best_value, latest_version, promotion, version_metric
from modelyard.operators.splits import exact_split
from modelyard.sources.tracking import FAILED, FINISHED, RUNNING, Tracking

# Metric name as asked for -> column of the averaged metrics.
METRIC_COLUMNS = {"accuracy": "accuracy", "precision": "macro_precision"}


@dataclass
class TrainingJob:
    tracking: Tracking
    model_name: str
    experiment: str
    features: list[str]
    label: str
    key: list[str]
    model_type: str = "random_forest"
    metrics: str = "accuracy,precision"
    main_metric: str = "accuracy"
    force: bool = False
    test_fraction: float = 0.2
    seed: int = 42
    params: dict = field(default_factory=dict)
    # Quantiles kept of each feature for drift tests; all its distinct values where None.
    profile_points: int | None = None

    def _stages(self, train: DataFrame) -> tuple[StringIndexerModel, Pipeline]:
        indexer = StringIndexer(inputCol=self.label, outputCol="label_index", handleInvalid="skip").fit(
            train.withColumn(self.label, F.col(self.label).cast("string"))
        )
        model = classifier(self.model_type, "label_index", **self.params)
        names = IndexToString(inputCol="prediction", outputCol="predicted", labels=indexer.labels)
        assembler = VectorAssembler(inputCols=self.features, outputCol="features")
        return indexer, Pipeline(stages=[assembler, model, names])

    def run(self, df: DataFrame) -> DataFrame:
        """One row: run_id, new_value, best_value, register, reason.

        The run is RUNNING from here on, FINISHED when its version is registered
        (or not), and FAILED if anything stops it before.
        """
        run_id = uuid.uuid4().hex
        self.tracking.log_state(run_id, self.experiment, RUNNING)
        try:
            decided = self._run(df, run_id)
        except Exception as error:
            self.tracking.log_state(run_id, self.experiment, FAILED, {"error": type(error).__name__})
            raise
        reason = decided.first()["reason"]
        tags = {"has_drift_detector": "true", **({"model_registration_reason": reason} if reason else {})}
        self.tracking.log_state(run_id, self.experiment, FINISHED, tags)
        return decided

    def _run(self, df: DataFrame, run_id: str) -> DataFrame:
        spark = df.sparkSession
        rows = drop_missing(df.select(*self.key, *self.features, self.label))
        train, test = exact_split(rows, self.key, self.test_fraction, self.seed)
        indexer, pipeline = self._stages(train)
        # The label's index is needed to fit, not to score: it stays outside the saved model.
        indexed = indexer.transform(train).persist()
        model = pipeline.fit(indexed)
        indexed.unpersist()

        scored = model.transform(test).withColumn("truth", F.col(self.label).cast("string"))
        found = averaged_metrics(scored, "truth", "predicted").first()
        asked = [m.strip() for m in self.metrics.split(",")]
        results = {m: float(found[METRIC_COLUMNS[m]]) for m in asked if m in METRIC_COLUMNS}

        model.write().overwrite().save(self.tracking.model_path(run_id))
        if self.profile_points:
            profile = bounded_profile(train, self.features, self.profile_points)
        else:
            profile = reference_profile(train, self.features)
        self.tracking.append("references", profile.withColumn("run_id", F.lit(run_id)))
        self.tracking.log_metrics(run_id, results)
        self.tracking.append_values("params", [(run_id, "model_type", self.model_type)])

        # Fixed before versions are added: the decision is on the state found.
        decided = self._decide(spark, run_id, results.get(self.main_metric, 0.0))
        decided = spark.createDataFrame(decided.collect(), decided.schema)
        if decided.first()["register"]:
            self.tracking.register(self.model_name, run_id)
        return decided

    def _decide(self, spark: SparkSession, run_id: str, new_value: float) -> DataFrame:
        """The bar is the best among the latest versions of each stage."""
        versions = self.tracking.read("model_versions").filter(F.col("name") == self.model_name)
        latest = latest_version(versions, ["name", "stage"])
        best = best_value(version_metric(latest, self.tracking.last_metrics(), self.main_metric))
        candidate = spark.createDataFrame(
            [(self.model_name, run_id, new_value)], "name string, run_id string, new_value double"
        )
        return promotion(candidate, best, force=self.force)

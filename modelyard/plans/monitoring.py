"""Score with the latest version or champion, extend the predictions, test for drift."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.operators.contract import drop_missing
from modelyard.operators.drift import (
    P_VALUE,
    WINDOW_ROWS,
    drift_report,
    ks_distance,
    feature_rows,
    version_with_reference,
    with_decision,
    with_p_value,
)
from modelyard.operators.registry import champions
from modelyard.sources.predictions import PredictionTable
from modelyard.sources.sinks import write_document
from modelyard.sources.tracking import Tracking

SKIPPED, DONE = "skip_monitoring", "monitoring_done"


@dataclass
class ScoringJob:
    tracking: Tracking
    model_name: str
    features: list[str]
    predictions: PredictionTable
    reports: str
    window: int = WINDOW_ROWS
    alpha: float = P_VALUE
    # Score with the last version that is the champion, or with the last of all.
    champion: bool = False

    def score(self, df: DataFrame) -> DataFrame:
        """Features, sequence and prediction of the version in use."""
        run_id = self._version().first()["run_id"]
        model = PipelineModel.load(self.tracking.model_path(run_id))
        rows = drop_missing(df.select(*self.predictions.sequence, *self.features))
        return model.transform(rows).select(
            *self.predictions.sequence, *self.features, F.col("predicted").alias("prediction")
        )

    def _version(self) -> DataFrame:
        versions = self.tracking.read("model_versions")
        return version_with_reference(
            champions(versions) if self.champion else versions, self.tracking.read("references"), self.model_name
        )

    def run(self, df: DataFrame, batch: int) -> str:
        """One batch; the branch taken is returned."""
        self.predictions.append(self.score(df), batch)
        return self.monitor(batch)

    def monitor(self, batch: int) -> str:
        current = self.predictions.last(self.window).drop("prediction")
        if current.count() < self.window:
            return SKIPPED
        version = self._version()
        run_id = version.first()["run_id"]
        reference = self.tracking.read("references").filter(F.col("run_id") == run_id)
        distances = ks_distance(reference, feature_rows(current, self.features))
        tested = with_decision(with_p_value(distances), len(self.features), self.alpha)
        report = drift_report(tested, version.select("name", "version", "run_id"), F.current_timestamp(), self.window)
        write_document(report, f"{self.reports}/batch={batch}", f"{self.reports}/latest")
        return DONE

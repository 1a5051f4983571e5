"""Run, metric, parameter, version and reference tables under one folder."""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from datetime import UTC, datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from modelyard.sources.commits import CommitLog

RUNNING, FINISHED, FAILED = "RUNNING", "FINISHED", "FAILED"

# The layout of the tracking tables.
SCHEMAS = {
    "runs": "run_id string, experiment string, status string, start_time timestamp, tags map<string,string>",
    "metrics": "run_id string, key string, value double, step bigint, time timestamp",
    "params": "run_id string, key string, value string",
    "model_versions": "name string, version string, run_id string, aliases array<string>, stage string",
    "references": "run_id string, feature string, value double, n bigint",
}


class Tracking:
    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def model_path(self, run_id: str) -> str:
        return f"{self.root}/models/{run_id}"

    def read(self, name: str) -> DataFrame:
        """The table, empty when nothing was written yet; of a run the last state, versions from their commit logs."""
        if name == "model_versions":
            return self._found(lambda: self.spark.read.schema(SCHEMAS[name]).json(f"{self.path(name)}/*/*.json"), name)
        rows = self._found(lambda: self.spark.read.schema(SCHEMAS[name]).parquet(self.path(name)), name)
        if name == "runs":
            # A run that ended has ended, whatever the clocks said; earlier states count by time.
            order = F.struct((F.col("status") != RUNNING).alias("ended"), "start_time")
            rest = [c for c in rows.columns if c != "run_id"]
            first = F.min("start_time").alias("first")
            rows = rows.groupBy("run_id").agg(F.max_by(F.struct(*rest), order).alias("last"), first)
            rows = rows.select("run_id", *[F.col("first" if c == "start_time" else f"last.{c}").alias(c) for c in rest])
        return rows

    def _found(self, read: Callable[[], DataFrame], name: str) -> DataFrame:
        try:
            return read()
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], SCHEMAS[name])

    def append(self, name: str, rows: DataFrame) -> None:
        """Columns that ``rows`` does not have are null."""
        target = self.spark.createDataFrame([], SCHEMAS[name]).schema
        columns = [(rows[f.name] if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in target.fields]
        rows.select(columns).write.mode("append").parquet(self.path(name))

    def append_values(self, name: str, rows: list[tuple]) -> None:
        """A handful of literal rows, such as one run's parameters; fields left off are null."""
        if rows:
            width = len(self.spark.createDataFrame([], SCHEMAS[name]).columns)
            full = [(*row, *[None] * (width - len(row))) for row in rows]
            self.append(name, self.spark.createDataFrame(full, SCHEMAS[name]).coalesce(1))

    def log_state(self, run_id: str, experiment: str, status: str, tags: dict[str, str] | None = None) -> None:
        """The run is in this state now: RUNNING, then FINISHED or FAILED."""
        self.append_values("runs", [(run_id, experiment, status, datetime.now(UTC), tags or {})])

    def log_metrics(self, run_id: str, values: dict[str, float], step: int = 0) -> None:
        now = datetime.now(UTC)
        self.append_values("metrics", [(run_id, key, float(value), step, now) for key, value in values.items()])

    def last_metrics(self) -> DataFrame:
        """run_id, key, value, step, time: of each run and key the value of the highest step, the latest of these."""
        rest = ("value", "step", "time")
        last = F.max_by(F.struct(*rest), F.struct("step", "time")).alias("last")
        return self.read("metrics").groupBy("run_id", "key").agg(last).select("run_id", "key", *[f"last.{c}" for c in rest])

    def register(self, name: str, run_id: str) -> str:
        """A new version of the model; jobs that register at the same time get different numbers."""
        folder = hashlib.md5(name.encode()).hexdigest()
        log = CommitLog(self.spark, f"{self.path('model_versions')}/{folder}", SCHEMAS["model_versions"])
        entry = {"name": name, "run_id": run_id, "aliases": [], "stage": "None"}
        return str(log.append(lambda number: {**entry, "version": str(number)}))

"""Streaming forms, run to the end of what is there; results equal the batch form's."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructType, TimestampNTZType

from modelyard.operators.routing import route_by
from modelyard.plans.monitoring import ScoringJob
from modelyard.plans.training import TrainingJob
from modelyard.queries import query, table
from modelyard.session import scratch_path
from modelyard.sources.predictions import PredictionTable
from modelyard.sources.tracking import Tracking
from modelyard.streaming.jobs import arriving, current_histories, stream_histories, stream_routes, stream_scoring


def stream(spark, folder, name: str) -> DataFrame:
    """The table as a stream of files; the pattern matches a single file or a folder of them."""
    return arriving(spark, f"{folder}/{name}.parquet*", table(spark, folder, name).schema)


@query(
    "streamed_histories",
    "Q1",
    """SELECT conv_id, turn // 64 AS segment,
              string_agg(concat(turn, '|', role, '|', text), chr(10) ORDER BY turn) AS history, count(*)::INTEGER AS n_turns
       FROM conversations GROUP BY 1, 2""",
)
def streamed_histories(spark, folder):
    path = scratch_path(spark, "histories")
    messages = stream(spark, folder, "conversations")
    stream_histories(messages, path, scratch_path(spark, "histories-checkpoint")).awaitTermination()
    lines = F.transform("history", lambda m: F.concat_ws("|", m["turn"].cast("string"), m["role"], m["content"]))
    return current_histories(spark, path).withColumn("history", F.array_join(lines, "\n"))


@query(
    "streamed_routes",
    "Q3",
    """SELECT event_id, CASE WHEN user_id NOT IN (1, 2, 3, 5, 8, 13, 21, 34) THEN 'deny'
              WHEN event_type = 'signup' THEN 'welcome' WHEN event_type IN ('view', 'click') THEN 'converse'
              ELSE 'ignore' END AS handler FROM events""",
)
def streamed_routes(spark, folder):
    path = scratch_path(spark, "routes")
    handler = route_by(F.col("event_type"), {"welcome": ["signup"], "converse": ["view", "click"]}, "ignore")
    stream_routes(
        stream(spark, folder, "events"), "user_id", [1, 2, 3, 5, 8, 13, 21, 34], handler, path,
        scratch_path(spark, "routes-checkpoint"),
    ).awaitTermination()
    return spark.read.schema("event_id bigint, handler string").parquet(path)


@query("streamed_scoring", "Q2 U3 P20 D2 D5 D6")
def streamed_scoring(spark, folder):
    """Train on events, then score them as they arrive, extend the table, test for drift."""
    features, key = ["value", "user"], ["event_id"]
    root = scratch_path(spark, "scoring")
    tracking = Tracking(spark, f"{root}/tracking")

    def prepared(df: DataFrame) -> DataFrame:
        return df.withColumn("user", F.col("user_id").cast("double"))

    training = TrainingJob(
        tracking, "event_types", "events", features, "event_type", key, model_type="decision_tree", params={"maxDepth": 3}
    )
    training.run(prepared(table(spark, folder, "events")))
    schema = (
        StructType().add("ts", TimestampNTZType()).add("value", DoubleType()).add("user", DoubleType())
        .add("prediction", StringType())
    )
    stored = PredictionTable(spark, f"{root}/predictions", schema, ["ts"])
    job = ScoringJob(tracking, "event_types", features, stored, f"{root}/reports")
    stream_scoring(prepared(stream(spark, folder, "events")), job, f"{root}/checkpoint").awaitTermination()
    report = spark.read.json(f"{root}/reports/latest")
    return report.select(
        "model_name", "model_version", "window_size", F.col("preds.is_drift").alias("is_drift"),
        F.size("preds.data").alias("n_features"),
    )

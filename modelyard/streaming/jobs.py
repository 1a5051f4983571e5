"""Streams over arriving files, built from the batch operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from modelyard.operators.conversations import SEGMENT_TURNS, histories
from modelyard.operators.routing import gate_by_list
from modelyard.plans.monitoring import ScoringJob


def arriving(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def _start(df: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, mode: str) -> StreamingQuery:
    writer = df.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
    return writer.foreachBatch(each).trigger(availableNow=True).start()


def stream_histories(
    messages: DataFrame, path: str, checkpoint: str, turns: int = SEGMENT_TURNS
) -> StreamingQuery:
    """Add messages to conversation histories as they arrive.

    The stream keeps no state, however many conversations there are and however long
    they last: each batch writes its own messages, as parts of segments, to a folder
    of its own, which a rerun of the batch replaces. A turn is written once, and a
    late one joins its segment when that is read.
    """

    def write(arrived: DataFrame, batch: int) -> None:
        histories(arrived, turns).write.mode("overwrite").parquet(f"{path}/batch={batch}")

    return _start(messages, write, checkpoint, "append")


def current_histories(spark: SparkSession, path: str) -> DataFrame:
    """Every segment written by ``stream_histories``, put together from its parts.

    A filter on conv_id or segment reaches the files, so one conversation is read without the others.
    """
    parts = spark.read.parquet(path)
    whole = F.array_sort(F.flatten(F.collect_list("history"))).alias("history")
    return parts.groupBy("conv_id", "segment").agg(whole, F.sum("n_turns").cast("int").alias("n_turns"))


def stream_routes(messages: DataFrame, user: str, allowed: list, handler, path: str, checkpoint: str) -> StreamingQuery:
    """Gate and route each message; no state."""
    routed = gate_by_list(messages, user, allowed).withColumn(
        "handler", F.when(F.col("access") == "allowed", handler).otherwise(F.lit("deny"))
    )
    return (
        routed.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_scoring(rows: DataFrame, job: ScoringJob, checkpoint: str) -> StreamingQuery:
    """Score, append and monitor every arriving batch.

    A batch may be replayed after a failure; the predictions table and the report
    folder are both keyed by the batch number, so the replay changes nothing.
    """

    def handle(batch_rows: DataFrame, batch: int) -> None:
        job.run(batch_rows, batch)

    return _start(rows, handle, checkpoint, "append")

"""Conversation history and prompt evaluation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from modelyard.functions.text import ari_grade, rouge2
from modelyard.operators.align import next_in_sequence

SEGMENT_TURNS = 64


def segment(turn: Column, turns: int = SEGMENT_TURNS) -> Column:
    return F.floor(turn / turns).cast("bigint")


def histories(messages: DataFrame, turns: int = SEGMENT_TURNS) -> DataFrame:
    """Each conversation's messages in order, as rows of at most ``turns`` turns.

    (conv_id, turn) identifies a message, so no row outgrows its segment however
    long a conversation gets; reading segments in order gives the whole history.
    """
    ordered = F.array_sort(F.collect_list(F.struct("turn", "role", F.col("text").alias("content"))))
    return (
        messages.groupBy("conv_id", segment(F.col("turn"), turns).alias("segment"))
        .agg(ordered.alias("history"))
        .withColumn("n_turns", F.size("history"))
    )


def exchanges(messages: DataFrame) -> DataFrame:
    """(conv_id, turn, prompt, response): each user turn with the reply right after it."""
    pairs = next_in_sequence(messages, "conv_id", "turn", ["role", "text"])
    return pairs.filter((F.col("role") == "user") & (F.col("next_role") == "assistant")).select(
        "conv_id", "turn", F.col("text").alias("prompt"), F.col("next_text").alias("response")
    )


def evaluate_responses(df: DataFrame, response: str, target: str) -> DataFrame:
    """ROUGE-2 against the target and the response's reading grade, inside each row."""
    return df.withColumns(
        {"rouge2": rouge2(F.col(response), F.col(target)), "ari_grade": ari_grade(F.col(response))}
    )


def evaluation_means(evaluated: DataFrame, by: list[str], metrics: list[str]) -> DataFrame:
    return evaluated.groupBy(*by).agg(
        F.count("*").alias("n"), *[F.avg(m).alias(f"{m}_mean") for m in metrics]
    )

"""What the operators of this package share: reading, words, text batches."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructType

# Runs of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def texts(docs: DataFrame, *more: str) -> DataFrame:
    """``doc_id``, the whole text (null reads as empty) and ``more``; other columns go."""
    return docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"), *more)


def id_remainder(divisor: int, key: str = "doc_id") -> Column:
    """crc32 of the id as text, modulo ``divisor``; a null id counts as the empty text."""
    written = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return F.crc32(written.cast("binary")) % divisor


def per_text(docs: DataFrame, measure: Callable[[str], tuple], schema: str) -> DataFrame:
    """``doc_id`` and the tuple of ``measure(text)`` for each row, in Arrow batches.

    ``schema`` names the tuple's fields. Tables that ``measure`` holds are built
    on the driver and go out with it, so they must be of a fixed small size.
    """
    return all_texts(docs, lambda texts: map(measure, texts), schema)


def all_texts(docs: DataFrame, measure: Callable[[list[str]], Iterable[tuple]], schema: str) -> DataFrame:
    """As ``per_text``, with a ``measure`` that takes the texts of a batch together and gives their tuples in order."""
    fields = DataType.fromDDL(schema)
    names = fields.names

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = pd.DataFrame(list(measure(batch["text"].tolist())), columns=names)
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    columns = StructType([docs.schema["doc_id"], *fields.fields])
    return texts(docs).mapInPandas(run, columns)

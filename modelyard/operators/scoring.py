"""Batch scoring and the table of predictions."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, StructType


def predict_udf(predict: Callable[[pd.DataFrame], pd.Series], returns: DataType | str = DoubleType()):
    """Column function over ``struct(*features)``: Arrow batches in, one value per row out."""

    @F.pandas_udf(returns)
    def scored(batches: Iterator[pd.DataFrame]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(predict(batch))

    return scored


def score_with(df: DataFrame, predict: Callable, features: list[str], returns: DataType | str = DoubleType()) -> DataFrame:
    return df.withColumn("prediction", predict_udf(predict, returns)(F.struct(*features)))


def score_frames(df: DataFrame, predict: Callable[[pd.DataFrame], pd.DataFrame], schema: StructType | str) -> DataFrame:
    """For models that return whole frames, or one value per column."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield predict(batch)

    return df.mapInPandas(run, schema)


def linear_score(weights: dict[str, float], intercept: float = 0.0) -> Column:
    """The same as a linear ``predict``, but inside Spark's generated code."""
    return reduce(lambda a, b: a + b, [F.col(c) * F.lit(w) for c, w in weights.items()], F.lit(intercept))


# --- the predictions table -------------------------------------------------


def append_rows(existing: DataFrame | None, new: DataFrame) -> DataFrame:
    """Both, by column name; a column only one side has is null on the other."""
    return new if existing is None else existing.unionByName(new, allowMissingColumns=True)


def distinct_rows(df: DataFrame, sequence: list[str] | None = None, subset: list[str] | None = None) -> DataFrame:
    """One row for each set of equal rows, the earliest when a sequence says which.

    Rows are compared over all columns outside the sequence, the prediction
    included, so a retrained model adds its rows again; ``subset`` narrows that.
    Copies are merged before the shuffle as well as after it.
    """
    sequence = sequence or []
    compared = subset or [c for c in df.columns if c not in sequence]
    others = [c for c in df.columns if c not in compared and c not in sequence]
    if not sequence:
        return df.dropDuplicates(compared)
    first = F.min(F.struct(*sequence, *others)).alias("first")
    return df.groupBy(*compared).agg(first).select(*compared, "first.*").select(*df.columns)


def not_yet_in(existing: DataFrame, new: DataFrame, compared: list[str]) -> DataFrame:
    """New rows that equal no existing one; nulls equal nulls, NaN equals NaN."""
    old = existing.select(*[F.col(c).alias(f"_old_{c}") for c in compared])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_old_{c}")) for c in compared])
    return new.join(old, same, "left_anti")


def last_rows(df: DataFrame, sequence: list[str], n: int = 20) -> DataFrame:
    return df.orderBy(*[F.desc(c) for c in sequence]).limit(n)

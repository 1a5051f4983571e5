"""A radial kernel for linear machines: seeded random Fourier features (Rahimi and Recht 2007)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Pipeline, Transformer
from pyspark.ml.classification import LinearSVC, OneVsRest
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

GAMMA, SIZE = 0.001, 256
# Vectors that a task holds the features of at once.
AT_ONCE = 512
# Classes whose machines are fitted side by side: each is a row of short passes, which leave cores idle.
CLASSES_AT_ONCE = 4


def in_pieces(batch: pd.Series, directions: np.ndarray) -> Iterator[pd.Series]:
    """The features of the vectors of a batch, AT_ONCE vectors at a time; a null vector has none."""
    for start in range(0, len(batch), AT_ONCE):
        vectors = batch.iloc[start : start + AT_ONCE]
        there = vectors.notna().to_numpy()
        out: list[np.ndarray | None] = [None] * len(vectors)
        if there.any():
            angles = np.stack(vectors[there]).astype(float) @ directions.T
            found = np.hstack([np.cos(angles), np.sin(angles)]) * (1.0 / len(directions)) ** 0.5
            for at, line in zip(np.flatnonzero(there), found):
                out[at] = line
        yield pd.Series(out, dtype=object)


def fourier_features(vector: Column, dimensions: int, gamma: float = GAMMA, size: int = SIZE, seed: int = 42) -> Column:
    """Array of ``size`` values (null for a null vector) whose dot product with those of another vector
    estimates exp(-gamma * squared distance), with a standard error of at most 1 / sqrt(size).

    Batches leave the task in pieces, so what its Python holds does not depend on how many rows Spark sends at once."""
    directions = np.random.default_rng(seed).normal(0.0, (2 * gamma) ** 0.5, (size // 2, dimensions))

    @F.pandas_udf("array<double>")
    def waves(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield from in_pieces(batch, directions)

    return waves(vector)


class FourierFeatures(Transformer, HasInputCol, HasOutputCol, HasSeed, DefaultParamsReadable, DefaultParamsWritable):
    """Vector column to vector column; the directions follow from seed, size and the vectors' length."""

    gamma = Param(Params._dummy(), "gamma", "width of the kernel", typeConverter=TypeConverters.toFloat)
    size = Param(Params._dummy(), "size", "number of features made", typeConverter=TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCol="features", outputCol="waves", gamma=GAMMA, size=SIZE, seed=42) -> None:
        super().__init__()
        self._setDefault(inputCol="features", outputCol="waves", gamma=GAMMA, size=SIZE, seed=42)
        self._set(**self._input_kwargs)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        vector = vector_to_array(F.col(self.getInputCol()))
        known = dataset.schema[self.getInputCol()].metadata.get("ml_attr", {}).get("num_attrs")
        dimensions = known or (dataset.select(F.size(vector)).first() or [0])[0]
        waves = fourier_features(vector, dimensions, self.getOrDefault("gamma"), self.getOrDefault("size"), self.getSeed())
        return dataset.withColumn(self.getOutputCol(), array_to_vector(waves))


def kernel_svm(label: str, gamma: float = GAMMA, size: int = SIZE, seed: int = 42, **params) -> Pipeline:
    """A support vector machine with a radial kernel for each class."""
    machine = LinearSVC(featuresCol="waves", **params)
    return Pipeline(stages=[FourierFeatures(gamma=gamma, size=size, seed=seed), OneVsRest(featuresCol="waves", labelCol=label, classifier=machine, parallelism=CLASSES_AT_ONCE)])

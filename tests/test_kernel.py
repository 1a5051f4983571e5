"""The kernel estimate, and classes that only a kernel tells apart."""

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from modelyard.operators.classification import accuracy
from modelyard.operators.kernel import AT_ONCE, fourier_features, in_pieces, kernel_svm
from modelyard.operators.models import classifier


def test_estimate_is_within_its_error(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 5))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "id long, x array<double>")
    z = np.array([r.z for r in df.select("id", fourier_features(F.col("x"), 5, 0.2, 1024).alias("z")).orderBy("id").collect()])
    exact = np.exp(-0.2 * ((x[:, None] - x[None]) ** 2).sum(axis=2))
    error = z @ z.T - exact
    assert np.sqrt((error**2).mean()) < 1 / 32 and np.abs(error).max() < 5 / 32


def test_rings(spark, tmp_path):
    rng = np.random.default_rng(4)
    angle, ring = rng.uniform(0, 6.3, 400), np.arange(400) % 2
    rows = [(i, [float(r * np.cos(a)), float(r * np.sin(a))], float(k)) for i, (a, k) in enumerate(zip(angle, ring)) for r in [1 + 2 * k]]
    df = spark.createDataFrame(rows, "id long, x array<double>, label double").withColumn("features", array_to_vector("x"))
    share = lambda model: accuracy(model.transform(df), "label", "prediction").first()["accuracy"]
    kernel = kernel_svm("label", gamma=0.5, size=128, maxIter=20).fit(df)
    assert share(kernel) > 0.98 and share(classifier("linear_svm", "label", maxIter=20).fit(df)) < 0.7
    path = f"file://{tmp_path}/m"
    model = Pipeline(stages=[kernel_svm("label", gamma=0.5, size=32, maxIter=2)]).fit(df)
    model.write().overwrite().save(path)
    assert share(PipelineModel.load(path)) == share(model)


def test_batches_leave_in_pieces(spark):
    """A large batch never has all its features at once, and its nulls stay in their places."""
    x = np.random.default_rng(5).normal(size=(3 * AT_ONCE + 5, 4))
    batch = pd.Series([None if i % 700 == 3 else r for i, r in enumerate(x)], dtype=object)
    directions = np.random.default_rng(6).normal(size=(8, 4))
    pieces = list(in_pieces(batch, directions))
    assert [len(p) for p in pieces] == [AT_ONCE] * 3 + [5]
    for v, z in zip(batch, pd.concat(pieces)):
        assert z is None if v is None else np.allclose(z, np.hstack([np.cos(directions @ v), np.sin(directions @ v)]) / 8**0.5)
    rows = [(i, None if v is None else v.tolist()) for i, v in enumerate(batch)]
    df = spark.createDataFrame(rows, "id long, x array<double>").coalesce(1).withColumn("z", fourier_features(F.col("x"), 4, 0.2, 16))
    found = df.agg(F.count("*").alias("n"), F.count_if(F.col("x").isNull() != F.col("z").isNull()).alias("odd"), F.min(F.size("z")).alias("size")).first()
    assert found == (len(batch), 0, 16)

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import drift as D
from modelyard.operators.contract import ContractError


def frame(spark, **columns):
    names = list(columns)
    return spark.createDataFrame(list(zip(*[[float(v) for v in columns[n]] for n in names])), names)


def distance(a, b):
    points = np.concatenate([a, b])
    cdf = lambda s: np.searchsorted(np.sort(s), points, side="right") / len(s)
    return float(np.max(np.abs(cdf(a) - cdf(b))))


def test_distance_matches_empirical_distributions(spark):
    rng = np.random.default_rng(0)
    ref = {"x": rng.normal(size=400), "y": rng.integers(0, 4, 400)}
    cur = {"x": rng.normal(0.5, 1, size=90), "y": rng.integers(0, 5, 90)}
    found = D.drift_test(frame(spark, **ref), frame(spark, **cur), ["x", "y"]).collect()
    for r in found:
        assert r.distance == pytest.approx(distance(ref[r.feature], cur[r.feature]))
        assert (r.n_ref, r.n_cur, r.threshold) == (400, 90, 0.025)


def test_a_frame_does_not_drift_from_itself(spark):
    df = frame(spark, x=range(100), y=[1] * 100)
    for r in D.drift_test(df, df, ["x", "y"]).collect():
        assert (r.distance, r.p_value, r.drifted) == (0.0, 1.0, False)


def test_apart_frames_drift(spark):
    tested = D.drift_test(frame(spark, x=range(60)), frame(spark, x=range(100, 140)), ["x"])
    row = tested.first()
    assert row.distance == 1.0 and row.p_value == 0.0 and row.drifted
    assert D.any_drift(tested).first().is_drift == 1


def test_stored_profile_equals_raw_rows(spark):
    a, b = frame(spark, x=[1, 1, 2, 3, 3, 3]), frame(spark, x=[2, 2, 3, 9])
    stored = D.ks_distance(D.reference_profile(a, ["x"]), D.feature_rows(b, ["x"])).first()
    assert stored == D.ks_distance(D.feature_rows(a, ["x"]), D.feature_rows(b, ["x"])).first()


def sizes(profile):
    return {r.feature: (r.rows, r.n) for r in profile.groupBy("feature").agg(F.count("*").alias("rows"), F.sum("n").alias("n")).collect()}


def test_bounded_profile_does_not_grow_with_the_rows(spark):
    for rows in (3_001, 300_000):
        df = spark.range(rows).select(F.rand(3).alias("x"), (F.col("id") % 5).alias("y"), F.lit(None).cast("double").alias("z"))
        found = sizes(D.bounded_profile(df, ["x", "y", "z"], points=200))
        assert found == {"x": (200, rows), "y": (5, rows)}


def test_bounded_profile_of_few_rows_is_the_exact_one(spark):
    df = spark.createDataFrame([(float(v),) for v in [1, 1, 1, 2, 9, 9, -4]] + [(None,)], "x double").repartition(3)
    assert sorted(D.bounded_profile(df, ["x"]).collect()) == sorted(D.reference_profile(df, ["x"]).collect())
    assert D.bounded_profile(df.limit(0), ["x"]).count() == 0


def test_bounded_profile_gives_the_distance_within_its_error(spark):
    df = spark.range(200_000).select(
        F.randn(1).alias("x"), F.exp(F.randn(2) * 2).alias("y"), F.when(F.rand(4) < 0.4, 0.0).otherwise(F.rand(5)).alias("z")
    )
    later = spark.range(20_000).select((F.randn(7) + 0.1).alias("x"), F.exp(F.randn(8)).alias("y"), F.rand(9).alias("z"))
    features = ["x", "y", "z"]
    cur = D.feature_rows(later, features)
    exact = {r.feature: r.distance for r in D.ks_distance(D.feature_rows(df, features), cur).collect()}
    for points, size in ((2048, 4096), (100, 400)):
        near = D.ks_distance(D.bounded_profile(df, features, points, size), cur)
        for r in near.collect():
            assert r.n_ref == 200_000
            assert r.distance == pytest.approx(exact[r.feature], abs=1 / points + D.sketch_rank_error(size))


def test_finite_probability_published_value():
    """The value worked through in the paper that gives the matrix form."""
    assert 1 - D.finite_p_value(10, 0.274) == pytest.approx(0.6284796154565, abs=1e-12)
    assert D.finite_p_value(10, 0.0) == 1.0 and D.finite_p_value(10, 1.0) == 0.0
    assert 0 <= D.finite_p_value(140, 0.99) <= 1e-9


def test_one_row_probability():
    """For one row the distance exceeds d with probability 2 - 2d (d >= 1/2)."""
    assert D.finite_p_value(1, 0.75) == pytest.approx(0.5)


def test_finite_and_corrected_limit_probabilities_meet(spark):
    """On both sides of FINITE_ROWS the p-value is the finite-sample one, to 1.5 percent (or 0.00005)."""
    sizes = [D.FINITE_ROWS - 1, D.FINITE_ROWS, D.FINITE_ROWS + 1, 300]
    rows = [(f"{n} {d}", 10**9, n, d) for n in sizes for d in (0.05, 0.08, 0.11, 0.13, 0.15)]
    df = spark.createDataFrame(rows, "feature string, n_ref bigint, n_cur bigint, distance double")
    for r in D.with_p_value(df).collect():
        assert r.p_value == pytest.approx(D.finite_p_value(r.n_cur, r.distance), rel=0.015, abs=5e-5), r.feature


def test_limit_series_at_small_lambda_is_one(spark):
    df = spark.createDataFrame([("x", 20, 20, 0.0), ("y", 100, 100, 0.02)], "feature string, n_ref bigint, n_cur bigint, distance double")
    assert [r.p_value for r in D.with_p_value(df).collect()] == [1.0, pytest.approx(1.0, abs=1e-9)]


def test_limit_series_known_point(spark):
    df = spark.createDataFrame([("x", 2_000_000, 2_000_000, 1.36 / 1000)], "feature string, n_ref bigint, n_cur bigint, distance double")
    lam = 1.36 + 1 / 6000 + 0.36 / 4e6
    wanted = 2 * sum((-1) ** (k - 1) * math.exp(-2 * k * k * lam * lam) for k in range(1, 50))
    assert D.with_p_value(df).first().p_value == pytest.approx(wanted) == pytest.approx(0.0495, abs=1e-3)


def test_report_and_version_checks(spark):
    versions = spark.createDataFrame(
        [("m", "9", "r9"), ("m", "10", "r10"), ("other", "1", "r1")], "name string, version string, run_id string"
    )
    references = spark.createDataFrame([("r10",)], "run_id string")
    version = D.version_with_reference(versions, references, "m")
    assert version.first().version == "10"
    with pytest.raises(ContractError, match="no reference"):
        D.version_with_reference(versions, references, "other")
    with pytest.raises(ContractError, match="no registered"):
        D.version_with_reference(versions, references, "nothing")
    tested = D.drift_test(frame(spark, x=range(9), y=range(9)), frame(spark, x=range(9), y=range(9)), ["x", "y"])
    report = D.drift_report(tested, version, F.lit("2024-05-06 07:08:09").cast("timestamp_ntz"), 20)
    text = json.loads(report.toJSON().first())
    assert text["timestamp_utc"] == "20240506T070809Z" and text["model_version"] == "10"
    assert [d["feature"] for d in text["preds"]["data"]] == ["x", "y"] and text["preds"]["is_drift"] == 0

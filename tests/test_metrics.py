"""Worked values, and what happens at the edges."""

import json
import math

import pytest
from pyspark.sql import functions as F

from modelyard.operators import classification as C
from modelyard.operators import multilabel as M
from modelyard.operators.regression import regression_metrics, residual_histogram, with_residual
from modelyard.operators.summary import score_spread


def pairs(spark, y, p, kind="int"):
    return spark.createDataFrame(list(zip(y, p)), f"y {kind}, p {kind}")


def scores(spark, y, s):
    return spark.createDataFrame(list(zip(y, s)), "y int, s double")


def test_binary_metrics(spark):
    row = C.binary_metrics(pairs(spark, [0, 1, 1, 1, 0], [0, 1, 0, 1, 0]), "y", "p").first()
    assert (row.tp, row.fp, row.fn, row.tn) == (2, 0, 1, 2)
    assert (row.accuracy, row.precision, row.f1) == (0.8, 1.0, 0.8)
    assert row.recall == pytest.approx(2 / 3)


def test_binary_metrics_without_positives_are_zero(spark):
    row = C.binary_metrics(pairs(spark, [0, 0], [0, 0]), "y", "p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1) == (1.0, 0.0, 0.0, 0.0)


def test_binary_metrics_of_nothing(spark):
    row = C.binary_metrics(pairs(spark, [], []), "y", "p").first()
    assert (row.tp, row.accuracy) == (0, 0.0)


def test_log_loss_and_auc(spark):
    df = scores(spark, [0, 1, 1, 1, 0], [0.1, 0.9, 0.4, 0.8, 0.2])
    assert C.log_loss(df, "y", "s").first()[0] == pytest.approx(0.314660, abs=1e-6)
    assert C.roc_auc(df, "y", "s").first().roc_auc == 1.0


def test_log_loss_clips_certain_probabilities(spark):
    found = C.log_loss(scores(spark, [1, 0], [0.0, 0.0]), "y", "s").first()[0]
    assert math.isfinite(found) and found > 10


def test_auc_counts_ranked_pairs(spark):
    df = scores(spark, [1, 0, 1, 1, 0, 0], [0.95, 0.85, 0.80, 0.70, 0.30, 0.10])
    assert C.roc_auc(df, "y", "s").first().roc_auc == pytest.approx(7 / 9)
    turned = df.withColumn("s", -F.col("s"))
    assert C.roc_auc(turned, "y", "s").first().roc_auc == pytest.approx(2 / 9)


def test_auc_ties_and_single_class(spark):
    assert C.roc_auc(scores(spark, [1, 0], [0.5, 0.5]), "y", "s").first().roc_auc == 0.5
    assert C.roc_auc(scores(spark, [1, 1], [0.5, 0.6]), "y", "s").first().roc_auc is None


def test_roc_curve_and_average_precision(spark):
    df = scores(spark, [0, 0, 1, 1], [0.1, 0.4, 0.35, 0.8])
    points = {r.threshold: (r.tpr, r.fpr) for r in C.roc_curve(df, "y", "s").collect()}
    assert points == {0.8: (0.5, 0.0), 0.4: (0.5, 0.5), 0.35: (1.0, 0.5), 0.1: (1.0, 1.0)}
    assert C.average_precision(df, "y", "s").first()[0] == pytest.approx(0.8333333)


def test_multiclass_averages(spark):
    df = pairs(spark, [0, 1, 2, 1, 0], [0, 2, 1, 1, 0])
    row = C.averaged_metrics(df, "y", "p").first()
    assert row.accuracy == row.micro_precision == row.weighted_precision == pytest.approx(0.6)
    assert row.macro_precision == pytest.approx(0.5)
    per_class = {r["class"]: r.precision for r in C.class_metrics(df, "y", "p").collect()}
    assert per_class == {0: 1.0, 1: 0.5, 2: 0.0}


def test_class_never_predicted_and_class_never_seen(spark):
    found = {r["class"]: r for r in C.class_metrics(pairs(spark, [0, 1], [0, 2]), "y", "p").collect()}
    assert (found[1].precision, found[1].support) == (0.0, 1)
    assert (found[2].recall, found[2].support) == (0.0, 0)


def test_report_rows(spark):
    entries = {r.entry: r for r in C.classification_report(pairs(spark, [0, 1, 1], [0, 1, 0]), "y", "p").collect()}
    assert set(entries) == {"0", "1", "accuracy", "macro avg", "weighted avg"}
    assert entries["accuracy"].precision is None and entries["accuracy"].f1 == pytest.approx(2 / 3)


def test_confusion_forms_agree(spark):
    df = pairs(spark, [0, 1, 2, 1, 0], [0, 2, 1, 1, 0])
    assert C.confusion_json(df, "y", "p").first()[0] == "[[2,0,0],[0,1,1],[0,1,0]]"
    wide = {r.label: (r["0"], r["1"], r["2"]) for r in C.confusion_wide(df, "y", "p", [0, 1, 2]).collect()}
    assert wide == {0: (2, 0, 0), 1: (0, 1, 1), 2: (0, 1, 0)}


def test_predictions_outside_the_listed_classes_are_counted(spark):
    wide = C.confusion_wide(pairs(spark, [0, 0, 1, 1], [0, 7, 1, 0]), "y", "p", [0, 1]).collect()
    assert {r.label: (r["0"], r["1"], r.other) for r in wide} == {0: (1, 0, 1), 1: (1, 1, 0)}


def test_dense_matrix_of_many_classes(spark):
    n = 1100
    matrix = json.loads(C.confusion_json(pairs(spark, range(n), range(n)), "y", "p").first()[0])
    assert len(matrix) == n and all(sum(row) == row[i] == 1 for i, row in enumerate(matrix))


def test_regression_metrics(spark):
    row = regression_metrics(pairs(spark, [3.0, -0.5, 2.0, 7.0], [2.5, 0.0, 2.0, 8.0], "double"), "y", "p").first()
    assert (row.mae, row.mse) == (0.5, 0.375)
    assert row.rmse == pytest.approx(0.612372, abs=1e-6) and row.r2 == pytest.approx(0.948608, abs=1e-6)


def test_logarithmic_errors(spark):
    row = regression_metrics(pairs(spark, [1.0, 2.0, 3.0], [1.1, 1.9, 3.2], "double"), "y", "p").first()
    assert row.msle == pytest.approx(0.001970, abs=1e-6) and row.rmsle == pytest.approx(0.044386, abs=1e-6)
    assert regression_metrics(pairs(spark, [1.0, -1.0], [1.0, 1.0], "double"), "y", "p").first().msle is None


def test_r2_of_a_constant_label(spark):
    assert regression_metrics(pairs(spark, [2.0, 2.0], [2.0, 2.0], "double"), "y", "p").first().r2 == 1.0
    assert regression_metrics(pairs(spark, [2.0, 2.0], [2.0, 3.0], "double"), "y", "p").first().r2 == 0.0


def test_r2_far_from_zero(spark):
    """Subtracting sums of squares would lose every digit here."""
    y = [1e9, 1e9 + 1, 1e9 + 2]
    row = regression_metrics(pairs(spark, y, [1e9, 1e9 + 1, 1e9 + 1], "double"), "y", "p").first()
    assert row.r2 == pytest.approx(0.5)


def test_residuals(spark):
    df = pairs(spark, [3.0, 1.0, 90.0], [1.0, 2.0, 0.0], "double")
    assert [r.residual for r in with_residual(df, "y", "p").collect()] == [2.0, -1.0, 90.0]
    bins = {r.bin: r.n for r in residual_histogram(df, "y", "p", -10, 10, 4).collect()}
    assert bins == {2: 1, 3: 1, 5: 1}


def test_fold_spread_is_the_population_deviation(spark):
    df = spark.createDataFrame([(v,) for v in (0.81, 0.83, 0.78, 0.82, 0.80)], "score double")
    row = score_spread(df, "score").first()
    assert row["mean"] == pytest.approx(0.808) and row["std"] == pytest.approx(0.017205, abs=1e-6)


def test_label_sets(spark):
    rows = [(["a", "b"], ["a"]), (["c"], ["c"]), ([], [])]
    df = spark.createDataFrame(rows, "truth array<string>, guess array<string>")
    row = M.label_set_metrics(df, "truth", "guess", 4).first()
    assert row.subset_accuracy == pytest.approx(2 / 3)
    assert row.hamming_loss == pytest.approx(1 / 12)
    assert row.jaccard == pytest.approx(2.5 / 3)
    counts = {r.label: (r.tp, r.fp, r.fn, r.tn) for r in M.label_confusion(df, "truth", "guess").collect()}
    assert counts == {"a": (1, 0, 0, 2), "b": (0, 0, 1, 2), "c": (1, 0, 0, 2)}


def test_ranking(spark):
    rows = [(["a", "b", "c"], ["a", "c"]), (["x"], [])]
    df = spark.createDataFrame(rows, "ranked array<string>, relevant array<string>")
    row = M.ranking_metrics(df, "ranked", "relevant", 2).first()
    assert row.precision_at_k == pytest.approx(0.25)
    assert row["map"] == pytest.approx((1 + 2 / 3) / 2 / 2)
    assert row.ndcg_at_k == pytest.approx(1 / (1 + 1 / math.log2(3)) / 2)

import math
import threading
from collections import Counter
from functools import partial

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import RandomForestRegressor
from pyspark.sql import functions as F

from modelyard.operators import features as X
from modelyard.operators import models as M
from modelyard.operators import selection as S
from modelyard.operators.cumulative import running_totals
from modelyard.operators.models import save_and_load
from modelyard.operators.regression import regression_metrics
from tests.conftest import plan_of


@pytest.fixture(scope="module")
def line(spark):
    """y depends on a and a little on b; c is noise; kind is a category."""
    noise = lambda i: (F.hash("id", F.lit(i)) % 100) / 100
    return (
        spark.range(400)
        .select("id", noise(1).alias("a"), noise(2).alias("b"), noise(3).alias("c"), F.concat(F.lit("k"), (F.col("id") % 3).cast("string")).alias("kind"))
        .withColumn("y", 10 * F.col("a") + F.col("b") + 0.01 * F.col("c"))
        .withColumn("label", (F.col("a") > 0).cast("int"))
        .cache()
    )


FEATURES = ["a", "b", "c"]


def test_category_order_and_skipped_rows(spark):
    train = spark.createDataFrame([("b",), ("b",), ("c",), ("a",), (None,)], "s string")
    test = spark.createDataFrame([("b",), ("a",), ("z",), (None,)], "s string")
    assert {r.s: r.sIndex for r in X.index_categories(train, test, ["s"]).collect()} == {"b": 0.0, "a": 1.0}


def test_any_number_of_categories_is_indexed(spark, monkeypatch):
    monkeypatch.setattr(X, "running_totals", partial(running_totals, task_rows=10))
    many = spark.range(3000).select(F.concat(F.lit("k"), F.col("id") % 1500).alias("s"))
    found = {r.s: r.sIndex for r in X.index_categories(many, many, ["s"]).collect()}
    assert found == {s: float(i) for i, s in enumerate(sorted(found))} and len(found) == 1500


def test_assembled_columns(line):
    out = Pipeline(stages=X.index_stages(["kind"], ["a"])).fit(line).transform(line)
    assert all(len(r[0]) == 2 for r in out.select(vector_to_array("features")).collect())


def test_scaling_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "x double, same double")
    assert [tuple(r) for r in X.Scaling.fit(df, ["x", "same"]).transform(df).collect()] == [(-1.0, 0.0), (1.0, 0.0)]


def test_indicators(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "s string")
    assert [tuple(r) for r in X.indicators(df, ["s"]).collect()] == [(0,), (1,), (0,)]
    assert X.indicators(df, ["s"], drop_first=False).columns == ["s_a", "s_b"]
    many = spark.range(1200).select(F.concat(F.lit("k"), F.col("id")).alias("s"))
    assert len(X.indicators(many, ["s"]).columns) == 1199


def test_term_weights(spark):
    df = spark.createDataFrame([(1, "Red fish, red"), (2, "red bird"), (3, "a")], "id int, t string")
    found = {(r.id, r.term): r.weight for r in X.term_weights(df, "id", "t").collect()}
    red, rare = math.log(4 / 3) + 1, math.log(4 / 2) + 1
    assert set(found) == {(1, "red"), (1, "fish"), (2, "red"), (2, "bird")}
    assert found[(1, "red")] == pytest.approx(2 * red / math.hypot(2 * red, rare))
    assert found[(2, "bird")] == pytest.approx(rare / math.hypot(red, rare))
    sizes = [len(r.tfidf.indices) for r in X.hashed_term_weights(df, "t", buckets=1 << 10).collect()]
    assert sizes == [2, 2, 0]


def test_term_weights_of_many_parts(spark, monkeypatch):
    """Keys may repeat or be null; no row for each document and term travels, only one for each part and term."""
    monkeypatch.setattr(X, "PART_BYTES", 40)
    rows = [(i if i % 5 else None, f"all w{i % 7} w{i % 7} x{i}") for i in range(60)] + [(7, "all again"), (8, None), (99, "")]
    df = spark.createDataFrame(rows, "id int, t string")
    weights = X.term_weights(df, "id", "t")
    assert "hashpartitioning(id" not in plan_of(weights)
    counts: dict = {}
    for key, text in rows:
        for term in (text or "").split():
            counts.setdefault(key, Counter())[term] += 1
    inside = Counter(term for found in counts.values() for term in found)
    want = {}
    for key, found in counts.items():
        raw = {t: n * (math.log((1 + len(rows)) / (1 + inside[t])) + 1) for t, n in found.items()}
        want |= {(key, t): w / math.hypot(*raw.values()) for t, w in raw.items()}
    got = weights.collect()
    assert len(got) == len(want) and {(r.id, r.term): r.weight for r in got} == pytest.approx(want)


def test_compared_regressors_beat_the_mean(spark, line):
    models = {
        "linear": M.assembled(FEATURES, M.scaled_linear("y")),
        "forest": M.assembled(FEATURES, M.forest_regressor("y", trees=10, depth=5)),
        "boosted": M.assembled(FEATURES, M.boosted_regressor("y", iterations=5, depth=3)),
    }
    board, fitted = M.compare_regressors(line, line, "y", models)
    rows = board.orderBy("rank").collect()
    assert rows[0].model == "linear" and rows[0].rmse < 1e-6 and all(r.r2 > 0 for r in rows)
    for name, model in fitted.items():
        ranked = M.importances(spark, model, FEATURES).orderBy("rank").collect()
        assert ranked[0].feature == "a" and all(r.importance >= 0 for r in ranked), name


def test_default_settings_of_the_compared_models():
    forest = M.forest_regressor("y")[0]
    assert (forest.getNumTrees(), forest.getMaxDepth(), forest.getMinInstancesPerNode(), forest.getSeed()) == (400, 18, 2, 42)
    boosted = M.boosted_regressor("y")[0]
    assert (boosted.getMaxIter(), boosted.getMaxDepth(), boosted.getStepSize()) == (400, 10, 0.08)


@pytest.mark.parametrize("kind", ["random_forest", "logistic_regression", "xgboost", "decision_tree", "linear_svm"])
def test_classifiers_by_name(line, kind):
    params = {"xgboost": {"maxIter": 2}, "random_forest": {"numTrees": 5}}.get(kind, {})
    model = M.assembled(FEATURES, [M.classifier(kind, "label", **params)]).fit(line)
    scored = model.transform(line)
    assert scored.count() == 400
    assert scored.agg(F.avg((F.col("label") == F.col("prediction")).cast("double"))).first()[0] > 0.9


def test_unknown_classifier():
    with pytest.raises(ValueError, match="unsupported model type: lstm"):
        M.classifier("lstm", "label")


def test_depth_sweep(line):
    found = {r.depth: r.accuracy for r in M.depth_sweep(line, line, "label", FEATURES, range(1, 4)).collect()}
    assert set(found) == {1, 2, 3} and found[3] >= 0.9


def test_split_counts(spark, line, tmp_path):
    model = M.assembled(FEATURES, M.forest_regressor("y", trees=3, depth=3)).fit(line)
    found = {r.feature: r.splits for r in M.split_counts(spark, model, FEATURES, str(tmp_path / "m")).collect()}
    assert set(found) == set(FEATURES)
    assert sum(found.values()) == sum((t.numNodes - 1) // 2 for t in model.stages[-1].trees)


def test_saved_model_scores_the_same(line, tmp_path):
    model = M.assembled(FEATURES, M.forest_regressor("y", trees=3, depth=3)).fit(line)
    again = M.save_and_load(model, str(tmp_path / "p"))
    assert again.transform(line).select("id", "prediction").exceptAll(model.transform(line).select("id", "prediction")).count() == 0


def test_parameters(spark):
    found = {r.param: r.value for r in M.effective_params(spark, M.classifier("decision_tree", "label", maxDepth=3)).collect()}
    assert (found["maxDepth"], found["seed"], found["maxBins"]) == ("3", "33", "32")


def test_compared_models_are_fitted_side_by_side(line):
    together, linear = threading.Barrier(2, timeout=60), M.assembled(FEATURES, M.scaled_linear("y"))

    class Meeting:
        def fit(self, rows):
            together.wait()
            return linear.fit(rows)

    board, fitted = M.compare_regressors(line, line, "y", {"one": Meeting(), "two": Meeting()})
    assert [r.model for r in board.orderBy("rank", "model").collect()] == ["one", "two"] == list(fitted)


def test_machines_of_classes_are_fitted_side_by_side():
    assert M.classifier("linear_svm", "label").getParallelism() > 1
    assert M.classifier("kernel_svm", "label").getStages()[-1].getParallelism() > 1


def test_a_search_of_the_last_stage_keeps_what_it_reads(line, monkeypatch):
    seen, fit = [], S.CrossValidator._fit
    monkeypatch.setattr(S.CrossValidator, "_fit", lambda self, df: seen.append(df.columns) or fit(self, df))
    forest = RandomForestRegressor(labelCol="y", numTrees=2, seed=1)
    evaluator = RegressionEvaluator(labelCol="y", predictionCol="prediction")
    folded = S.with_fold(line, ["id"], 2)
    own = S.search_last(X.index_stages([], FEATURES), forest, S.grid(forest, maxDepth=[2, 3]), evaluator, folds=2).fit(folded)
    assert seen == [["features", "y", "fold"]]
    plain = Pipeline(stages=[*X.index_stages([], FEATURES), S.cross_validated(forest, S.grid(forest, maxDepth=[2, 3]), evaluator, folds=2)]).fit(folded)
    assert own.stages[-1].avgMetrics == plain.stages[-1].avgMetrics
    assert "id" in own.transform(line).columns


@pytest.mark.parametrize("search", [S.search_inside, S.search_last])
def test_grid_search(spark, line, search):
    forest = RandomForestRegressor(labelCol="y", maxBins=40, seed=1)
    maps = S.grid(forest, maxDepth=[2, 5], numTrees=[2, 3])
    assert len(maps) == 4
    evaluator = RegressionEvaluator(labelCol="y", predictionCol="prediction", metricName="rmse")
    folded = S.with_fold(line, ["id"], 3)
    assert {r.fold for r in folded.select("fold").distinct().collect()} == {0, 1, 2}
    fitted = search(X.index_stages(["kind"], FEATURES), forest, maps, evaluator).fit(folded)
    searched = fitted if search is S.search_inside else fitted.stages[-1]
    results = S.search_results(spark, searched).collect()
    assert {(r.maxDepth, r.numTrees) for r in results} == {("2", "2"), ("2", "3"), ("5", "2"), ("5", "3")}
    assert all(r.avg_rmse > 0 for r in results)


def test_fold_scores(line):
    score = lambda df: regression_metrics(df, "y", "prediction").select(F.col("rmse").alias("score"))
    rows = S.fold_scores(line, M.assembled(FEATURES, M.scaled_linear("y")), score, ["id"], folds=3).collect()
    assert [r.fold for r in rows] == [0, 1, 2] and all(r.score < 1e-6 for r in rows)


def test_evaluators_agree_with_the_metrics(line):
    scored = line.withColumn("prediction", F.col("a") * 9.0)
    row, scores = regression_metrics(scored, "y", "prediction").first(), S.regression_scores(scored, "y")
    assert scores["rmse"] == pytest.approx(row.rmse) and scores["r2"] == pytest.approx(row.r2)


def test_index_stage_is_a_table(spark, tmp_path):
    """Ranks as MLlib's indexer gives them, nulls and unseen categories skipped, kept with the saved pipeline."""
    rows = [("b", 1, 1.0), ("b", 2, 2.0), ("a", 2, 3.0), ("c", 1, 4.0), ("c", 3, 5.0), (None, 1, 6.0), ("a", None, 7.0)]
    train = spark.createDataFrame(rows, "kind string, size int, x double")
    stage = X.TableIndexer(["kind", "size"], ["k", "s"])
    known = StringIndexer(inputCols=["kind", "size"], outputCols=["k", "s"], handleInvalid="skip").fit(train).transform(train)
    model = Pipeline(stages=[stage, *X.index_stages([], ["k", "s", "x"])]).fit(train)
    found = model.transform(train)
    assert sorted(found.select("x", "k", "s").collect()) == sorted(known.select("x", "k", "s").collect())
    assert found.columns == ["kind", "size", "x", "k", "s", "features"]
    attributes = found.schema["features"].metadata["ml_attr"]["attrs"]
    assert [(a["name"], a["num_vals"]) for a in attributes["nominal"]] == [("k", 3), ("s", 3)]
    again = save_and_load(model, str(tmp_path / "saved"))
    other = train.limit(0).unionAll(spark.createDataFrame([("a", 2, 0.0), ("new", 2, 1.0), ("c", 9, 2.0)], train.schema))
    for m in (model, again):
        assert [(r.x, r.k) for r in m.transform(other).collect()] == [(0.0, 0.0)]
    assert again.stages[0].path.startswith(str(tmp_path / "saved"))
    empty = stage.fit(train.limit(0))
    assert empty.transform(train).count() == 0

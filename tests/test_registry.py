import datetime as dt

import pytest
from pyspark.sql import functions as F

from modelyard.operators import registry as R


@pytest.fixture
def versions(spark):
    rows = [
        ("m", "9", "r1", ["champion"], "Production"),
        ("m", "10", "r2", ["challenger", "champion"], "None"),
        ("n", "1", "r3", [], "None"),
    ]
    return spark.createDataFrame(rows, "name string, version string, run_id string, aliases array<string>, stage string")


@pytest.fixture
def metrics(spark):
    return spark.createDataFrame(
        [("r1", "accuracy", 0.8), ("r2", "loss", 3.0), ("r3", "accuracy", -1.0)], "run_id string, key string, value double"
    )


def test_latest_version_is_numeric(versions):
    assert {r.name: r.version for r in R.latest_version(versions).collect()} == {"m": "10", "n": "1"}
    assert {r.stage: r.version for r in R.latest_version(versions.filter("name = 'm'"), ["name", "stage"]).collect()} == {
        "Production": "9", "None": "10"
    }


def test_champions_match_the_whole_alias_list(versions):
    assert [r.version for r in R.champions(versions).collect()] == ["9"]
    counts = {r.name: (r.n_versions, r.n_champions, r.latest_version) for r in R.version_counts(versions).collect()}
    assert counts == {"m": (2, 1, 10), "n": (1, 0, 1)}
    assert R.with_uri(versions).filter("version = '10'").first().uri == "models:/m/10"


def test_best_value_has_a_floor_and_missing_metrics_count_as_zero(versions, metrics):
    scored = R.version_metric(versions, metrics, "accuracy")
    assert {r.version: r.value for r in scored.collect()} == {"9": 0.8, "10": 0.0, "1": -1.0}
    assert {r.name: r.best_value for r in R.best_value(scored).collect()} == {"m": 0.8, "n": 0.0}


@pytest.mark.parametrize(
    ("value", "rule", "register", "reason"),
    [
        (0.8, {}, True, R.THRESHOLD),
        (0.8, {"op": ">"}, False, None),
        (0.805, {"op": ">", "min_gain": 0.01}, False, None),
        (0.82, {"op": ">", "min_gain": 0.01}, True, R.THRESHOLD),
        (0.1, {"force": True}, True, R.FORCED),
        (None, {}, False, None),
    ],
)
def test_promotion(spark, versions, metrics, value, rule, register, reason):
    candidate = spark.createDataFrame([("m", "new", value)], "name string, run_id string, new_value double")
    best = R.best_value(R.version_metric(versions, metrics, "accuracy"))
    row = R.promotion(candidate, best, **rule).first()
    assert (row.register, row.reason) == (register, reason)


def test_first_registration_and_next_number(spark, versions, metrics):
    candidates = spark.createDataFrame(
        [("m", "a", 0.9), ("brand_new", "b", -3.0)], "name string, run_id string, new_value double"
    )
    decided = R.promotion(candidates, R.best_value(R.version_metric(versions, metrics, "accuracy")))
    assert {r.name: r.reason for r in decided.collect()} == {"m": R.THRESHOLD, "brand_new": R.FIRST}
    assert {r.name: r.version for r in R.next_versions(decided, versions).collect()} == {"m": "11", "brand_new": "1"}


def test_unknown_comparison(versions):
    with pytest.raises(ValueError):
        R.promotion(versions, versions, op="<")


def test_alias_and_stage_moves(versions):
    target = versions.filter("name = 'm' AND version = '10'")
    moved = {r.version: sorted(r.aliases) for r in R.move_alias(versions, "champion", target).collect()}
    assert moved == {"9": [], "10": ["challenger", "champion"], "1": []}
    staged = {r.version: r.stage for r in R.move_stage(versions, "Production", target).collect()}
    assert staged == {"9": "Archived", "10": "Production", "1": "None"}


def test_search_and_ranking(spark):
    at = lambda d: dt.datetime(2024, 1, d)
    runs = spark.createDataFrame(
        [("a", "e1", "FINISHED", at(1), {"use_case": "x"}), ("b", "e1", "FAILED", at(3), {}), ("c", "e2", "FINISHED", at(3), {"use_case": "y"}),
         ("d", "e1", "FINISHED", at(3), {})],
        "run_id string, experiment string, status string, start_time timestamp, tags map<string,string>",
    )
    assert {r.run_id for r in R.finished(runs, ["e1"]).collect()} == {"a", "d"}
    assert [r.run_id for r in R.with_tag(runs, "use_case", "x").collect()] == ["a"]
    assert [r.run_id for r in R.newest_runs(runs, 2).collect()] == ["b", "c"]
    assert {r.experiment: r.run_id for r in R.newest_per_experiment(runs).collect()} == {"e1": "b", "e2": "c"}
    metrics = R.unfold_metrics(
        spark.createDataFrame([("a", 0.1, None), ("c", 0.1, 5.0)], "id string, toxicity double, latency double"), "id", ["toxicity", "latency"]
    )
    assert metrics.count() == 3
    wide = R.search_wide(runs, metrics, spark.createDataFrame([("a", "prompt", "p")], "run_id string, key string, value string"), ["toxicity"], ["prompt"])
    found = {r.run_id: (r["metrics.toxicity"], r["params.prompt"]) for r in wide.collect()}
    assert found == {"a": (0.1, "p"), "b": (None, None), "c": (0.1, None), "d": (None, None)}


def test_best_prompt_orders_by_three_keys(spark):
    schema = "run_id string, status string, prompt string, toxicity double, rouge2 double, latency double"
    rows = [
        ("1", "FAILED", "p1", 0.0, 1.0, 0.0), ("2", "FINISHED", "p2", 0.1, 0.5, 9.0), ("3", "FINISHED", "p3", 0.1, 0.7, 9.0),
        ("4", "FINISHED", "p4", 0.1, 0.7, 1.0), ("5", "FINISHED", "p5", None, 0.9, 0.1),
    ]
    df = spark.createDataFrame(rows, schema)
    assert R.best_prompt(df).first().prompt == "p4"
    assert R.best_prompt(df.filter("status = 'FAILED'")).first() is None


def test_leaderboard(spark):
    df = spark.createDataFrame([("b", 2.0), ("a", 2.0), ("c", 1.0)], "model string, rmse double")
    assert [(r.rank, r.model) for r in R.leaderboard(df).orderBy("rank").collect()] == [(1, "c"), (2, "a"), (3, "b")]
    assert R.leaderboard(df, descending=True).filter(F.col("rank") == 3).first().model == "c"

"""Whole jobs and streams: gates stop them, reruns change nothing, streams equal batches."""

import json
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from modelyard.operators.contract import ContractError
from modelyard.operators.conversations import histories
from modelyard.operators.models import assembled, scaled_linear
from modelyard.operators.report import markdown_table
from modelyard.plans import regression
from modelyard.plans.monitoring import DONE, SKIPPED, ScoringJob
from modelyard.plans.regression import RegressionJob
from modelyard.plans.table_lab import load
from modelyard.plans.training import TrainingJob
from modelyard.sources.commits import put
from modelyard.sources.predictions import PredictionTable
from modelyard.sources.sinks import write_csv
from modelyard.sources.tracking import Tracking
from modelyard.streaming.jobs import arriving, current_histories, stream_histories, stream_routes, stream_scoring
from tests.conftest import plan_of

FLOWER = ["sepal_length", "petal_length"]


@pytest.fixture(scope="module")
def flowers(spark):
    """Three species that the two lengths tell apart."""
    size = F.col("id") % 3
    return spark.range(240).select(
        "id",
        (5.0 + size + F.col("id") % 7 * 0.05).alias("sepal_length"),
        (1.0 + 2 * size + F.col("id") % 5 * 0.1).alias("petal_length"),
        F.element_at(F.array(*[F.lit(s) for s in ("setosa", "versicolor", "virginica")]), (size + 1).cast("int")).alias("species"),
    ).cache()


def training(spark, root, **options):
    return TrainingJob(Tracking(spark, str(root)), "iris", "exp", FLOWER, "species", ["id"], model_type="decision_tree", **options)


@pytest.fixture
def scoring(spark, flowers, tmp_path):
    job = training(spark, tmp_path / "tracking")
    job.run(flowers)
    schema = flowers.select("id", *FLOWER, F.lit("x").alias("prediction")).schema
    stored = PredictionTable(spark, str(tmp_path / "predictions"), schema, ["id"])
    return ScoringJob(job.tracking, "iris", FLOWER, stored, str(tmp_path / "reports"))


def test_training_registers_what_is_not_worse(spark, flowers, tmp_path):
    job = training(spark, tmp_path)
    first = job.run(flowers).first()
    assert (first.register, first.reason, first.new_value) == (True, "first_registration_or_registry_missing", 1.0)
    again = job.run(flowers).first()
    assert (again.register, again.reason, again.best_value) == (True, "metric_threshold", 1.0)
    worse = flowers.withColumn("species", F.when(F.col("id") % 2 == 0, "setosa").otherwise(F.col("species")))
    assert not job.run(worse.withColumn("petal_length", F.lit(1.0)).withColumn("sepal_length", F.lit(1.0))).first().register
    forced = training(spark, tmp_path, force=True)
    assert forced.run(flowers.withColumn("petal_length", F.lit(1.0)).withColumn("sepal_length", F.lit(1.0))).first().reason == "forced_by_flag"
    versions = job.tracking.read("model_versions")
    assert sorted(int(r.version) for r in versions.collect()) == [1, 2, 3]
    assert job.tracking.read("runs").count() == 4
    assert {r.key for r in job.tracking.read("metrics").select("key").distinct().collect()} == {"accuracy", "precision"}


def test_a_stopped_run_is_failed(spark, flowers, tmp_path):
    job = training(spark, tmp_path)
    job.run(flowers)
    with pytest.raises(Exception, match="no_such_column"):
        training(spark, tmp_path, params={}).__class__(job.tracking, "iris", "exp", ["no_such_column"], "species", ["id"]).run(flowers)
    runs = job.tracking.read("runs")
    assert sorted(r.status for r in runs.collect()) == ["FAILED", "FINISHED"]
    assert runs.filter("status = 'FINISHED'").first().tags["has_drift_detector"] == "true"
    assert job.tracking.read("model_versions").count() == 1


def test_metrics_have_steps(spark, tmp_path):
    tracking = Tracking(spark, str(tmp_path))
    for step, loss in ((0, 3.0), (2, 1.0), (1, 2.0)):
        tracking.log_metrics("r", {"loss": loss}, step)
    tracking.log_metrics("r", {"loss": 0.5}, 2)
    assert [(r.key, r.value, r.step) for r in tracking.last_metrics().collect()] == [("loss", 0.5, 2)]
    assert tracking.read("metrics").count() == 4


def test_two_jobs_that_register_at_once_get_different_versions(spark, tmp_path):
    tracking = Tracking(spark, str(tmp_path))
    with ThreadPoolExecutor(4) as pool:
        versions = list(pool.map(lambda i: tracking.register("m/odd name", f"run{i}"), range(6)))
    assert sorted(map(int, versions)) == [1, 2, 3, 4, 5, 6]
    found = {r.version: r.run_id for r in tracking.read("model_versions").filter("name = 'm/odd name'").collect()}
    assert len(set(found.values())) == 6 and tracking.register("other", "r") == "1"


def test_champion_scoring(spark, flowers, scoring):
    """The first version is made champion; a later one is not used for scoring."""
    later = training(spark, scoring.tracking.root, force=True)
    later.run(flowers.withColumn("species", F.lit("setosa")))
    versions = scoring.tracking.read("model_versions").collect()
    first = next(v for v in versions if v.version == "1")
    put(spark, f"{scoring.tracking.path('model_versions')}/alias/1.json", json.dumps({**first.asDict(), "aliases": ["champion"]}))
    best = ScoringJob(scoring.tracking, "iris", FLOWER, scoring.predictions, scoring.reports, champion=True)
    assert best.score(flowers).select("prediction").distinct().count() == 3
    assert scoring.score(flowers).select("prediction").distinct().count() == 1


def test_training_leaves_out_incomplete_rows(spark, flowers, tmp_path):
    holes = flowers.withColumn("petal_length", F.when(F.col("id") >= 60, F.col("petal_length")))
    job = training(spark, tmp_path, metrics="accuracy")
    job.run(holes)
    assert job.tracking.read("references").filter("feature = 'petal_length'").agg(F.sum("n")).first()[0] == 144


def test_scoring_needs_twenty_rows_to_monitor(spark, flowers, scoring, tmp_path):
    assert scoring.run(flowers.filter("id < 15"), 0) == SKIPPED
    assert scoring.run(flowers, 1) == DONE
    report = spark.read.json(str(tmp_path / "reports" / "latest")).first()
    assert (report.model_name, report.model_version, report.window_size) == ("iris", "1", 20)
    assert [d.feature for d in report.preds.data] == sorted(FLOWER)
    rows = scoring.predictions.read()
    stored = rows.count()
    assert stored == rows.select(*FLOWER, "prediction").distinct().count()
    assert scoring.run(flowers, 1) == DONE and scoring.predictions.read().count() == stored


def test_scoring_without_a_model_is_an_error(spark, flowers, tmp_path):
    stored = PredictionTable(spark, str(tmp_path / "p"), flowers.select("id").schema, ["id"])
    job = ScoringJob(Tracking(spark, str(tmp_path / "none")), "iris", FLOWER, stored, str(tmp_path / "r"))
    with pytest.raises(ContractError, match="no registered version"):
        job.run(flowers, 0)


def test_streamed_scoring_equals_batches(spark, flowers, scoring, tmp_path):
    source = str(tmp_path / "arriving")
    flowers.filter("id < 100").coalesce(1).write.parquet(source)
    flowers.filter("id >= 100").coalesce(1).write.mode("append").parquet(source)
    rows = arriving(spark, source, flowers.schema, files_per_batch=1)
    stream_scoring(rows, scoring, str(tmp_path / "checkpoint")).awaitTermination()
    streamed = scoring.predictions.read()
    assert {r.batch for r in streamed.select("batch").distinct().collect()} <= {0, 1}
    wanted = scoring.score(flowers).select(*FLOWER, "prediction").distinct()
    assert streamed.select(*FLOWER, "prediction").exceptAll(wanted).count() == 0 and streamed.count() == wanted.count()
    # Nothing new has arrived: another start changes nothing.
    stream_scoring(rows, scoring, str(tmp_path / "checkpoint")).awaitTermination()
    assert scoring.predictions.read().count() == wanted.count()


def test_streamed_histories_equal_batch(spark, folder, tmp_path):
    messages = spark.read.parquet(f"{folder}/conversations.parquet")
    source = str(tmp_path / "messages")
    messages.filter("turn < 2").coalesce(1).write.parquet(source)
    messages.filter("turn >= 2").coalesce(1).write.mode("append").parquet(source)
    stream = arriving(spark, source, messages.schema, files_per_batch=1)
    stream_histories(stream, str(tmp_path / "out"), str(tmp_path / "cp"), turns=3).awaitTermination()
    streamed = current_histories(spark, str(tmp_path / "out"))
    assert streamed.exceptAll(histories(messages, 3).select(streamed.columns)).count() == 0
    assert streamed.agg(F.sum("n_turns")).first()[0] == messages.count()


def test_histories_keep_no_state_over_many_batches(spark, folder, tmp_path):
    """Late and repeated turns, one file at a time: the batch result, and nothing kept between batches."""
    messages = spark.read.parquet(f"{folder}/conversations.parquet")
    messages = messages.unionAll(messages.filter("conv_id % 7 = 0")).filter("conv_id < 40")
    for part in range(8):
        few = messages.filter(F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == part)
        few.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    out = str(tmp_path / "out")
    stream = arriving(spark, str(tmp_path / "in"), messages.schema, files_per_batch=1)
    query = stream_histories(stream, out, str(tmp_path / "cp"), turns=4)
    query.awaitTermination()
    batches = [p for p in query.recentProgress if p.numInputRows]
    assert len(batches) == 8 and not any(p.stateOperators for p in batches)
    assert spark.read.parquet(out).agg(F.sum("n_turns")).first()[0] == messages.count(), "every turn is written once"
    streamed, whole = current_histories(spark, out), histories(messages, 4)
    assert sorted(streamed.collect()) == sorted(whole.select(streamed.columns).collect())
    assert "PushedFilters: [IsNotNull(conv_id), EqualTo(conv_id,7)]" in plan_of(streamed.filter("conv_id = 7"))


def test_bounded_profile_in_a_job(spark, flowers, tmp_path):
    job = training(spark, tmp_path, profile_points=4)
    job.run(flowers)
    profile = job.tracking.read("references").groupBy("feature").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    assert {(r.feature, r.rows <= 4, r.n) for r in profile.collect()} == {(f, True, 192) for f in FLOWER}


def test_streamed_routes(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "user bigint, kind string")
    rows.write.parquet(str(tmp_path / "in"))
    stream = arriving(spark, str(tmp_path / "in"), rows.schema)
    stream_routes(stream, "user", [1], F.col("kind"), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert {r.user: r.handler for r in spark.read.parquet(str(tmp_path / "out")).collect()} == {1: "a", 2: "deny"}


def regression_job(spark, root, **options):
    models = {"linear_regression": assembled(["x"], scaled_linear("target"))}
    settings = {"label_range": (0.0, 5.5), "rmse_band": (0.0, 2.0), "models": models, **options}
    return RegressionJob(spark=spark, root=str(root), key=["id"], label="target", features=["x"], **settings)


@pytest.fixture(scope="module")
def houses(spark):
    x = (F.col("id") % 50) / 10
    return spark.range(300).select("id", x.alias("x"), (x + (F.hash("id") % 100) / 1000 + 0.2).alias("target")).cache()


def test_held_out_rows_are_scored_once_for_the_board(spark, houses, tmp_path, monkeypatch):
    kept = {}
    for writer in ("write_single_csv", "write_document"):
        write = getattr(regression, writer)
        monkeypatch.setattr(regression, writer, lambda df, path, write=write: (kept.update({path: df.storageLevel.useMemory}), write(df, path)))
    job = regression_job(spark, tmp_path)
    job.prepare(houses)
    job.train()
    assert kept[job.path("leaderboard")] and kept[job.path("metrics")]


def test_regression_job(spark, houses, tmp_path):
    job = regression_job(spark, tmp_path)
    text = job.run(houses).first().report
    for line in ("- rows learnt from: `240`", "- rows held out: `60`", "- outcome: `passed`", "| model | rmse | mae | r2 |", "Kept: `linear_regression`"):
        assert line in text
    assert spark.read.text(str(tmp_path / "report")).first() is not None
    assert spark.read.json(str(tmp_path / "data_summary")).first().n_rows == 300


def test_regression_gates(spark, houses, tmp_path):
    with pytest.raises(ContractError, match="contract"):
        regression_job(spark, tmp_path / "a", label_range=(0.0, 1.0)).run(houses)
    with pytest.raises(ContractError, match="rmse out of the expected band"):
        regression_job(spark, tmp_path / "b", rmse_band=(1.0, 2.0)).run(houses)
    with pytest.raises(FileNotFoundError, match="data_validation.*smoke_train.*metrics"):
        regression_job(spark, tmp_path / "c").report()


def test_markdown(spark):
    board = spark.createDataFrame([(2, "b", 1.5), (1, "a", 0.25)], "rank int, model string, rmse double")
    wanted = "| model | rmse |\n|---|---:|\n| a | 0.2500 |\n| b | 1.5000 |"
    assert markdown_table(board, ["model", "rmse"]).first().markdown == wanted


def test_csv_to_table(spark, houses, tmp_path):
    write_csv(houses, str(tmp_path / "csv"))
    assert load(spark, str(tmp_path / "csv"), "houses", houses.schema, str(tmp_path / "t")).count() == 300

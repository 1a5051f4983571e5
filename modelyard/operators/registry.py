"""Runs and model versions as tables: search, ranking, promotion, aliases.

Tables
    runs            run_id, experiment, status, start_time, tags map
    metrics         run_id, key, value double
    params          run_id, key, value string
    model_versions  name, version (text), run_id, aliases array, stage
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelyard.functions.scalars import version_uri
from modelyard.operators.align import keyed_join

CHAMPION = "champion"
FINISHED = "FINISHED"
# Why a version was registered.
FORCED, THRESHOLD, FIRST = "forced_by_flag", "metric_threshold", "first_registration_or_registry_missing"


# --- logging and search ----------------------------------------------------


def unfold_metrics(wide: DataFrame, run_id: str, keys: list[str]) -> DataFrame:
    """Long (run_id, key, value) rows from one column per metric; nulls are not logged."""
    rows = F.array(*[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys])
    return wide.select(F.col(run_id).alias("run_id"), F.inline(rows)).filter(F.col("value").isNotNull())


def log_rows(table: DataFrame, path: str) -> None:
    table.write.mode("append").parquet(path)


def finished(runs: DataFrame, experiments: list | None = None) -> DataFrame:
    kept = runs.filter(F.col("status") == FINISHED)
    return kept.filter(F.col("experiment").isin(experiments)) if experiments else kept


def with_tag(runs: DataFrame, key: str, value: str) -> DataFrame:
    """Runs whose tag has the value; runs without the tag are passed over."""
    return runs.filter(F.try_element_at("tags", F.lit(key)) == value)


def search_wide(runs: DataFrame, metrics: DataFrame, params: DataFrame, metric_keys: list, param_keys: list) -> DataFrame:
    """One row per run with ``metrics.<key>`` and ``params.<key>`` columns.

    Both long tables are summed up per run before the join, each with one
    conditional column per key, so a run costs one row in every shuffle.
    """
    def spread(table: DataFrame, prefix: str, keys: list) -> DataFrame:
        picked = [F.max(F.when(F.col("key") == k, F.col("value"))).alias(f"{prefix}.{k}") for k in keys]
        return table.filter(F.col("key").isin(keys)).groupBy("run_id").agg(*picked)

    return runs.join(spread(metrics, "metrics", metric_keys), "run_id", "left").join(
        spread(params, "params", param_keys), "run_id", "left"
    )


def best_run(runs: DataFrame, order: list[Column], n: int = 1) -> DataFrame:
    return runs.orderBy(*order).limit(n)


def best_prompt(evaluations: DataFrame, experiments: list[str] | DataFrame | None = None) -> DataFrame:
    """At most one finished run, of the named experiments (a list, or a frame with
    ``experiment``) or of any: least toxic, then closest to the target, then fastest."""
    if isinstance(experiments, DataFrame):
        evaluations = evaluations.join(experiments, "experiment", "left_semi")
    elif experiments is not None:
        evaluations = evaluations.filter(F.col("experiment").isin(experiments))
    return best_run(
        evaluations.filter(F.col("status") == FINISHED),
        [F.asc_nulls_last("toxicity"), F.desc_nulls_last("rouge2"), F.asc_nulls_last("latency"), F.asc("run_id")],
    )


def newest_runs(runs: DataFrame, n: int = 1) -> DataFrame:
    return runs.orderBy(F.desc("start_time"), "run_id").limit(n)


def newest_per_experiment(runs: DataFrame) -> DataFrame:
    """The latest run of each experiment, the smaller id on equal times.

    ``max_by``-style aggregation: partial results merge before the shuffle, so a
    large experiment is not sorted in one task.
    """
    latest = runs.groupBy("experiment", "start_time").agg(F.min("run_id").alias("run_id"))
    top = F.max(F.struct("start_time", "run_id")).alias("top")
    return latest.groupBy("experiment").agg(top).select("experiment", "top.start_time", "top.run_id")


# --- leaderboard -----------------------------------------------------------


def leaderboard(scores: DataFrame, metric: str = "rmse", name: str = "model", descending: bool = False) -> DataFrame:
    """Rows with their ``rank``; a leaderboard has one row per model, so one task sorts it."""
    order = [F.desc(metric) if descending else F.asc(metric), F.asc(name)]
    return scores.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


# --- versions --------------------------------------------------------------


def with_uri(versions: DataFrame) -> DataFrame:
    return versions.withColumn("uri", version_uri(F.col("name"), F.col("version")))


def champions(versions: DataFrame) -> DataFrame:
    """Versions whose alias list is exactly the champion alias."""
    return versions.filter(F.col("aliases") == F.array(F.lit(CHAMPION)))


def last_champion(versions: DataFrame, by: list[str] = ("name",)) -> DataFrame:
    """The highest version of each model that is its champion."""
    return latest_version(champions(versions), by)


def number(version: Column) -> Column:
    return version.cast("int")


def latest_version(versions: DataFrame, by: list[str] = ("name",)) -> DataFrame:
    """Highest version per group, compared as numbers ("10" after "9")."""
    rest = [c for c in versions.columns if c not in by]
    top = F.max_by(F.struct(*rest), number(F.col("version"))).alias("top")
    return versions.groupBy(*by).agg(top).select(*by, "top.*")


def version_counts(versions: DataFrame) -> DataFrame:
    return versions.groupBy("name").agg(
        F.count("*").alias("n_versions"),
        F.count_if(F.col("aliases") == F.array(F.lit(CHAMPION))).alias("n_champions"),
        F.max(number(F.col("version"))).alias("latest_version"),
    )


def version_metric(versions: DataFrame, metrics: DataFrame, key: str) -> DataFrame:
    """Each version with its run's metric, 0 when the run never logged it."""
    wanted = metrics.filter(F.col("key") == key).select("run_id", "value")
    return versions.join(wanted, "run_id", "left").withColumn("value", F.coalesce("value", F.lit(0.0)))


def best_value(scored_versions: DataFrame, by: list[str] = ("name",)) -> DataFrame:
    """Highest metric per model, never below 0."""
    return scored_versions.groupBy(*by).agg(
        F.greatest(F.coalesce(F.max("value"), F.lit(0.0)), F.lit(0.0)).alias("best_value")
    )


def promotion(
    candidates: DataFrame, best: DataFrame, op: str = ">=", min_gain: float = 0.0, force: bool = False
) -> DataFrame:
    """Candidates (name, run_id, new_value) with ``register`` and ``reason``.

    ``op`` compares the new value with the best one plus ``min_gain``. A model
    without earlier versions is always registered.
    """
    if op not in (">=", ">"):
        raise ValueError(f"op must be '>=' or '>', got {op!r}")
    joined = candidates.join(best, "name", "left")
    new, bar = F.coalesce("new_value", F.lit(0.0)), F.col("best_value") + F.lit(min_gain)
    better = new >= bar if op == ">=" else new > bar
    first = F.col("best_value").isNull()
    reason = F.when(first, FIRST).when(F.lit(force), FORCED).when(better, THRESHOLD)
    return joined.withColumn("register", first | F.lit(force) | F.coalesce(better, F.lit(False))).withColumn(
        "reason", reason
    )


def next_versions(decided: DataFrame, versions: DataFrame) -> DataFrame:
    """New version rows for the candidates to register, one per model."""
    current = versions.groupBy("name").agg(F.max(number(F.col("version"))).alias("_last"))
    return (
        decided.filter("register")
        .select("name", "run_id")
        .join(current, "name", "left")
        .select(
            "name",
            (F.coalesce("_last", F.lit(0)) + 1).cast("string").alias("version"),
            "run_id",
            F.array().cast("array<string>").alias("aliases"),
            F.lit("None").alias("stage"),
        )
    )


def move_alias(versions: DataFrame, alias: str, targets: DataFrame) -> DataFrame:
    """The alias on exactly the (name, version) pairs in ``targets``; for models
    not named there nothing changes."""
    chosen = targets.select("name", F.col("version").alias("_version"))
    has = F.array(F.lit(alias))
    moved = (
        F.when(F.col("_version").isNull(), F.col("aliases"))
        .when(F.col("_version") == F.col("version"), F.array_union("aliases", has))
        .otherwise(F.array_except("aliases", has))
    )
    return keyed_join(versions, chosen, "name", "left").withColumn("aliases", moved).drop("_version")


def move_stage(versions: DataFrame, stage: str, targets: DataFrame, archive: str = "Archived") -> DataFrame:
    """The chosen version enters the stage; the one that was there is archived."""
    chosen = targets.select("name", F.col("version").alias("_version"))
    moved = (
        F.when(F.col("_version") == F.col("version"), F.lit(stage))
        .when(F.col("_version").isNotNull() & (F.col("stage") == stage), F.lit(archive))
        .otherwise(F.col("stage"))
    )
    return keyed_join(versions, chosen, "name", "left").withColumn("stage", moved).drop("_version")

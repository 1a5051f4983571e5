"""Run tables, ranking, model versions and promotion.

The orders table stands in for the tracking tables: an order is a run, its
customer the experiment or model, its status the run's status, its price the metric.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.functions.scalars import has_name, is_true, run_stamp, run_uri, utc_stamp, value_or
from modelyard.operators.registry import (
    best_prompt,
    best_value,
    champions,
    finished,
    last_champion,
    latest_version,
    log_rows,
    move_alias,
    move_stage,
    newest_per_experiment,
    newest_runs,
    next_versions,
    promotion,
    search_wide,
    unfold_metrics,
    version_counts,
    version_metric,
    with_tag,
    with_uri,
)
from modelyard.operators.summary import label_summary
from modelyard.queries import query, rounded, table
from modelyard.session import scratch_path

RUNS = """runs AS (SELECT o_orderkey AS run_id, o_custkey AS experiment,
    CASE o_orderstatus WHEN 'F' THEN 'FINISHED' WHEN 'O' THEN 'RUNNING' ELSE 'FAILED' END AS status,
    o_orderdate AS start_time,
    CASE o_orderpriority WHEN '5-LOW' THEN NULL ELSE lower(o_orderpriority) END AS use_case FROM orders)"""
WIDE = """wide AS (SELECT o_orderkey AS run_id, o_totalprice / 500000 AS accuracy,
    CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000 END AS latency,
    (o_custkey % 7)::DOUBLE AS toxicity, ((o_orderkey % 11) / 11)::DOUBLE AS rouge2 FROM orders)"""
VERSIONS = """versions AS (SELECT concat('model_', o_custkey) AS name, o_orderkey::VARCHAR AS version, o_orderkey AS run_id,
    CASE o_orderstatus WHEN 'F' THEN ['champion'] WHEN 'O' THEN ['challenger', 'champion'] ELSE []::VARCHAR[] END AS aliases,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'Production' WHEN '2-HIGH' THEN 'Staging' ELSE 'None' END AS stage FROM orders)"""
SCORED = """scored AS (SELECT v.*, coalesce(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice / 1000 END, 0) AS value
    FROM versions v JOIN orders ON run_id = o_orderkey)"""


def run_table(spark, folder) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "FINISHED").when(F.col("o_orderstatus") == "O", "RUNNING")
    tagged = F.when(
        F.col("o_orderpriority") != "5-LOW", F.create_map(F.lit("use_case"), F.lower("o_orderpriority"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_custkey").alias("experiment"),
        status.otherwise("FAILED").alias("status"),
        F.col("o_orderdate").alias("start_time"),
        tagged.alias("tags"),
    )


def wide_metrics(spark, folder) -> DataFrame:
    price = F.col("o_totalprice")
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        (price / 500000).alias("accuracy"),
        F.when(F.col("o_orderstatus") != "P", price / 1000).alias("latency"),
        (F.col("o_custkey") % 7).cast("double").alias("toxicity"),
        ((F.col("o_orderkey") % 11) / F.lit(11.0)).alias("rouge2"),
    )


def metric_table(spark, folder) -> DataFrame:
    return unfold_metrics(wide_metrics(spark, folder), "run_id", ["accuracy", "latency", "toxicity", "rouge2"])


def param_table(spark, folder) -> DataFrame:
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("run_id"), F.lit("prompt").alias("key"), F.col("o_orderpriority").alias("value")
    )


def version_table(spark, folder) -> DataFrame:
    status, priority = F.col("o_orderstatus"), F.col("o_orderpriority")
    aliases = (
        F.when(status == "F", F.array(F.lit("champion")))
        .when(status == "O", F.array(F.lit("challenger"), F.lit("champion")))
        .otherwise(F.array().cast("array<string>"))
    )
    stage = F.when(priority == "1-URGENT", "Production").when(priority == "2-HIGH", "Staging").otherwise("None")
    return table(spark, folder, "orders").select(
        F.concat(F.lit("model_"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderkey").cast("string").alias("version"),
        F.col("o_orderkey").alias("run_id"),
        aliases.alias("aliases"),
        stage.alias("stage"),
    )


def joined_aliases(df: DataFrame) -> DataFrame:
    return df.withColumn("aliases", F.array_join("aliases", ","))


# --- search -------------------------------------------------------------------


@query("finished_runs", "P16", f"WITH {RUNS} SELECT run_id, experiment, start_time FROM runs WHERE status = 'FINISHED'")
def finished_runs(spark, folder):
    return finished(run_table(spark, folder)).select("run_id", "experiment", "start_time")


@query("tagged_runs", "P17 F9", f"WITH {RUNS} SELECT run_id, status FROM runs WHERE use_case = '2-high'")
def tagged_runs(spark, folder):
    return with_tag(run_table(spark, folder), "use_case", "2-high").select("run_id", "status")


@query(
    "logged_metrics",
    "R1",
    f"""WITH {WIDE}, l AS (SELECT run_id, 'accuracy' AS key, accuracy AS value FROM wide UNION ALL
            SELECT run_id, 'latency', latency FROM wide UNION ALL SELECT run_id, 'toxicity', toxicity FROM wide
            UNION ALL SELECT run_id, 'rouge2', rouge2 FROM wide)
        SELECT run_id, key, round(value, 8) AS value FROM l WHERE value IS NOT NULL""",
)
def logged_metrics(spark, folder):
    path = scratch_path(spark, "metrics")
    logged = metric_table(spark, folder)
    log_rows(logged.filter("key = 'accuracy'"), path)
    log_rows(logged.filter("key <> 'accuracy'"), path)
    return rounded(spark.read.schema(logged.schema).parquet(path), 8)


@query(
    "searched_runs",
    "R2",
    f"""WITH {RUNS}, {WIDE} SELECT run_id, status, round(accuracy, 8) AS accuracy, round(latency, 8) AS latency,
            o_orderpriority AS prompt FROM runs JOIN wide USING (run_id) JOIN orders ON run_id = o_orderkey""",
)
def searched_runs(spark, folder):
    found = search_wide(
        run_table(spark, folder), metric_table(spark, folder), param_table(spark, folder), ["accuracy", "latency"], ["prompt"]
    )
    return rounded(
        found.select(
            "run_id", "status", F.col("`metrics.accuracy`").alias("accuracy"),
            F.col("`metrics.latency`").alias("latency"), F.col("`params.prompt`").alias("prompt"),
        ),
        8,
    )


@query(
    "best_prompt",
    "T1 P16",
    f"""WITH {RUNS}, {WIDE} SELECT run_id, o_orderpriority AS prompt, toxicity, round(rouge2, 6) AS rouge2, round(latency, 6) AS latency
        FROM runs JOIN wide USING (run_id) JOIN orders ON run_id = o_orderkey WHERE status = 'FINISHED'
        ORDER BY toxicity ASC NULLS LAST, wide.rouge2 DESC NULLS LAST, wide.latency ASC NULLS LAST, run_id LIMIT 1""",
)
def best_prompt_(spark, folder):
    evaluations = (
        run_table(spark, folder)
        .join(wide_metrics(spark, folder), "run_id")
        .join(param_table(spark, folder).select("run_id", F.col("value").alias("prompt")), "run_id")
    )
    return rounded(best_prompt(evaluations).select("run_id", "prompt", "toxicity", "rouge2", "latency"))


@query(
    "best_prompt_of_experiments",
    "T1 P16",
    f"""WITH {RUNS}, {WIDE}, few AS (SELECT DISTINCT experiment FROM runs WHERE use_case = '1-urgent')
        SELECT run_id, experiment, toxicity, round(rouge2, 6) AS rouge2, round(latency, 6) AS latency
        FROM runs JOIN wide USING (run_id) JOIN few USING (experiment) WHERE status = 'FINISHED'
        ORDER BY toxicity ASC NULLS LAST, wide.rouge2 DESC NULLS LAST, wide.latency ASC NULLS LAST, run_id LIMIT 1""",
)
def best_prompt_of_experiments(spark, folder):
    runs = run_table(spark, folder)
    names = with_tag(runs, "use_case", "1-urgent").select("experiment")
    evaluations = runs.join(wide_metrics(spark, folder), "run_id")
    found = best_prompt(evaluations, experiments=names)
    return rounded(found.select("run_id", "experiment", "toxicity", "rouge2", "latency"))


@query("newest_run", "T4", f"WITH {RUNS} SELECT run_id, start_time FROM runs ORDER BY start_time DESC, run_id LIMIT 1")
def newest_run(spark, folder):
    return newest_runs(run_table(spark, folder)).select("run_id", "start_time")


@query(
    "newest_run_per_experiment",
    "W5",
    f"""WITH {RUNS}, r AS (SELECT *, row_number() OVER (PARTITION BY experiment ORDER BY start_time DESC, run_id) AS pos FROM runs)
        SELECT experiment, start_time, run_id FROM r WHERE pos = 1""",
)
def newest_run_per_experiment(spark, folder):
    return newest_per_experiment(run_table(spark, folder))


# --- versions --------------------------------------------------------------------


@query(
    "champion_versions",
    "P18 A20 F6",
    f"""WITH {VERSIONS} SELECT name, version, concat('models:/', name, '/', version) AS uri FROM versions
        WHERE aliases = ['champion']""",
)
def champion_versions(spark, folder):
    return with_uri(champions(version_table(spark, folder))).select("name", "version", "uri")


@query(
    "last_champions",
    "P18",
    f"""WITH {VERSIONS} SELECT name, max(version::INTEGER)::VARCHAR AS version FROM versions
        WHERE aliases = ['champion'] GROUP BY name""",
)
def last_champions(spark, folder):
    return last_champion(version_table(spark, folder)).select("name", "version")


@query(
    "version_listing",
    "A20 F6",
    f"WITH {VERSIONS} SELECT name, version, stage, concat('models:/', name, '/', version) AS uri FROM versions",
)
def version_listing(spark, folder):
    return with_uri(version_table(spark, folder)).select("name", "version", "stage", "uri")


@query(
    "version_counts",
    "A20",
    f"""WITH {VERSIONS} SELECT name, count(*) AS n_versions, count(*) FILTER (WHERE aliases = ['champion']) AS n_champions,
            max(version::INTEGER) AS latest_version FROM versions GROUP BY name""",
)
def version_counts_(spark, folder):
    return version_counts(version_table(spark, folder))


@query(
    "latest_versions",
    "A19",
    f"""WITH {VERSIONS} SELECT name, arg_max(version, version::INTEGER) AS version, arg_max(run_id, version::INTEGER) AS run_id,
            arg_max(stage, version::INTEGER) AS stage FROM versions GROUP BY name""",
)
def latest_versions(spark, folder):
    return latest_version(version_table(spark, folder)).select("name", "version", "run_id", "stage")


@query(
    "latest_version_per_stage",
    "A19",
    f"""WITH {VERSIONS} SELECT name, stage, arg_max(version, version::INTEGER) AS version FROM versions GROUP BY name, stage""",
)
def latest_version_per_stage(spark, folder):
    return latest_version(version_table(spark, folder), ["name", "stage"]).select("name", "stage", "version")


@query(
    "version_metrics",
    "J3",
    f"WITH {VERSIONS}, {SCORED} SELECT name, version, round(value, 6) AS value FROM scored",
)
def version_metrics(spark, folder):
    scored = version_metric(version_table(spark, folder), metric_table(spark, folder), "latency")
    return rounded(scored.select("name", "version", "value"))


@query(
    "best_previous_value",
    "A18 J3",
    f"""WITH {VERSIONS}, {SCORED}
        SELECT name, round(greatest(max(value), 0), 6) AS best_value FROM scored GROUP BY name""",
)
def best_previous_value(spark, folder):
    scored = version_metric(version_table(spark, folder), metric_table(spark, folder), "latency")
    return rounded(best_value(scored))


def _decided(spark, folder, **rule) -> DataFrame:
    """Every customer's balance stands for the new model's metric."""
    candidates = table(spark, folder, "customer").select(
        F.concat(F.lit("model_"), F.col("c_custkey").cast("string")).alias("name"),
        (F.col("c_custkey") + 1_000_000).alias("run_id"),
        (F.col("c_acctbal") / 20).alias("new_value"),
    )
    scored = version_metric(version_table(spark, folder), metric_table(spark, folder), "latency")
    return promotion(candidates, best_value(scored), **rule)


def _decided_sql(better: str) -> str:
    return f"""{VERSIONS}, {SCORED}, best AS (SELECT name, greatest(max(value), 0) AS best_value FROM scored GROUP BY name),
    cand AS (SELECT concat('model_', c_custkey) AS name, c_custkey + 1000000 AS run_id, c_acctbal / 20 AS new_value FROM customer),
    decided AS (SELECT c.*, best_value, best_value IS NULL OR {better} AS register,
        CASE WHEN best_value IS NULL THEN 'first_registration_or_registry_missing'
             WHEN {better} THEN 'metric_threshold' END AS reason
        FROM cand c LEFT JOIN best USING (name))"""


@query(
    "promotion_decisions",
    "R3 R4 A18",
    f"WITH {_decided_sql('new_value >= best_value')} SELECT name, run_id, register, reason FROM decided",
)
def promotion_decisions(spark, folder):
    return _decided(spark, folder).select("name", "run_id", "register", "reason")


@query(
    "promotion_with_gain",
    "R3 R4",
    f"WITH {_decided_sql('new_value > best_value + 0.01')} SELECT name, run_id, register, reason FROM decided",
)
def promotion_with_gain(spark, folder):
    return _decided(spark, folder, op=">", min_gain=0.01).select("name", "run_id", "register", "reason")


@query(
    "forced_promotion",
    "R3 R4",
    f"""WITH {_decided_sql('new_value >= best_value')} SELECT name, run_id, true AS register,
        CASE WHEN best_value IS NULL THEN reason ELSE 'forced_by_flag' END AS reason FROM decided""",
)
def forced_promotion(spark, folder):
    return _decided(spark, folder, force=True).select("name", "run_id", "register", "reason")


@query(
    "appended_versions",
    "R5 U1",
    f"""WITH {_decided_sql('new_value >= best_value')},
        fresh AS (SELECT name, (coalesce((SELECT max(version::INTEGER) FROM versions v WHERE v.name = d.name), 0) + 1)::VARCHAR AS version,
                    run_id, '' AS aliases, 'None' AS stage FROM decided d WHERE register)
        SELECT name, version, run_id, array_to_string(aliases, ',') AS aliases, stage FROM versions UNION ALL SELECT * FROM fresh""",
)
def appended_versions(spark, folder):
    versions = version_table(spark, folder)
    fresh = next_versions(_decided(spark, folder), versions)
    return joined_aliases(versions.unionByName(fresh))


@query(
    "moved_champion",
    "R6",
    f"""WITH {VERSIONS}, t AS (SELECT name, max(version::INTEGER)::VARCHAR AS latest FROM versions GROUP BY name)
        SELECT name, version, CASE
            WHEN version = latest THEN CASE WHEN list_contains(aliases, 'champion') THEN array_to_string(aliases, ',') ELSE 'champion' END
            ELSE array_to_string(list_filter(aliases, lambda a: a <> 'champion'), ',') END AS aliases
        FROM versions JOIN t USING (name)""",
)
def moved_champion(spark, folder):
    versions = version_table(spark, folder)
    moved = move_alias(versions, "champion", latest_version(versions))
    return joined_aliases(moved).select("name", "version", "aliases")


@query(
    "moved_stage",
    "R6",
    f"""WITH {VERSIONS}, t AS (SELECT name, max(version::INTEGER)::VARCHAR AS latest FROM versions GROUP BY name)
        SELECT name, version, CASE WHEN version = latest THEN 'Production' WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage
        FROM versions JOIN t USING (name)""",
)
def moved_stage(spark, folder):
    versions = version_table(spark, folder)
    return move_stage(versions, "Production", latest_version(versions)).select("name", "version", "stage")


# --- scalar functions ----------------------------------------------------------------


@query(
    "run_texts",
    "F1 F2 F3 F4 F6 F9",
    """SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS utc, strftime(ts, '%Y%m%d_%H%M%S') AS stamp,
              printf('%.3f', value) AS shown, concat('runs:/', event_id, '/model') AS uri,
              list_contains(string_split(concat('accuracy,', event_type), ','), 'click') AS clicked,
              lower(CASE WHEN value > 50 THEN 'TRUE' ELSE 'no' END) = 'true' AS forced,
              CASE WHEN event_type = 'view' THEN event_type ELSE 'random_forest' END AS model_type
       FROM events""",
)
def run_texts(spark, folder):
    settings = F.when(
        F.col("event_type") == "view", F.create_map(F.lit("model_type"), F.col("event_type"))
    ).otherwise(F.create_map().cast("map<string,string>"))
    return table(spark, folder, "events").select(
        "event_id",
        utc_stamp(F.col("ts")).alias("utc"),
        run_stamp(F.col("ts")).alias("stamp"),
        F.format_string("%.3f", "value").alias("shown"),
        run_uri(F.col("event_id").cast("string")).alias("uri"),
        has_name(F.concat(F.lit("accuracy,"), F.col("event_type")), "click").alias("clicked"),
        is_true(F.when(F.col("value") > 50, "TRUE").otherwise("no")).alias("forced"),
        value_or(settings, "model_type", "random_forest").alias("model_type"),
    )


@query("json_fields", "F12", "SELECT event_id, props->>'k' AS k FROM events")
def json_fields(spark, folder):
    return table(spark, folder, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query(
    "nested_json",
    "F11",
    """SELECT o_orderpriority, count(*) AS n, round(max(o_totalprice), 2) AS highest FROM orders GROUP BY 1""",
)
def nested_json(spark, folder):
    summary = label_summary(table(spark, folder, "orders"), "o_totalprice", ["o_orderpriority"])
    document = F.to_json(F.struct("o_orderpriority", F.struct("n_rows", "label_max").alias("data")))
    texts = summary.select(document.alias("json"))
    return texts.select(
        F.get_json_object("json", "$.o_orderpriority").alias("o_orderpriority"),
        F.get_json_object("json", "$.data.n_rows").cast("bigint").alias("n"),
        F.round(F.get_json_object("json", "$.data.label_max").cast("double"), 2).alias("highest"),
    )


@query(
    "payload_rows",
    "F13",
    "SELECT l_orderkey, l_linenumber, l_quantity, l_tax FROM lineitem",
)
def payload_rows(spark, folder):
    """Each line as a request body of columns and data, then opened into rows again."""
    schema = "dataframe_split struct<columns: array<string>, data: array<array<double>>>"
    body = F.to_json(
        F.struct(
            F.struct(
                F.array(F.lit("l_quantity"), F.lit("l_tax")).alias("columns"),
                F.array(F.array("l_quantity", "l_tax")).alias("data"),
            ).alias("dataframe_split")
        )
    )
    sent = table(spark, folder, "lineitem").select("l_orderkey", "l_linenumber", F.from_json(body, schema).alias("body"))
    opened = sent.select(
        "l_orderkey", "l_linenumber", F.col("body.dataframe_split.columns").alias("names"),
        F.explode("body.dataframe_split.data").alias("row"),
    )
    by_name = F.map_from_arrays("names", "row")
    return opened.select(
        "l_orderkey", "l_linenumber", *[F.try_element_at(by_name, F.lit(c)).alias(c) for c in ("l_quantity", "l_tax")]
    )

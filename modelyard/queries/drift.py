"""Drift tests between training rows and later ones."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.operators.drift import (
    PROFILE_POINTS,
    any_drift,
    bounded_profile,
    drift_report,
    drift_test,
    feature_rows,
    ks_distance,
    reference_profile,
    sketch_rank_error,
    version_with_reference,
    with_decision,
    with_p_value,
)
from modelyard.operators.scoring import last_rows
from modelyard.queries import query, rounded, table
from modelyard.queries.runs import VERSIONS, version_table
from modelyard.session import scratch_path

FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
SEQUENCE = ["l_shipdate", "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
CUT = "1999-01-01"

OLD = f"old AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '{CUT}')"
LATER = f"cur AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{CUT}')"
LAST = f"cur AS (SELECT * FROM lineitem ORDER BY {', '.join(c + ' DESC' for c in SEQUENCE)} LIMIT 20)"


def _unpivot(source: str, side: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS value, {int(side == 'ref')} AS ref, {int(side == 'cur')} AS cur FROM {source}"
        for f in FEATURES
    )


TEST = f"""long AS ({_unpivot('old', 'ref')} UNION ALL {_unpivot('cur', 'cur')}),
    d AS (SELECT feature, value, sum(ref) AS ref, sum(cur) AS cur FROM long GROUP BY 1, 2),
    n AS (SELECT feature, sum(ref)::BIGINT AS n_ref, sum(cur)::BIGINT AS n_cur FROM long GROUP BY 1),
    g AS (SELECT feature, n_ref, n_cur, abs(sum(ref) OVER w / n_ref - sum(cur) OVER w / n_cur) AS gap
          FROM d JOIN n USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY value)),
    k AS (SELECT *, effective ** 0.5 * distance AS plain FROM (SELECT feature, n_ref, n_cur, max(gap) AS distance,
            n_ref::DOUBLE * n_cur / (n_ref + n_cur) AS effective FROM g GROUP BY 1, 2, 3)),
    q AS (SELECT *, plain + 1 / (6 * effective ** 0.5) + (plain - 1) / (4 * effective) AS lam FROM k),
    f AS (SELECT *, mid - n * distance AS h, 2 * mid - 1 AS size FROM (SELECT feature, distance, round_even(effective, 0)::INTEGER AS n,
            floor(round_even(effective, 0)::INTEGER * distance)::INTEGER + 1 AS mid FROM k
            WHERE round_even(effective, 0) <= 140 AND distance > 0 AND distance < 1)),
    m AS (SELECT feature, n, mid, size, [[((CASE WHEN i - j + 1 >= 0 THEN 1.0 ELSE 0.0 END)::DOUBLE
              - (CASE WHEN j = 0 THEN h ** (i + 1) ELSE 0 END) - (CASE WHEN i = size - 1 THEN h ** (size - j) ELSE 0 END)
              + (CASE WHEN j = 0 AND i = size - 1 THEN greatest(2 * h - 1, 0) ** size ELSE 0 END))
            / (CASE WHEN i - j + 1 > 1 THEN exp(lgamma(i - j + 2)) ELSE 1 END) FOR i IN range(size)] FOR j IN range(size)] AS cols FROM f),
    walk AS (SELECT feature, n, mid, cols, 0 AS step, [(CASE WHEN i = mid - 1 THEN 1.0 ELSE 0.0 END)::DOUBLE FOR i IN range(size)] AS v FROM m
        UNION ALL SELECT feature, n, mid, cols, step + 1, [list_dot_product(v, c) * (step + 1) / n FOR c IN cols] FROM walk WHERE step < n),
    p AS (SELECT feature, n_ref, n_cur, distance, CASE WHEN round_even(effective, 0) <= 140 THEN
              CASE WHEN distance <= 0 THEN 1 WHEN distance >= 1 THEN 0 ELSE least(greatest(1 - v[mid], 0), 1) END
            WHEN lam < 0.2 THEN 1 ELSE least(greatest(2 * list_sum(list_transform(
            range(1, 101), lambda i: (CASE WHEN i % 2 = 1 THEN 1.0 ELSE -1.0 END)::DOUBLE * exp(-2.0::DOUBLE * i * i * lam * lam))), 0), 1) END AS p_value
          FROM q LEFT JOIN (SELECT feature, mid, v FROM walk WHERE step = n) USING (feature))"""
DECIDED = """SELECT feature, n_ref, n_cur, round(distance, 6) AS distance, round(p_value, 6) AS p_value, 0.0125::DOUBLE AS threshold,
    p_value < 0.0125 AS drifted FROM p"""


def training_rows(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").filter(F.col("l_shipdate") < F.lit(CUT).cast("timestamp_ntz"))


def later_rows(spark, folder) -> DataFrame:
    return table(spark, folder, "lineitem").filter(F.col("l_shipdate") >= F.lit(CUT).cast("timestamp_ntz"))


@query("drift_between_periods", "D2 D3 D4 W3", f"WITH RECURSIVE {OLD}, {LATER}, {TEST} {DECIDED}")
def drift_between_periods(spark, folder):
    return rounded(drift_test(training_rows(spark, folder), later_rows(spark, folder), FEATURES))


@query("drift_of_last_rows", "D2 D3 D4 W1", f"WITH RECURSIVE {OLD}, {LAST}, {TEST} {DECIDED}")
def drift_of_last_rows(spark, folder):
    current = last_rows(table(spark, folder, "lineitem"), SEQUENCE, 20)
    return rounded(drift_test(training_rows(spark, folder), current, FEATURES))


@query(
    "drift_decision",
    "D4",
    f"""WITH RECURSIVE {OLD}, {LAST}, {TEST} SELECT count(*) AS n_features, round(min(p_value), 6) AS lowest_p,
            max((p_value < 0.0125)::INTEGER) AS is_drift FROM p""",
)
def drift_decision(spark, folder):
    current = last_rows(table(spark, folder, "lineitem"), SEQUENCE, 20)
    return rounded(any_drift(drift_test(training_rows(spark, folder), current, FEATURES)))


@query(
    "drift_small_sample_p",
    "D3",
    f"""WITH RECURSIVE {OLD}, {LAST.replace("LIMIT 20", "LIMIT 120")}, {TEST} {DECIDED}""",
)
def drift_small_sample_p(spark, folder):
    """The same test for a longer window, just below the finite form's bound."""
    current = last_rows(table(spark, folder, "lineitem"), SEQUENCE, 120)
    return rounded(drift_test(training_rows(spark, folder), current, FEATURES))


@query(
    "reference_profile",
    "D1",
    f"""WITH {OLD}, long AS ({_unpivot('old', 'ref')}) SELECT feature, value, count(*) AS n FROM long GROUP BY 1, 2""",
)
def reference_profile_(spark, folder):
    path = scratch_path(spark, "reference")
    profile = reference_profile(training_rows(spark, folder), FEATURES)
    profile.write.mode("overwrite").parquet(path)
    return spark.read.schema(profile.schema).parquet(path)


@query(
    "bounded_reference_profile",
    "D1 D2",
    f"""WITH {OLD}, {LATER}, long AS ({_unpivot('old', 'ref')} UNION ALL {_unpivot('cur', 'cur')}),
        d AS (SELECT feature, value, sum(ref) AS ref, sum(cur) AS cur FROM long GROUP BY 1, 2),
        n AS (SELECT feature, sum(ref)::BIGINT AS n_ref, sum(cur)::BIGINT AS n_cur FROM long GROUP BY 1),
        g AS (SELECT feature, n_ref, n_cur, abs(sum(ref) OVER w / n_ref - sum(cur) OVER w / n_cur) AS gap
              FROM d JOIN n USING (feature) WINDOW w AS (PARTITION BY feature ORDER BY value))
        SELECT feature, n_ref, n_cur, round(max(gap), 6) AS distance, true AS profile_bounded, true AS distance_within
        FROM g GROUP BY 1, 2, 3""",
)
def bounded_reference_profile(spark, folder):
    """The exact distance, and whether quantiles of the training rows give it within their stated error."""
    training, later = training_rows(spark, folder), feature_rows(later_rows(spark, folder), FEATURES)
    path = scratch_path(spark, "bounded-reference")
    written = bounded_profile(training, FEATURES)
    written.write.mode("overwrite").parquet(path)
    profile = spark.read.schema(written.schema).parquet(path)
    exact = ks_distance(feature_rows(training, FEATURES), later)
    near = ks_distance(profile, later).select("feature", F.col("n_ref").alias("profile_n"), F.col("distance").alias("near"))
    rows = profile.groupBy("feature").agg(F.count("*").alias("profile_rows"))
    # Both sides have one row per feature named above.
    found = exact.join(F.broadcast(near), "feature").join(F.broadcast(rows), "feature")
    error = 1 / PROFILE_POINTS + sketch_rank_error()
    return rounded(found.select(
        "feature", "n_ref", "n_cur", "distance",
        ((F.col("profile_rows") <= PROFILE_POINTS) & (F.col("profile_n") == F.col("n_ref"))).alias("profile_bounded"),
        (F.abs(F.col("near") - F.col("distance")) <= error).alias("distance_within"),
    ))


@query(
    "drift_report",
    "D5 D6 A19",
    f"""WITH RECURSIVE {OLD}, {LAST}, {TEST}, {VERSIONS}, best AS (SELECT name, max(version::INTEGER) AS v FROM versions
             WHERE name = (SELECT concat('model_', max(o_custkey)) FROM orders) GROUP BY name)
        SELECT '20000101T000000Z' AS timestamp_utc, best.name AS model_name, best.v::VARCHAR AS model_version,
               best.v::BIGINT AS model_run_id, 20 AS window_size, feature, round(distance, 6) AS distance,
               round(p_value, 6) AS p_value, p_value < 0.0125 AS drifted,
               (SELECT max((p_value < 0.0125)::INTEGER) FROM p) AS is_drift FROM p, best""",
)
def drift_report_(spark, folder):
    versions = version_table(spark, folder)
    newest = table(spark, folder, "orders").agg(F.max("o_custkey").alias("key")).first()["key"]
    version = version_with_reference(versions, versions.select("run_id"), f"model_{newest}")
    current = last_rows(table(spark, folder, "lineitem"), SEQUENCE, 20)
    distances = ks_distance(
        reference_profile(training_rows(spark, folder), FEATURES), feature_rows(current, FEATURES)
    )
    tested = with_decision(with_p_value(distances), len(FEATURES))
    report = drift_report(tested, version, F.lit("2000-01-01 00:00:00").cast("timestamp_ntz"), 20)
    opened = report.withColumn("is_drift", F.col("preds.is_drift")).select(
        "*", F.inline("preds.data")
    )
    return rounded(opened.drop("preds"))

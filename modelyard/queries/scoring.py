"""Batch scoring and the predictions table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.operators.scoring import (
    append_rows,
    distinct_rows,
    last_rows,
    linear_score,
    not_yet_in,
    score_frames,
    score_with,
)
from modelyard.queries import query, table
from modelyard.queries.drift import SEQUENCE
from modelyard.session import scratch_path
from modelyard.sources.predictions import PredictionTable

WEIGHTS = {"l_quantity": 1500.0, "l_discount": -250.0, "l_tax": 125.0}
SCORE = "10.0::DOUBLE + l_quantity * 1500.0::DOUBLE + l_discount * -250.0::DOUBLE + l_tax * 125.0::DOUBLE"
FEATURES = list(WEIGHTS)


def linear_predict(batch):
    return 10.0 + sum(batch[c] * w for c, w in WEIGHTS.items())


def zero_per_column(batch):
    import pandas as pd

    return pd.DataFrame({"feature": list(batch.columns), "prediction": [0] * len(batch.columns)})


def scored_lines(spark, folder) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    return lines.withColumn("prediction", F.round(linear_score(WEIGHTS, 10.0), 4))


@query(
    "scored_by_arrow_udf",
    "V1 V3 V4",
    f"SELECT l_orderkey, l_linenumber, round({SCORE}, 4) AS prediction FROM lineitem",
)
def scored_by_arrow_udf(spark, folder):
    scored = score_with(table(spark, folder, "lineitem"), linear_predict, FEATURES)
    return scored.select("l_orderkey", "l_linenumber", F.round("prediction", 4).alias("prediction"))


@query(
    "scored_by_expression",
    "V1",
    f"SELECT l_orderkey, l_linenumber, round({SCORE}, 4) AS prediction FROM lineitem",
)
def scored_by_expression(spark, folder):
    return scored_lines(spark, folder).select("l_orderkey", "l_linenumber", "prediction")


@query(
    "constant_model",
    "V2",
    """SELECT unnest(['l_quantity', 'l_discount', 'l_tax']) AS feature, 0 AS prediction""",
)
def constant_model(spark, folder):
    features = table(spark, folder, "lineitem").select(FEATURES)
    per_batch = score_frames(features, zero_per_column, "feature string, prediction int")
    return per_batch.groupBy("feature").agg(F.max("prediction").alias("prediction"))


@query(
    "appended_predictions",
    "U1 U2",
    f"""SELECT l_quantity, l_discount, l_tax, round({SCORE}, 4) AS prediction, min(l_shipdate) AS l_shipdate
        FROM lineitem GROUP BY 1, 2, 3, 4""",
)
def appended_predictions(spark, folder):
    scored = scored_lines(spark, folder).select(*FEATURES, "prediction", "l_shipdate", "l_returnflag")
    existing = scored.filter("l_returnflag <> 'R'").drop("l_returnflag")
    fresh = scored.filter("l_returnflag = 'R'").drop("l_returnflag")
    return distinct_rows(append_rows(existing, fresh), ["l_shipdate"])


@query("distinct_lines", "U2", "SELECT DISTINCT l_quantity, l_discount, l_tax, l_returnflag FROM lineitem")
def distinct_lines(spark, folder):
    return distinct_rows(table(spark, folder, "lineitem").select(*FEATURES, "l_returnflag"))


GAPPED = "SELECT nullif(l_quantity, 7) AS quantity, l_discount, l_tax, l_returnflag FROM lineitem"


@query(
    "unseen_rows",
    "U2 U3",
    f"""WITH g AS ({GAPPED})
        SELECT DISTINCT quantity, l_discount, l_tax FROM g n WHERE l_returnflag = 'R' AND NOT EXISTS (
          SELECT 1 FROM g o WHERE o.l_returnflag = 'A' AND o.l_discount > 0.05 AND o.quantity IS NOT DISTINCT FROM n.quantity
            AND o.l_discount = n.l_discount AND o.l_tax = n.l_tax)""",
)
def unseen_rows(spark, folder):
    lines = table(spark, folder, "lineitem").select(
        F.nullif("l_quantity", F.lit(7.0)).alias("quantity"), "l_discount", "l_tax", "l_returnflag"
    )
    old = lines.filter("l_returnflag = 'A' AND l_discount > 0.05").drop("l_returnflag")
    new = distinct_rows(lines.filter("l_returnflag = 'R'").drop("l_returnflag"))
    return not_yet_in(distinct_rows(old), new, ["quantity", "l_discount", "l_tax"])


@query(
    "stored_predictions",
    "U1 U2 U3",
    f"""WITH s AS (SELECT l_quantity, l_discount, l_tax, round({SCORE}, 4) AS prediction,
                     CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END::BIGINT AS batch, l_shipdate FROM lineitem),
             f AS (SELECT l_quantity, l_discount, l_tax, prediction, min(batch) AS batch FROM s GROUP BY 1, 2, 3, 4)
        SELECT f.*, min(l_shipdate) AS l_shipdate FROM f JOIN s USING (l_quantity, l_discount, l_tax, prediction, batch)
        GROUP BY ALL""",
)
def stored_predictions(spark, folder):
    scored = scored_lines(spark, folder).select("l_shipdate", *FEATURES, "prediction", "l_returnflag")
    schema = scored.drop("l_returnflag").schema
    stored = PredictionTable(spark, scratch_path(spark, "predictions"), schema, ["l_shipdate"])
    for batch, flag in enumerate(["A", "N", "R"]):
        stored.append(scored.filter(F.col("l_returnflag") == flag), batch)
    return stored.read()


@query(
    "last_predictions",
    "W1",
    f"""SELECT l_shipdate, l_orderkey, l_quantity, round({SCORE}, 4) AS prediction FROM lineitem
        ORDER BY {', '.join(c + ' DESC' for c in SEQUENCE)} LIMIT 20""",
)
def last_predictions(spark, folder):
    return last_rows(scored_lines(spark, folder), SEQUENCE, 20).select(
        "l_shipdate", "l_orderkey", "l_quantity", "prediction"
    )

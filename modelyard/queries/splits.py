"""Samples, splits and positional alignment."""

from __future__ import annotations

from pyspark.sql import functions as F

from modelyard.functions.scalars import argmax
from modelyard.operators.align import align_predictions, class_name, concat_columns, zip_lists
from modelyard.operators.splits import (
    first_rows,
    random_split,
    sample_rows,
    with_exact_split,
    with_hash_split,
    with_ordered_split,
)
from modelyard.queries import query, table


@query("first_events", "T5", "SELECT event_id, ts, value FROM events ORDER BY ts, event_id LIMIT 10")
def first_events(spark, folder):
    return first_rows(table(spark, folder, "events").select("event_id", "ts", "value"), 10, "ts", "event_id")


@query(
    "seeded_sample",
    "T6",
    """SELECT * FROM orders
       ORDER BY md5(concat_ws(':', '42', o_orderkey::VARCHAR)), o_orderkey LIMIT 3000""",
)
def seeded_sample(spark, folder):
    return sample_rows(table(spark, folder, "orders"), 3000, ["o_orderkey"])


@query(
    "hash_split",
    "T7",
    """SELECT event_id, CASE WHEN substr(md5(concat_ws(':', '42', event_id::VARCHAR)), 1, 8) < '33333333'
                             THEN 'test' ELSE 'train' END AS split FROM events""",
)
def hash_split(spark, folder):
    return with_hash_split(table(spark, folder, "events"), ["event_id"]).select("event_id", "split")


@query("random_split_sizes", "T7")
def random_split_sizes(spark, folder):
    train, test = random_split(table(spark, folder, "lineitem"))
    sides = train.select(F.lit("train").alias("split")).unionByName(test.select(F.lit("test").alias("split")))
    return sides.groupBy("split").agg(F.count("*").alias("n_rows"))


@query(
    "exact_split",
    "T8",
    """WITH o AS (SELECT o_orderkey, o_totalprice,
                    row_number() OVER (ORDER BY substr(md5(concat_ws(':', '42', o_orderkey::VARCHAR)), 1, 15), o_orderkey) AS pos,
                    count(*) OVER () AS n FROM orders)
       SELECT o_orderkey, o_totalprice, CASE WHEN pos <= ceil(0.2 * n) THEN 'test' ELSE 'train' END AS split FROM o""",
)
def exact_split(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return with_exact_split(orders, ["o_orderkey"], 0.2, 42)


@query(
    "ordered_halves",
    "T9",
    """WITH e AS (SELECT event_id, row_number() OVER (ORDER BY ts, event_id) AS pos, count(*) OVER () AS n FROM events)
       SELECT event_id, CASE WHEN pos <= n - ceil(0.5 * n) THEN 'train' ELSE 'test' END AS split FROM e""",
)
def ordered_halves(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return with_ordered_split(events, ["ts", "event_id"], 0.5).drop("ts")


@query(
    "features_with_target",
    "J1",
    "SELECT doc_id, n_chars, lang, quality FROM documents JOIN labels USING (doc_id)",
)
def features_with_target(spark, folder):
    features = table(spark, folder, "documents").select("doc_id", "n_chars", "lang")
    return concat_columns(features, table(spark, folder, "labels").select("doc_id", "quality"), ["doc_id"])


@query(
    "predictions_with_truth",
    "J2",
    """SELECT o.o_orderkey, o.o_totalprice AS truth, p.prediction
       FROM orders o JOIN (SELECT o_orderkey, o_custkey * 200.0::DOUBLE AS prediction FROM orders) p USING (o_orderkey)""",
)
def predictions_with_truth(spark, folder):
    orders = table(spark, folder, "orders")
    truth = orders.select("o_orderkey", F.col("o_totalprice").alias("truth"))
    predictions = orders.select("o_orderkey", (F.col("o_custkey") * 200.0).alias("prediction"))
    return align_predictions(truth, predictions, ["o_orderkey"])


@query(
    "zipped_pairs",
    "J4",
    """WITH d AS (SELECT doc_id, string_split(source, 'c') AS a,
                         regexp_extract_all(lower(text), '[a-z0-9]+') AS b FROM documents)
       SELECT doc_id, u.i AS at, a[u.i + 1] AS prompt, b[u.i + 1] AS target
       FROM d, unnest(range(least(len(a), len(b)))) AS u(i)""",
)
def zipped_pairs(spark, folder):
    words = F.regexp_extract_all(F.lower("text"), F.lit("[a-z0-9]+"), F.lit(0))
    pairs = zip_lists(F.split("source", "c"), words, ("prompt", "target"))
    exploded = table(spark, folder, "documents").select("doc_id", F.posexplode(pairs).alias("at", "pair"))
    return exploded.select("doc_id", F.col("at").cast("bigint").alias("at"), "pair.prompt", "pair.target")


CLASS_NAMES = ["class_0", "class_1", "class_2", "class_3", "class_4", "class_5", "class_6", "class_7", "class_8", "class_9"]


@query(
    "likeliest_class",
    "F7 J5",
    """SELECT vec_id, list_position(embedding, list_max(embedding)) - 1 AS class_index,
              concat('class_', ((list_position(embedding, list_max(embedding)) - 1) % 10)) AS class_name
       FROM embeddings""",
)
def likeliest_class(spark, folder):
    best = argmax(F.col("embedding"))
    return table(spark, folder, "embeddings").select(
        "vec_id", best.alias("class_index"), class_name(best % 10, CLASS_NAMES).alias("class_name")
    )

import pandas as pd
import re

import pytest
from pyspark.sql import functions as F

from modelyard.operators import scoring as S
from modelyard.sources.predictions import PredictionTable
from tests.conftest import plan_of
from modelyard.operators.align import heavy_keys, keyed_join, next_in_sequence, with_single, zip_lists
from modelyard.operators import routing

NAN = float("nan")


def test_arrow_and_expression_scores_agree(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, -1.0)], "a double, b double")
    by_udf = S.score_with(df, lambda batch: 1.0 + 2.0 * batch["a"] + batch["b"], ["a", "b"])
    by_expr = df.withColumn("prediction", S.linear_score({"a": 2.0, "b": 1.0}, 1.0))
    assert by_udf.collect() == by_expr.collect()


def test_frame_model(spark):
    out = S.score_frames(spark.range(5), lambda pdf: pd.DataFrame({"id": pdf["id"] * 2}), "id bigint")
    assert sorted(r.id for r in out.collect()) == [0, 2, 4, 6, 8]


def test_append_aligns_by_name(spark):
    old = spark.createDataFrame([(1, "x")], "a int, b string")
    new = spark.createDataFrame([("y", 2, 5.0)], "b string, a int, c double")
    assert [tuple(r) for r in S.append_rows(old, new).collect()] == [(1, "x", None), (2, "y", 5.0)]
    assert S.append_rows(None, new) is new


def test_distinct_rows_keep_the_first_sequence(spark):
    df = spark.createDataFrame([(3, 1.0, None), (1, 1.0, None), (2, NAN, "p"), (5, NAN, "p")], "seq int, x double, prediction string")
    found = {r.seq for r in S.distinct_rows(df, ["seq"]).collect()}
    assert found == {1, 2}
    narrowed = S.distinct_rows(df.withColumn("x", F.lit(0)), ["seq"], subset=["x"])
    assert [tuple(r) for r in narrowed.collect()] == [(1, 0, None)]


def test_not_yet_in_treats_null_and_nan_as_equal(spark):
    old = spark.createDataFrame([(None, 1.0), (2.0, NAN)], "a double, b double")
    new = spark.createDataFrame([(None, 1.0), (2.0, NAN), (None, NAN)], "a double, b double")
    assert S.not_yet_in(old, new, ["a", "b"]).count() == 1


def test_prediction_table(spark, tmp_path):
    schema = spark.createDataFrame([], "seq int, x double, prediction string").schema
    stored = PredictionTable(spark, str(tmp_path / "p"), schema, ["seq"])
    assert stored.read().count() == 0
    batch = lambda *rows: spark.createDataFrame(list(rows), schema)
    stored.append(batch((1, 1.0, "a"), (2, 1.0, "a"), (3, None, "a")), 0)
    stored.append(batch((4, 1.0, "a"), (5, 1.0, "b"), (6, None, "a")), 1)
    assert sorted((r.batch, r.seq) for r in stored.read().collect()) == [(0, 1), (0, 3), (1, 5)]
    stored.append(batch((4, 1.0, "a"), (5, 1.0, "b"), (6, None, "a")), 1)  # replayed
    stored.append(batch((7, 1.0, "a")), 2)  # nothing new
    assert sorted((r.batch, r.seq) for r in stored.read().collect()) == [(0, 1), (0, 3), (1, 5)]
    assert [r.seq for r in stored.last(2).collect()] == [5, 3]


def test_old_batches_are_pruned(spark, tmp_path):
    """Rows are read only where a digest was found, and the last rows only from the newest batches."""
    schema = spark.createDataFrame([], "seq int, x double, prediction string").schema
    stored = PredictionTable(spark, str(tmp_path / "p"), schema, ["seq"])
    rows = lambda low, high: spark.range(low, high).selectExpr("cast(id as int) seq", "cast(id as double) x", "'p' prediction")
    for batch in range(4):
        stored.append(rows(100 * batch, 100 * batch + 50), batch)
    staged = rows(120, 123).union(rows(900, 905)).withColumn("_digest", F.xxhash64("x", "prediction"))
    staged = staged.withColumn("_bucket", F.pmod("_digest", F.lit(8)).cast("int"))
    pruned = re.compile(r"PartitionFilters: \[([^\]]*batch[^\]]*)\]")
    found = stored.earlier(staged, 9)
    assert found.select("batch").distinct().collect() == [(1,)] and found.select("_bucket").distinct().count() <= 3
    assert "= 1)" in pruned.search(plan_of(found)).group(1)
    assert not stored.earlier(staged.filter("seq >= 900"), 9).count()
    newest = stored.last(60)
    assert "IN (3,2)" in pruned.search(plan_of(newest)).group(1)
    assert [r.seq for r in newest.collect()][:2] == [349, 348] and newest.count() == 60
    stored.append(rows(0, 350), 4)
    assert stored.read().count() == 350 and stored.newest(1) == [4]


def test_zip_stops_at_the_shorter_list(spark):
    df = spark.createDataFrame([([1, 2, 3], ["a", "b"]), ([], ["a"])], "x array<int>, y array<string>")
    found = [[tuple(p) for p in r[0]] for r in df.select(zip_lists(F.col("x"), F.col("y"))).collect()]
    assert found == [[(1, "a"), (2, "b")], []]


@pytest.mark.parametrize("how", ["inner", "left"])
def test_keyed_join_spreads_a_hot_key(spark, how):
    names = F.when(F.col("id") < 600, "hot").when(F.col("id") % 6 < 5, F.concat(F.lit("k"), F.col("id") % 6))
    left = spark.range(900).select(names.alias("key"), "id")
    right = spark.createDataFrame([("hot", 1), ("hot", 9), ("k1", 2), ("k2", 3), ("unused", 4), (None, 5)], "key string, v int")
    joined = keyed_join(left, right, "key", how, parts=10)
    assert joined.columns == ["key", "id", "v"]
    assert joined.exceptAll(left.join(right, "key", how)).count() == 0
    assert joined.count() == left.join(right, "key", how).count()


def test_heavy_keys_get_parts_by_their_share(spark):
    left = spark.range(1000).select(F.when(F.col("id") < 600, 1).when(F.col("id") < 850, None).otherwise(F.col("id")).alias("k"))
    found = {r["_hash"]: r["_parts"] for r in heavy_keys(left, "k", 10).collect()}
    hashes = [r[0] for r in left.limit(1).select(F.xxhash64(F.lit(1).cast("bigint")), F.xxhash64(F.lit(None).cast("bigint"))).collect()[0:1]]
    assert sorted(found.values()) == [3, 6] and found[hashes[0]] == 6
    assert heavy_keys(left.limit(0), "k").count() == 0


def test_a_term_of_every_document_is_spread(spark):
    """With one part in ten as the bound, no group of (term, part) holds a fifth of the rows."""
    left = spark.range(5000).select(F.lit("the").alias("key"), "id").union(spark.range(5000).select(F.col("id").cast("string"), "id"))
    right = left.select("key").distinct().withColumn("v", F.lit(1))
    joined = keyed_join(left, right, "key", parts=10)
    spread = left.withColumn("_hash", F.xxhash64("key")).join(heavy_keys(left, "key", 10), "_hash", "left")
    part = F.pmod(F.xxhash64("id"), F.coalesce("_parts", F.lit(1)))
    assert spread.groupBy("key", part).count().agg(F.max("count")).first()[0] < 2000
    assert joined.count() == 10000


def test_next_in_sequence(spark):
    df = spark.createDataFrame([("k", 1, "a"), ("k", 2, "b"), ("k", 4, "c")], "key string, turn int, text string")
    found = next_in_sequence(df, "key", "turn", ["text"]).collect()
    assert [(r.turn, r.text, r.next_text) for r in found] == [(1, "a", "b")]


def test_single_value_must_be_single(spark):
    one = spark.createDataFrame([(7,)], "v int")
    assert [r.v for r in with_single(spark.range(2), one, "v").collect()] == [7, 7]
    two = spark.createDataFrame([(7,), (8,)], "v int")
    try:
        with_single(spark.range(2), two, "v").collect()
    except Exception as error:
        assert "SCALAR_SUBQUERY_TOO_MANY_ROWS" in str(error)
    else:
        raise AssertionError("two rows were accepted")


def test_access_and_routes(spark):
    df = spark.createDataFrame([(1, "text", "/start now"), (2, "photo", None), (None, "voice", "x"), (9, "sticker", "")], "user int, kind string, text string")
    assert [r.access for r in routing.gate_by_list(df, "user", [1, 2]).collect()] == ["allowed", "allowed", "denied", "denied"]
    assert [r[0] for r in df.select(routing.route(F.col("kind"), F.col("text"))).collect()] == ["welcome", "describe_image", "transcribe", "ignore"]
    members = spark.createDataFrame([(1,), (1,)], "user int")
    assert routing.allowed_rows(df, members, "user").count() == 1
    assert routing.denied_rows(df, members, "user").count() == 3

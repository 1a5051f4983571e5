import math

import pytest
from pyspark.sql import functions as F

from modelyard.functions.keys import digest
from modelyard.operators import splits as S


def sides(df):
    return {r.split: r["count"] for r in df.groupBy("split").count().collect()}


@pytest.fixture
def numbered(spark):
    return spark.range(1037).select("id", (F.col("id") % 10).alias("tens"))


def test_hash_split_is_stable_and_near_its_share(numbered):
    first = S.with_hash_split(numbered, ["id"])
    again = S.with_hash_split(numbered.repartition(7), ["id"])
    assert first.exceptAll(again).count() == 0
    assert 150 < sides(first)["test"] < 270
    train, test = S.hash_split(numbered, ["id"])
    assert train.count() + test.count() == 1037 and train.join(test, "id").count() == 0


def test_exact_split_has_the_exact_size(numbered):
    train, test = S.exact_split(numbered, ["id"], 0.2, seed=7)
    assert test.count() == math.ceil(0.2 * 1037) and train.count() == 1037 - test.count()
    assert S.exact_split(numbered.repartition(3), ["id"], 0.2, seed=7)[1].exceptAll(test).count() == 0
    assert S.exact_split(numbered, ["id"], 0.2, seed=8)[1].exceptAll(test).count() > 0


@pytest.mark.parametrize("tail_rows", [1_000_000, 20, 1])
def test_digest_search_matches_a_sort(numbered, tail_rows):
    ordered = sorted(r.d for r in numbered.select(digest(5, "id").alias("d")).collect())
    for position in (1, 2, 500, 1036, 1037):
        assert S.digest_at(numbered, ["id"], 5, lambda rows: position, tail_rows) == ordered[position - 1]
    assert S.digest_at(numbered, ["id"], 5, lambda rows: 0) == ""


def test_share_of_a_round_number_is_not_rounded_up(spark):
    assert sides(S.with_exact_split(spark.range(10), ["id"], 0.3))["test"] == 3


def test_exact_split_refuses_a_key_that_repeats_at_the_cut(spark):
    copies = spark.range(30).select((F.col("id") % 2).alias("id"))
    with pytest.raises(ValueError, match="identify a row"):
        S.with_exact_split(copies, ["id"], 0.3)


@pytest.mark.parametrize("tail_rows", [1_000_000, 40, 3])
def test_position_search_matches_a_sort(spark, tail_rows):
    """A third of the rows share the first column's value."""
    rows = [(5.0, i) for i in range(300)] + [(float((i * 37) % 101) / 7, 1000 + i) for i in range(600)]
    df = spark.createDataFrame(rows, "v double, id bigint")
    ordered = sorted(rows)
    for position in (1, 2, 299, 450, 451, 899, 900):
        found = S.row_at(df, ["v", "id"], position, tail_rows)
        assert (float(found["v"]), int(found["id"])) == ordered[position - 1]


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "decimal(12,2)", "bigint"])
def test_position_search_by_type(spark, kind):
    base = F.col("id") * 7919 % 1000
    value = {
        "date": F.date_add(F.lit("2020-01-01").cast("date"), base.cast("int")),
        "timestamp": F.timestamp_seconds(F.lit(1_600_000_000) + base * 1801),
        "timestamp_ntz": F.timestamp_seconds(F.lit(1_600_000_000) + base * 1801).cast("timestamp_ntz"),
    }.get(kind, (base * 1_000_003).cast(kind))
    df = spark.range(500).select(value.cast(kind).alias("v"), "id")
    wanted = sorted((r.v, r.id) for r in df.collect())
    found = S.row_at(df, ["v", "id"], 123, tail_rows=10)
    assert int(found["id"]) == wanted[122][1]


def test_position_search_refuses_nulls(spark):
    with pytest.raises(ValueError, match="null in some rows"):
        S.row_at(spark.createDataFrame([(1,), (None,)], "v int"), ["v"], 1)


def test_ordered_split_keeps_the_order(numbered):
    halves = S.with_ordered_split(numbered, ["tens", "id"], 0.5)
    assert sides(halves) == {"train": 518, "test": 519}
    last = halves.filter("split = 'train'").agg(F.max(F.struct("tens", "id")).alias("m")).first().m
    first = halves.filter("split = 'test'").agg(F.min(F.struct("tens", "id")).alias("m")).first().m
    assert last < first


def test_sample_size(numbered):
    few = S.sample_rows(numbered, 100, ["id"])
    assert few.count() == 100 and S.sample_rows(numbered, 5000, ["id"]).count() == 1037
    smallest = numbered.orderBy(S.digest(42, "id")).limit(100)
    assert few.exceptAll(smallest).count() == 0
    with pytest.raises(ValueError, match="identify a row"):
        S.sample_rows(numbered.select(F.lit(1).alias("id")), 100, ["id"])


@pytest.mark.parametrize("tail_rows", [200_000, 20])
def test_position_of_texts(spark, tail_rows):
    """Texts of any kind and shared beginnings, on both sides of what one task sorts."""
    texts = [f"same beginning {i:04d}" for i in range(500)] + ["", "a", "é", "😀", "Z", "same", "same beginning"]
    df = spark.createDataFrame([(t, t.encode()) for t in texts], "s string, b binary")
    ordered = sorted(texts, key=lambda t: t.encode())
    for position in (1, 4, 250, len(texts)):
        assert S.row_at(df, ["s"], position, tail_rows)["s"] == ordered[position - 1]
    assert S.row_at(df, ["b"], 250, tail_rows)["b"] == ordered[249]


def test_nulls_of_later_order_columns_are_refused(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "v int, s string")
    with pytest.raises(ValueError, match="null"):
        S.row_at(df, ["v", "s"], 1)


def test_random_split_covers_everything(numbered):
    train, test = S.random_split(numbered)
    assert train.count() + test.count() == 1037


def test_empty_input(spark):
    assert S.with_exact_split(spark.range(0), ["id"]).count() == 0
    assert S.sample_rows(spark.range(0), 5, ["id"]).count() == 0

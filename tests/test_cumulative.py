"""Running totals against plain Python, with buckets forced and values skewed."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators.cumulative import exact_quantiles, running_totals
from tests.conftest import plan_of


def skewed_rows(n=3000, seed=1):
    """A third of all rows share one value of one key."""
    rng = random.Random(seed)
    rows = [("hot", 5.0, 1)] * (n // 3)
    rows += [(rng.choice(["hot", "cold"]), round(rng.gauss(0, 50), 2), rng.randint(0, 3)) for _ in range(n - n // 3)]
    return rows


def expected(rows):
    sums = {}
    for key, value, weight in rows:
        sums[(key, value)] = sums.get((key, value), 0) + weight
    found, upto = {}, {}
    for key, value in sorted(sums):
        upto[key] = upto.get(key, 0) + sums[(key, value)]
        found[(key, value)] = (sums[(key, value)], upto[key])
    return found


@pytest.mark.parametrize("task_rows", [1_000_000, 500, 7])
def test_totals_do_not_depend_on_the_buckets(spark, task_rows):
    rows = skewed_rows()
    df = spark.createDataFrame(rows, "key string, value double, w bigint")
    totals = running_totals(df, "value", ["w"], ["key"], task_rows=task_rows)
    assert {(r.key, r.value): (r.w, r.w_upto) for r in totals.collect()} == expected(rows)


def test_one_value_only(spark):
    df = spark.createDataFrame([(1.0, 1)] * 50, "value double, w bigint")
    assert [tuple(r) for r in running_totals(df, "value", ["w"], task_rows=5).collect()] == [(1.0, 50, 50)]


def test_nulls_are_left_out_and_nothing_stays_nothing(spark):
    df = spark.createDataFrame([(None, 1), (2.0, 1)], "value double, w bigint")
    assert [tuple(r) for r in running_totals(df, "value", ["w"]).collect()] == [(2.0, 1, 1)]
    assert running_totals(df.filter("false"), "value", ["w"]).count() == 0


@pytest.mark.parametrize("task_rows", [1000, 5])
def test_rows_of_the_null_key_are_kept(spark, task_rows):
    df = spark.range(60).select(
        F.when(F.col("id") % 2 == 0, "k").alias("key"), F.col("id").cast("double").alias("v"), F.lit(1).cast("bigint").alias("w")
    )
    totals = running_totals(df, "v", ["w"], ["key"], task_rows=task_rows)
    assert {r.key: r.n for r in totals.groupBy("key").agg(F.max("w_upto").alias("n")).collect()} == {"k": 30, None: 30}
    quantiles = exact_quantiles(df, "v", [0.0, 1.0], ["key"], task_rows=task_rows)
    assert {r.key: (r.n, r.p0, r.p100) for r in quantiles.collect()} == {"k": (30, 0.0, 58.0), None: (30, 1.0, 59.0)}


def test_many_rows_are_never_sorted_in_one_task(spark):
    df = spark.range(5000).select(F.col("id").cast("double").alias("value"), F.lit(1).cast("bigint").alias("w"))
    plan = plan_of(running_totals(df, "value", ["w"], task_rows=100))
    alone = [line for line in plan.splitlines() if "Exchange SinglePartition" in line]
    assert len(alone) == 1, "only the bucket sums may meet in one task"
    windows = [line for line in plan.splitlines() if "Window" in line and "value" in line]
    assert windows and all("_range" in line for line in windows)


def test_quantiles_match_numpy(spark):
    rng = np.random.default_rng(3)
    values = {"a": rng.normal(size=501), "b": np.repeat(7.0, 40), "c": rng.integers(0, 5, 300).astype(float)}
    rows = [(k, float(v)) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(rows, "key string, value double")
    for task_rows in (1_000_000, 30):
        for r in exact_quantiles(df, "value", [0.0, 0.5, 0.95, 1.0], ["key"], task_rows=task_rows).collect():
            assert r.n == len(values[r.key])
            for share, found in ((0, r.p0), (50, r.p50), (95, r.p95), (100, r.p100)):
                assert found == pytest.approx(np.percentile(values[r.key], share))

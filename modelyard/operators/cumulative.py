"""Exact running totals over an ordered value, without a one-partition window."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from modelyard.operators.align import join_per_key
from modelyard.session import scratch_path

# Rows of one key that a single task may put in order; a larger key is spread over ranges of its values.
TASK_ROWS = 1_000_000


def largest_key(df: DataFrame, keys: list[str]) -> int:
    """Rows of the key that has most."""
    return df.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0


def _in_ranges(distinct: DataFrame, value: str, keys: list[str], task_rows: int) -> DataFrame:
    """The rows dealt by ranges of (keys, value), with the number of the range in ``_range``.

    The rows are distinct, so ranges come out even whatever the values. They are
    written, so that every reader sees the same ranges; nothing of them is sent to
    the rows or to the driver.
    """
    ranges = distinct.count() // task_rows + 2
    path = scratch_path(distinct.sparkSession, "ranges")
    dealt = distinct.repartitionByRange(ranges, *keys, value).withColumn("_range", F.spark_partition_id())
    dealt.write.parquet(path)
    return distinct.sparkSession.read.parquet(path)


def running_totals(
    df: DataFrame,
    value: str,
    measures: list[str],
    keys: list[str] | None = None,
    task_rows: int = TASK_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """One row per (keys, value): each measure's sum there, and ``<measure>_upto``,
    its sum over all values not above this one. Null values are left out.

    Rows are first reduced to distinct values, so a value repeated any number of
    times is one row afterwards. If a key has more rows than one task should put in
    order, all rows are dealt by ranges of key and value; a range adds up its own
    rows on top of the ranges below it. The totals are the same either way, for any
    number of keys and rows. ``largest``, a bound of the rows of any key, saves counting.
    """
    df, keys = df.filter(F.col(value).isNotNull()), keys or []
    largest = largest_key(df, keys) if largest is None else largest
    distinct = df.groupBy(*keys, value).agg(*[F.sum(m).alias(m) for m in measures])
    if largest <= task_rows:
        return _add_up(distinct, value, measures, keys)

    placed = _in_ranges(distinct, value, keys, task_rows)
    within = [*keys, "_range"]
    sums = placed.groupBy(*within).agg(*[F.sum(m).alias(m) for m in measures])
    # One row per key and range that holds it.
    below = _add_up(sums, "_range", measures, keys).select(
        *within, *[(F.col(f"{m}_upto") - F.col(m)).alias(f"_{m}_below") for m in measures]
    )
    inside = _add_up(placed, value, measures, within)
    return join_per_key(inside, below, within).select(
        *keys, value, *measures, *[(F.col(f"{m}_upto") + F.col(f"_{m}_below")).alias(f"{m}_upto") for m in measures]
    )


def _add_up(df: DataFrame, value: str, measures: list[str], within: list[str]) -> DataFrame:
    window = Window.partitionBy(*within).orderBy(value).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return df.select(*within, value, *measures, *[F.sum(m).over(window).alias(f"{m}_upto") for m in measures])


def exact_quantiles(
    df: DataFrame, value: str, shares: list[float], keys: list[str] | None = None, task_rows: int = TASK_ROWS
) -> DataFrame:
    """Interpolated quantiles per key, columns ``p<percent>``, and the row count ``n``."""
    keys = keys or []
    df = df.filter(F.col(value).isNotNull())
    counts = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    largest = counts.agg(F.max("_rows")).first()[0] or 0
    ones = df.withColumn("n", F.lit(1).cast("bigint"))
    totals = running_totals(ones, value, ["n"], keys, task_rows, largest)
    # Without keys the one count is the largest.
    joined = join_per_key(totals, counts, keys) if keys else totals.withColumn("_rows", F.lit(largest))

    def at_rank(rank: Column) -> Column:
        return F.min(F.when(F.col("n_upto") > rank, F.col(value)))

    picked = []
    for share in shares:
        rank = F.lit(share) * (F.col("_rows") - 1)
        name = f"p{share * 100:g}".replace(".", "_")
        low, high = at_rank(F.floor(rank)), at_rank(F.ceil(rank))
        part = F.max(rank - F.floor(rank))
        picked.append((low + (high - low) * part).alias(name))
    return joined.groupBy(*keys).agg(F.sum("n").alias("n"), *picked)

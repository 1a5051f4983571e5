"""Keyed forms of what an ordered, in-memory table does by position."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key with more than this part of the rows is spread; the sketch that finds such keys tracks so many for each.
PARTS, TRACKED = 200, 50


def concat_columns(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Columns side by side; each row of one finds its row of the other by key."""
    return left.join(right, key)


def align_predictions(truth: DataFrame, predictions: DataFrame, key: list[str]) -> DataFrame:
    return truth.join(predictions, key)


def zip_lists(first: Column, second: Column, names: tuple[str, str] = ("first", "second")) -> Column:
    """Array of pairs, as long as the shorter list."""
    n = F.least(F.size(first), F.size(second))
    pairs = F.zip_with(first, second, lambda a, b: F.struct(a.alias(names[0]), b.alias(names[1])))
    return F.slice(pairs, F.lit(1), n)


def class_name(position: Column, names: list[str]) -> Column:
    return F.get(F.array(*[F.lit(n) for n in names]), position)


def with_single(df: DataFrame, one_row: DataFrame, column: str) -> DataFrame:
    """The one value of a one-row frame on every row; Spark fails on a second row."""
    return df.withColumn(column, one_row.select(column).scalar())


def next_in_sequence(df: DataFrame, key: str, order: str, columns: list[str], prefix: str = "next_") -> DataFrame:
    """Each row with the columns of the row whose order value is one higher.

    A self-join on (key, order): rows of one long sequence spread over all tasks.
    """
    following = df.select(
        key, (F.col(order) - 1).alias(order), *[F.col(c).alias(f"{prefix}{c}") for c in columns]
    )
    return df.join(following, [key, order])


def heavy_keys(df: DataFrame, key: str, parts: int = PARTS) -> DataFrame:
    """_hash, _parts of the keys that hold more than one ``parts``-th of the rows: fewer than ``parts`` rows.

    The keys are found by a mergeable sketch of the most frequent hashes, in one
    pass and without a shuffle of rows; its error, about a hundredth of the bound,
    moves only the number of parts.
    """
    tracked = TRACKED * parts
    found = df.agg(
        F.expr(f"approx_top_k(xxhash64(`{key}`), {parts}, {tracked})").alias("top"), F.count(F.lit(1)).alias("all")
    )
    keys = found.select("all", F.inline("top")).filter(F.col("count") * parts > F.col("all"))
    return keys.select(F.col("item").alias("_hash"), F.ceil(F.col("count") * parts / F.col("all")).cast("int").alias("_parts"))


def keyed_join(
    left: DataFrame, right: DataFrame, key: str, how: str = "inner", parts: int = PARTS, spread: Column | None = None,
    heavy: DataFrame | None = None,
) -> DataFrame:
    """Join on a key that may hold any share of the left rows, the null key included.

    Only heavy keys (see ``heavy_keys``) are spread: their left rows over as many
    parts as their share asks for, their right rows repeated for each part. All
    other keys hold at most one ``parts``-th of the rows and are joined as they are.
    Whether a side is sent whole to every task is left to Spark, which goes by
    bytes. ``spread`` is what deals the rows of a heavy key (by default all their
    other columns: rows equal in all of them stay together). ``heavy`` may be given
    where it is known. A null key meets nothing.
    """
    if how not in ("inner", "left"):
        raise ValueError(f"how must be 'inner' or 'left', got {how!r}")
    others = [c for c in left.columns if c != key]
    deal = F.xxhash64(*others) if spread is None else spread
    few = F.broadcast(heavy_keys(left, key, parts) if heavy is None else heavy)
    dealt = left.withColumns({"_hash": F.xxhash64(key), "_deal": deal}).join(few, "_hash", "left")
    dealt = dealt.withColumn("_part", F.pmod(F.col("_deal"), F.coalesce("_parts", F.lit(1))).cast("int")).drop("_hash", "_deal", "_parts")
    copies = right.withColumn("_hash", F.xxhash64(key)).join(few, "_hash", "left")
    copies = copies.withColumn("_part", F.explode(F.sequence(F.lit(0), F.coalesce("_parts", F.lit(1)) - 1))).drop("_hash", "_parts")
    return dealt.join(copies, [key, "_part"], how).drop("_part")


def join_per_key(df: DataFrame, per_key: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Add the columns of a frame with one row per key; a null key meets the null key.

    Any number of keys: Spark sends ``per_key`` to every task if its size allows,
    and splits a key that holds too many rows otherwise.
    """
    few = per_key
    others = [c for c in few.columns if c not in keys]
    renamed = few.select(*[F.col(k).alias(f"_few_{k}") for k in keys], *others)
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_few_{k}")) for k in keys])
    return df.join(renamed, same, how).drop(*[f"_few_{k}" for k in keys])

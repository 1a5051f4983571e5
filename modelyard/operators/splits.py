"""Samples and train/test splits that give the same rows on every run."""

from __future__ import annotations

import math
import os
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, BooleanType, DateType, IntegralType, NumericType, StringType, TimestampNTZType, TimestampType

from modelyard.functions.keys import below_fraction, digest

TRAIN, TEST = "train", "test"
# Rows one task may sort to find a position, and buckets one pass counts.
TAIL_ROWS = 200_000
BUCKETS = 4096
# Hexadecimal digits of a digest, and how many of them one pass counts by.
DIGEST_LENGTH = 32
PASS_DIGITS = 3


def first_rows(df: DataFrame, n: int, *order_by: str) -> DataFrame:
    return df.orderBy(*order_by).limit(n)


def random_split(df: DataFrame, test_fraction: float = 0.2, seed: int = 42) -> tuple[DataFrame, DataFrame]:
    """Spark's own split; which rows fall where depends on the input's partitions."""
    train, test = df.randomSplit([1.0 - test_fraction, test_fraction], seed=seed)
    return train, test


def with_hash_split(df: DataFrame, key: list[str], test_fraction: float = 0.2, seed: int = 42) -> DataFrame:
    """A ``split`` column decided from each row's key: no shuffle, no count."""
    side = F.when(below_fraction(seed, test_fraction, *key), TEST).otherwise(TRAIN)
    return df.withColumn("split", side)


def hash_split(
    df: DataFrame, key: list[str], test_fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    marked = with_hash_split(df, key, test_fraction, seed)
    return tuple(marked.filter(F.col("split") == s).drop("split") for s in (TRAIN, TEST))


def _offset(df: DataFrame, name: str, low: str) -> Column:
    """Distance of a column from a value of its own, as a double."""
    kind, here, start = df.schema[name].dataType, F.col(name), F.lit(low)
    if isinstance(kind, IntegralType):
        return (here.cast("decimal(20,0)") - start.cast("decimal(20,0)")).cast("double")
    if isinstance(kind, NumericType):
        return here.cast("double") - start.cast("double")
    if isinstance(kind, DateType):
        return F.datediff(here, start.cast("date")).cast("double")
    if isinstance(kind, TimestampType):
        return (F.unix_micros(here) - F.unix_micros(start.cast(kind))).cast("double")
    if isinstance(kind, TimestampNTZType):
        days = F.datediff(here.cast("date"), start.cast(kind).cast("date"))
        seconds = F.hour(here) * 3600 + F.minute(here) * 60 + F.extract(F.lit("SECOND"), here)
        return days * F.lit(86400.0) + seconds.cast("double")
    if isinstance(kind, BooleanType):
        return here.cast("int").cast("double")
    raise TypeError(f"{name}: a column of {kind.simpleString()} has no order")


def _slices(df: DataFrame, name: str, low: str, high: str) -> Column:
    """The slice (in order) of the current values between ``low`` and ``high`` that a row falls in.

    Texts and bytes are sliced by the hexadecimal digits behind the ones that all share.
    """
    if isinstance(df.schema[name].dataType, (StringType, BinaryType)):
        digits = F.hex(F.col(name).cast("binary"))
        ends = df.agg(F.min(digits), F.max(digits)).first()
        return F.substring(digits, len(os.path.commonprefix(list(ends))) + 1, PASS_DIGITS)
    offset = _offset(df, name, low)
    first, last = df.agg(F.min(offset), F.max(offset)).first()
    if first == last:
        raise ValueError(f"{name}: values differ by less than a double can tell")
    share = (offset - F.lit(first)) / F.lit(last - first)
    return F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1)).cast("int")


def row_at(df: DataFrame, order_by: list[str], position: int, tail_rows: int = TAIL_ROWS) -> dict[str, str]:
    """The order columns, as text, of the row at a 1-based position, without a
    global sort.

    Each pass counts rows in equal slices of the current value range and keeps
    the one slice holding the position, until few enough rows are left for one
    task to sort. A slice made of a single value moves on to the next column,
    so one value holding most rows costs another pass, not a large sort.
    """
    tail, need = df.select(*order_by), position
    known = tail.agg(F.count("*").alias("_rows"), *[F.count(c).alias(c) for c in order_by]).first()
    unknown = [c for c in order_by if known[c] < known["_rows"]]
    if unknown:
        raise ValueError(f"{unknown} null in some rows: they have no position")
    for name in order_by:
        while True:
            rows, low, high = tail.agg(F.count("*"), F.min(name).cast("string"), F.max(name).cast("string")).first()
            if rows <= tail_rows:
                upto = tail.orderBy(*order_by).limit(need + 1).orderBy(*[F.desc(c) for c in order_by]).limit(2)
                last = upto.select([F.col(c).cast("string") for c in order_by]).collect()
                if rows > need and last[0] == last[1]:
                    raise ValueError(f"columns {order_by} must identify a row: copies fall on both sides of the cut")
                return last[0 if rows == need else 1].asDict()
            if low == high:
                break
            slot = _slices(tail, name, low, high)
            for found, n in sorted(tail.groupBy(slot.alias("slot")).count().collect()):
                if need <= n:
                    break
                need -= n
            tail = tail.filter(slot == found)
    raise ValueError(f"columns {order_by} must identify a row: copies fall on both sides of the cut")


def _not_after(df: DataFrame, order_by: list[str], row: dict[str, str]) -> Column:
    """Lexicographic ``order_by <= row`` as plain comparisons."""
    alternatives, same = [], F.lit(True)
    for name in order_by:
        bound = F.lit(row[name]).cast(df.schema[name].dataType)
        alternatives.append(same & (F.col(name) < bound))
        same = same & (F.col(name) == bound)
    return reduce(lambda a, b: a | b, [*alternatives, same])


def digest_at(
    df: DataFrame, key: list[str], seed: int, position: Callable[[int], int], tail_rows: int = TAIL_ROWS
) -> str:
    """The digest at a 1-based position among all rows' digests.

    ``position`` is worked out from the number of rows, which the first pass finds.
    Digests are evenly spread, so counting rows by their leading digits narrows
    the search 4096-fold per pass. Empty when no row is to be taken.
    """
    tail, need, at = df.select(digest(seed, *key).alias("digest")), None, 1
    while at <= DIGEST_LENGTH:
        leading = F.substring("digest", at, PASS_DIGITS)
        counts = sorted(tail.groupBy(leading.alias("leading")).count().collect())
        if need is None:
            need = position(sum(n for _, n in counts))
            if need <= 0:
                return ""
        for found, n in counts:
            if need <= n:
                break
            need -= n
        tail, at = tail.filter(leading == found), at + PASS_DIGITS
        if n <= tail_rows:
            last = tail.orderBy("digest").limit(need + 1).orderBy(F.desc("digest")).limit(2).collect()
            if n > need and last[0] == last[1]:
                break
            return last[0 if n == need else 1]["digest"]
    raise ValueError(f"columns {key} must identify a row: copies fall on both sides of the cut")


def _with_first(
    df: DataFrame, key: list[str], seed: int, position: Callable[[int], int], inside: str, outside: str
) -> DataFrame:
    cut = digest_at(df, key, seed, position)
    return df.withColumn("split", F.when(digest(seed, *key) <= cut, inside).otherwise(outside))


def with_exact_split(
    df: DataFrame, key: list[str], test_fraction: float = 0.2, seed: int = 42
) -> DataFrame:
    """Exactly ceil(fraction * rows) test rows: those with the smallest seeded
    digest. ``key`` must be unique. The digest of the last test row is found by
    counting, then every row is marked where it stands, without a shuffle."""
    return _with_first(df, key, seed, lambda rows: _share(rows, test_fraction), TEST, TRAIN)


def exact_split(
    df: DataFrame, key: list[str], test_fraction: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    marked = with_exact_split(df, key, test_fraction, seed)
    return tuple(marked.filter(F.col("split") == s).drop("split") for s in (TRAIN, TEST))


def _share(rows: int, fraction: float) -> int:
    return math.ceil(round(fraction * rows, 9))


def with_ordered_split(df: DataFrame, order_by: list[str], test_fraction: float = 0.5) -> DataFrame:
    """The first rows in the given total order train, the rest test."""
    rows = df.count()
    n_train = rows - _share(rows, test_fraction)
    if n_train <= 0:
        return df.withColumn("split", F.lit(TEST))
    inside = _not_after(df, order_by, row_at(df, order_by, n_train))
    return df.withColumn("split", F.when(inside, TRAIN).otherwise(TEST))


def sample_rows(df: DataFrame, n: int, key: list[str], seed: int = 42) -> DataFrame:
    """Exactly min(n, rows) rows: those with the smallest seeded digest of a unique key.

    As in ``with_exact_split``, the last digest is found by counting and rows are
    marked where they stand, for every ``n``.
    """
    marked = _with_first(df, key, seed, lambda rows: min(n, rows), "in", "out")
    return marked.filter("split = 'in'").drop("split")

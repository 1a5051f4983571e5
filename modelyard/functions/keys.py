"""Seeded, engine-independent row digests."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# 15 hexadecimal digits fit a signed 64-bit integer and keep the digest's order.
DIGEST_DIGITS = 15


def digest(seed: int, *key: str) -> Column:
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]))


def digest_number(seed: int, *key: str) -> Column:
    return F.conv(F.substring(digest(seed, *key), 1, DIGEST_DIGITS), 16, 10).cast("bigint")


def below_fraction(seed: int, fraction: float, *key: str) -> Column:
    """True for about ``fraction`` of the keys, decided row by row."""
    if fraction >= 1:
        return F.lit(True)
    return F.substring(digest(seed, *key), 1, 8) < f"{int(fraction * 2**32):08x}"


def fold_number(seed: int, folds: int, *key: str) -> Column:
    return (digest_number(seed, *key) % folds).cast("int")

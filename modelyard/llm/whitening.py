"""Embedding whitening by a polarisation covariance.

The variance of a sum of two dimensions differs from the sum of their variances
by twice their covariance. So squared centred values are added up, exactly, for
every dimension and for every sum of two dimensions; their differences are the
covariance matrix, whose eigenvectors and eigenvalues whiten the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal
from fractions import Fraction

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table
from .mixing import stored

SCALE = 256
COMPONENTS = 4
# The covariance of so many dimensions, the most that is accepted, fits the driver.
MOST_DIMENSIONS = 4096
# Exact sums travel as two decimals, this many bits below.
SPLIT = 48
# Rows that a task adds up at once.
ROWS_AT_ONCE = 4096
# Eigenvalues below this share of the largest are rounding errors.
LEAST_SHARE = 1e-12


def whole_vector(vector: Column) -> Column:
    """floor(SCALE * c) of each entry as array<bigint>; null if the vector or an entry is null or not finite.

    Entries beyond the range of a long become its ends.
    """
    entries = F.transform(vector, lambda c: c.cast("double"))
    fine = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    return F.when(vector.isNotNull() & fine, F.transform(entries, lambda c: F.floor(c * SCALE)))


def padded(batch: pd.Series, size: int) -> np.ndarray:
    """The vectors as rows of a matrix of exact integers; short ones end in zeros."""
    out = np.zeros((len(batch), size), dtype=np.int64)
    for i, vector in enumerate(batch):
        out[i, : len(vector)] = vector
    return out


def fits(bound: int) -> bool:
    """Whether all integers up to ``bound`` in size are exact in 64 bits."""
    return bound < 1 << 63


def widest(x: np.ndarray) -> int:
    """The largest size of an entry."""
    return max(int(x.max(initial=0)), -int(x.min(initial=0)))


def shifted(x: np.ndarray, shift: list[int]) -> np.ndarray:
    """x - shift, exact; Python integers where 64 bits might not do for squares of sums of two."""
    wide = widest(x) + max(map(abs, shift), default=0)
    if fits(4 * wide * wide * max(len(x), 1)):
        return x - np.array(shift, dtype=np.int64)
    return x.astype(object) - np.array(shift, dtype=object)


def added(rows: DataFrame, size: int, width: int, sums) -> dict[tuple[int, int], int]:
    """{(i, j): exact sum over all rows} of ``sums(matrix)``, a list of ``width`` integers for each i below ``size``.

    Each task adds up its rows and gives a number for each (i, j), which Spark
    adds up in turn: the driver gets size * width numbers, whatever the rows.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = None
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                found = [[int(v) for v in line] for line in sums(padded(batch["x"].iloc[at : at + ROWS_AT_ONCE], size))]
                total = found if total is None else [[a + b for a, b in zip(p, q)] for p, q in zip(total, found)]
        if total is not None:
            cells = [(i, j, v) for i, line in enumerate(total) for j, v in enumerate(line)]
            yield pd.DataFrame(
                {
                    "i": [c[0] for c in cells],
                    "j": [c[1] for c in cells],
                    "high": [Decimal(c[2] >> SPLIT) for c in cells],
                    "low": [Decimal(c[2] & ((1 << SPLIT) - 1)) for c in cells],
                }
            )

    parts = rows.select("x").mapInPandas(run, "i int, j int, high decimal(38,0), low decimal(38,0)")
    summed = parts.groupBy("i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {(r.i, r.j): (int(r.high) << SPLIT) + int(r.low) for r in summed.toLocalIterator()}


@dataclass
class Whitener:
    """What the fit knows: n vectors, exact sums, and the components of their covariance."""

    n: int
    sums: list[int]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def kept(self) -> int:
        return min(COMPONENTS, len(self.values))

    def split(self) -> tuple[list[int], list[int]]:
        """Whole part of each mean, and what is left of the sum, from 0 to n - 1."""
        return [s // self.n for s in self.sums], [s % self.n for s in self.sums]

    def projected(self, x: np.ndarray, components: int) -> np.ndarray:
        """Whitened values of the first components, a row each; 0 for a component without variance."""
        whole, rest = self.split()
        centred = shifted(x, whole).astype(float) - np.array([r / self.n for r in rest])
        real = self.values[:components] > LEAST_SHARE * max(self.values.max(initial=0.0), 0.0)
        scale = np.where(real, 1 / np.sqrt(np.where(real, self.values[:components], 1.0)), 0.0)
        return centred @ self.vectors[:, :components] * scale

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Sum over dimensions of (n * x - sum)^2, exact; None where it does not fit a long."""
        whole, rest = self.split()
        centred = shifted(x, whole)
        wide = self.n * (widest(centred) + 1)
        if fits(wide * wide * max(x.shape[1], 1)):
            y = centred.astype(np.int64) * self.n - np.array(rest, dtype=np.int64)
            return [int(v) for v in (y * y).sum(axis=1)]
        y = centred.astype(object) * self.n - np.array(rest, dtype=object)
        found = [int(v) for v in (y * y).sum(axis=1)]
        return [v if fits(v) else None for v in found]


def polarised(n: int, rest: list[int], singles: list[int], pairs: dict[tuple[int, int], int], totals: list[int]) -> np.ndarray:
    """The covariance matrix from exact sums of squares.

    d is x less the whole part of its mean, y = n * d - rest is n times the centred
    value. ``singles`` has the sums of d_i^2, ``pairs`` those of (d_i + d_j)^2 and
    ``totals`` those of d_i, from which the sums for y follow exactly.
    """
    size = len(rest)

    def squares(of_d: int, total: int, left: int) -> int:
        return n * n * of_d - 2 * n * left * total + n * left * left

    own = [squares(singles[i], totals[i], rest[i]) for i in range(size)]
    matrix = np.zeros((size, size))
    for i in range(size):
        matrix[i, i] = float(Fraction(own[i], n**3))
        for j in range(i + 1, size):
            both = squares(pairs[i, j], totals[i] + totals[j], rest[i] + rest[j])
            matrix[i, j] = matrix[j, i] = float(Fraction(both - own[i] - own[j], 2 * n**3))
    return matrix


def fitted(distinct: DataFrame) -> Whitener | None:
    """Means, covariance and components of the rows of ``distinct`` (x array<bigint>), or None if there are none.

    Two passes: sums, then squares of centred values, as many for each row as
    there are pairs of dimensions.
    """
    n, size = distinct.agg(F.count(F.lit(1)), F.max(F.size("x"))).first()
    if not n:
        return None
    if size > MOST_DIMENSIONS:
        raise ValueError(f"vectors of {size} dimensions; at most {MOST_DIMENSIONS}")

    def plain(x: np.ndarray) -> list:
        bound = widest(x) * max(len(x), 1)
        return [[v] for v in (x if fits(bound) else x.astype(object)).sum(axis=0)]

    found = added(distinct, size, 1, plain)
    sums = [found[i, 0] for i in range(size)]
    whole, rest = [s // n for s in sums], [s % n for s in sums]

    def squared(x: np.ndarray) -> list:
        d = shifted(x, whole)
        lines = []
        for i in range(size):
            both = d[:, i : i + 1] + d[:, i + 1 :]
            lines.append([0] * i + [(d[:, i] * d[:, i]).sum(), *(both * both).sum(axis=0)])
        return lines

    cells = added(distinct, size, size, squared)
    totals = [s - n * w for s, w in zip(sums, whole)]
    singles = [cells[i, i] for i in range(size)]
    matrix = polarised(n, rest, singles, cells, totals)
    values, vectors = np.linalg.eigh(matrix) if size else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")
    return Whitener(n, sums, np.maximum(values[order], 0.0), vectors[:, order], float(np.trace(matrix)))


def identity_error(distinct: DataFrame, fit: Whitener) -> float:
    """Largest absolute entry of the whitened vectors' covariance less the identity, over components with variance."""
    size, kept = len(fit.sums), fit.kept

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((kept, kept + 1))
        for batch in batches:
            w = fit.projected(padded(batch["x"], size), kept)
            total += np.column_stack([w.T @ w, w.sum(axis=0)])
        yield pd.DataFrame([(i, j, total[i, j]) for i in range(kept) for j in range(kept + 1)], columns=["i", "j", "s"])

    sums = distinct.select("x").mapInPandas(run, "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s")).collect()
    total = np.zeros((kept, kept + 1))
    for r in sums:
        total[r.i, r.j] = r.s
    means = total[:, kept] / fit.n
    real = fit.values[:kept] > LEAST_SHARE * fit.values.max(initial=0.0)
    error = total[:, :kept] / fit.n - np.outer(means, means) - np.eye(kept)
    return float(np.abs(error[np.ix_(real, real)]).max(initial=0.0))


def whitened(rows: DataFrame, key: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """``key``, component, n, deviation, whitened, explained, identity_error of every fit row and component.

    Rows whose vector is null or has a null or non-finite entry are left out.
    The fit takes each distinct vector of whole numbers once, so a vector may have
    any share of the rows; repeated rows and null keys come out as they are.
    Vectors shorter than the longest count as if they ended in zeros. There are at
    most as many components as dimensions; one without variance whitens to 0 and
    explains 0. deviation is null where it does not fit a long. An empty table, or
    one of empty vectors, gives no rows; other columns are not read. Tasks hold a
    batch of vectors and one number for each pair of dimensions.
    """
    spark = rows.sparkSession
    whole = rows.select(F.col(key).alias("id"), whole_vector(F.col(vector)).alias("x")).filter("x IS NOT NULL")
    size = whole.agg(F.max(F.size("x"))).first()[0] or 0
    # Trailing zeros are added before vectors are told apart.
    whole = whole.withColumn("x", F.concat("x", F.array_repeat(F.lit(0).cast("bigint"), F.lit(size) - F.size("x"))))
    distinct = stored(whole.select("x").distinct(), "distinct-vectors")
    fit = fitted(distinct)
    kind = rows.schema[key].dataType.simpleString()
    schema = f"`{key}` {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if fit is None:
        return spark.createDataFrame([], schema)
    error, kept = identity_error(distinct, fit), fit.kept
    shares = fit.values[:kept] / fit.trace if fit.trace > 0 else np.zeros(kept)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x = padded(batch["x"], size)
            values, deviations = fit.projected(x, kept), fit.deviations(x)
            yield pd.DataFrame(
                {
                    key: batch["id"].repeat(kept),
                    "component": np.tile(np.arange(1, kept + 1), len(batch)),
                    "n": fit.n,
                    "deviation": pd.array(deviations, dtype="Int64").repeat(kept),
                    "whitened": values.ravel(),
                    "explained": np.tile(shares, len(batch)),
                    "identity_error": error,
                }
            )

    return whole.mapInPandas(run, schema)


def op12_polarised_whitening(spark: SparkSession, folder: str) -> DataFrame:
    """Whitened components of every vector of embeddings."""
    return whitened(table(spark, folder, "embeddings"))

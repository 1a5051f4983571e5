"""Sums against exact fractions, components against a plain covariance, and edge cases."""

from fractions import Fraction
from math import floor, inf, nan

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import whitening as w
from modelyard.llm.common import table

SCHEMA = "vec_id long, embedding array<float>"


def plain(rows):
    """n, sums, exact covariance of the distinct whole vectors, and each row's vector."""
    x = {}
    for at, (_, vector) in enumerate(rows):
        if vector is not None and all(c is not None and abs(c) < inf for c in vector):
            x[at] = tuple(floor(256 * float(np.float32(c))) for c in vector)
    size = max(map(len, x.values()), default=0)
    x = {at: v + (0,) * (size - len(v)) for at, v in x.items()}
    fit = sorted(set(x.values()))
    n = len(fit)
    sums = [sum(v[i] for v in fit) for i in range(size)]
    means = [Fraction(s, n) for s in sums] if n else []
    cov = [[sum((v[i] - means[i]) * (v[j] - means[j]) for v in fit) / n for j in range(size)] for i in range(size)]
    return n, sums, np.array([[float(c) for c in line] for line in cov]).reshape(size, size), x


def compare(rows, found):
    n, sums, cov, x = plain(rows)
    values, vectors = np.linalg.eigh(cov)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(4, len(sums))
    got = {}
    for r in found:
        got.setdefault((r.vec_id, r.deviation), []).append(r)
        assert r.n == n
    want = {}
    for at, v in x.items():
        deviation = sum((n * c - s) ** 2 for c, s in zip(v, sums))
        want.setdefault((rows[at][0], deviation if deviation < 1 << 63 else None), []).append(v)
    assert {key: len(v) * k for key, v in want.items()} == {key: len(v) for key, v in got.items()}
    trace = sum(np.diag(cov))
    for key, lines in got.items():
        for v in want[key]:
            centred = np.array([float(c - Fraction(s, n)) for c, s in zip(v, sums)])
            for component in range(k):
                mine = [r for r in lines if r.component == component + 1]
                if values[component] > 1e-6 * values[0]:
                    score = abs(centred @ vectors[:, component]) / values[component] ** 0.5
                    assert any(abs(r.whitened) == pytest.approx(score, abs=1e-6) for r in mine)
                elif values[component] < w.LEAST_SHARE / 10 * values[0]:
                    assert all(r.whitened == 0 for r in mine)
                assert all(r.explained == pytest.approx(values[component] / trace if trace else 0, rel=1e-6, abs=1e-9) for r in mine)
                assert all(r.identity_error < 1e-5 for r in mine)


def test_query_equals_brute_force(spark, folder):
    rows = [(r.vec_id, r.embedding) for r in table(spark, folder, "embeddings").select("vec_id", "embedding").collect()]
    n, sums, cov, x = plain(rows)
    found = w.op12_polarised_whitening(spark, folder).collect()
    assert len(found) == 4 * len(x) and {r.n for r in found} == {n}
    assert len({r.identity_error for r in found}) == 1 and found[0].identity_error < 1e-9
    values, vectors = np.linalg.eigh(cov)
    by_id = {vec_id: x[at] for at, (vec_id, _) in enumerate(rows) if at in x}
    signs = {}
    for r in found:
        v, e = vectors[:, -r.component], values[-r.component]
        centred = np.array([c - s / n for c, s in zip(by_id[r.vec_id], sums)])
        score = centred @ v / e**0.5
        sign = signs.setdefault(r.component, 1 if abs(r.whitened - score) < abs(r.whitened + score) else -1)
        assert r.whitened == pytest.approx(sign * score, abs=1e-8)
        assert r.explained == pytest.approx(e / np.trace(cov), rel=1e-9)
        assert r.deviation == sum((n * c - s) ** 2 for c, s in zip(by_id[r.vec_id], sums))


def test_edges(spark):
    rows = [
        (1, [1.0, 2.0, 0.5]), (1, [1.0, 2.0, 0.5]), (None, [0.25, -2.0, 0.0]), (3, None), (4, [1.0, None, 2.0]), (5, [nan, 1.0, 1.0]),
        (6, [inf, 1.0, 1.0]), (7, [0.5]), (8, []), (9, [0.5, 0.0, 0.0]), (10, [0.001, -0.001, -0.004]), (11, [3.0, -1.0, 7.5]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    compare(rows, w.whitened(df.withColumn("n", F.lit("clash")).withColumn("x", F.lit(0))).collect())


def test_degenerate_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert w.whitened(empty).count() == 0
    assert w.whitened(spark.createDataFrame([(1, None), (2, [])], SCHEMA)).count() == 0
    same = w.whitened(spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0, 2.0])], SCHEMA)).collect()
    assert sorted((r.vec_id, r.component, r.n, r.deviation, r.whitened, r.explained) for r in same) == [
        (i, c, 1, 0, 0.0, 0.0) for i in (1, 2) for c in (1, 2)
    ]
    compare(rows := [(i, [float(i), 2.0 * i]) for i in range(5)], w.whitened(spark.createDataFrame(rows, SCHEMA)).collect())


def test_large_entries_stay_exact(spark):
    rows = [(i, [float(1 << 40) + i * 2.0**20, float(-(i**3)) * 2.0**30, 1.0 * i]) for i in range(6)] + [(9, [3e38, 0.0, 0.0])]
    for part in (rows[:6], rows):
        found = w.whitened(spark.createDataFrame(part, SCHEMA)).collect()
        assert len(found) == 3 * len(part)
    compare(rows[:6], w.whitened(spark.createDataFrame(rows[:6], SCHEMA)).collect())


def test_polarisation_is_exact():
    rng = np.random.default_rng(5)
    d = rng.integers(-50, 50, (40, 3)).tolist()
    n, rest = 40, [sum(v[i] for v in d) % 40 for i in range(3)]
    whole = [sum(v[i] for v in d) // 40 for i in range(3)]
    d = [[v[i] - whole[i] for i in range(3)] for v in d]
    pairs = {(i, j): sum((v[i] + v[j]) ** 2 for v in d) for i in range(3) for j in range(i + 1, 3)}
    found = w.polarised(n, rest, [sum(v[i] ** 2 for v in d) for i in range(3)], pairs, [sum(v[i] for v in d) for i in range(3)])
    assert found == pytest.approx(np.cov(np.array(d).T, bias=True), rel=1e-13)

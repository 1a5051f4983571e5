"""The booster against plain Python, both ways of adding up, saved copies, and edge cases."""

import json

import numpy as np
import pytest
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from modelyard.operators import boosting as b


def vectors(spark, x, y):
    rows = [(i, [float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, x array<double>, label double").withColumn("features", array_to_vector("x"))


def plain_rounds(x, y, rounds, step, leaves, depth, min_rows):
    """Boosting of squared loss, every split looked for over all rows and all midpoints."""
    cuts = [sorted(set(x[:, f])) for f in range(x.shape[1])]
    cuts = [[(a + c) / 2 for a, c in zip(v, v[1:])] for v in cuts]
    score = np.full(len(y), y.mean())

    def best(rows):
        g = score[rows] - y[rows]
        options = [(0.0, 0, 0.0)]
        for f, at in enumerate(cuts):
            for cut in at:
                left = x[rows, f] <= cut
                if min(left.sum(), (~left).sum()) >= min_rows:
                    gain = g[left].sum() ** 2 / left.sum() + g[~left].sum() ** 2 / (~left).sum() - g.sum() ** 2 / len(g)
                    options.append((gain, f, cut))
        return max(options, key=lambda o: o[0])

    for _ in range(rounds):
        parts = [(best(np.arange(len(y))), np.arange(len(y)), 0)]
        done = []
        while parts and len(parts) + len(done) < leaves:
            parts.sort(key=lambda p: p[0][0])
            (gain, f, cut), rows, level = parts.pop()
            if gain <= 1e-12:
                done.append(rows)
                continue
            for side in (rows[x[rows, f] <= cut], rows[x[rows, f] > cut]):
                if level + 1 < depth:
                    parts.append((best(side), side, level + 1))
                else:
                    done.append(side)
        change = np.zeros(len(y))
        for rows in [p[1] for p in parts] + done:
            change[rows] = step * (y[rows] - score[rows]).mean()
        score = score + change
    return score


def data(seed, n=300):
    rng = np.random.default_rng(seed)
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 7, n), rng.integers(0, 3, n)]).astype(float)
    return x, x[:, 0] * (1 + (x[:, 1] > 3)) - 5 * (x[:, 2] == 1) + rng.normal(0, 0.1, n)


def test_equals_plain_boosting(spark):
    x, y = data(1)
    model = b.booster("label", rounds=6, step=0.3, depth=4, leaves=7, min_rows=5).fit(vectors(spark, x, y))
    got = {r.id: r.prediction for r in model.transform(vectors(spark, x, y)).collect()}
    assert [got[i] for i in range(len(y))] == pytest.approx(plain_rounds(x, y, 6, 0.3, 7, 4, 5), abs=1e-8)
    assert all(sum(left < 0 for left in t.left) <= 7 and max(t.depth) <= 4 for trees in model.rounds for t in trees)
    assert np.argmax(model.featureImportances.toArray()) == 0


def chunks_of(spark, x, y, classes=1, soft=False, start=(0.0,)):
    rows = vectors(spark, x, y).select("x", F.col("label").alias("y"), (F.col("id") % 10 == 0).alias("watched"))
    cuts = b.feature_cuts(rows, x.shape[1], 255)
    return b.chunked(rows.repartition(5), cuts, classes, soft, list(start)), max(map(len, cuts)) + 2


@pytest.mark.parametrize("soft", [False, True])
def test_many_tasks_grow_the_trees_of_one_task(spark, tmp_path, monkeypatch, soft):
    x, y = data(2)
    monkeypatch.setattr(b, "REFRESH", 2)
    if soft:
        y = (np.digitize(y, [5, 12])).astype(float)
    settings = b.Settings(loss="softmax" if soft else "squared", rounds=3, step=0.3, depth=3, leaves=5, min_rows=3, patience=2, l2=1.0)
    classes = 3 if soft else 1
    chunks, width = chunks_of(spark, x, y, classes, soft, [0.0] * classes if soft else [float(y.mean())])
    chunks.write.parquet(f"file://{tmp_path}/c")
    stored = spark.read.parquet(f"file://{tmp_path}/c")
    unit = 2.0**-36
    one = b.fit_rounds(stored, settings, unit, width, 3, classes)
    many = b.fit_rounds(stored, settings, unit, width, 3, classes, one_task_cells=0)
    assert one == many and len(one) == 3 and len(one[0]) == classes


def test_joint_classes(spark):
    rng = np.random.default_rng(4)
    x = rng.normal(size=(600, 4))
    y = np.argmax(np.column_stack([x[:, 0], x[:, 1] * 1.2, -x[:, 0] * x[:, 1]]), axis=1).astype(float)
    train, test = vectors(spark, x[:400], y[:400]), vectors(spark, x[400:], y[400:])
    model = b.joint_classifier("label", rounds=30).fit(train)
    rows = model.transform(test).select("label", "prediction", "probability").collect()
    assert np.mean([r.label == r.prediction for r in rows]) > 0.85
    assert all(abs(sum(r.probability) - 1) < 1e-9 and np.argmax(r.probability) == r.prediction for r in rows)


def test_softmax_slopes_are_derivatives():
    rng = np.random.default_rng(6)
    n, t = np.array([4.0, 2.0]), np.array([[1.0, 3.0, 0.0], [0.0, 1.0, 1.0]])
    cells = b.Cells(np.zeros((2, 1), dtype=np.uint8), n, t, n, t, n, rng.normal(size=(2, 3)))
    settings, unit = b.Settings(loss="softmax"), 2.0**-40
    g = cells.slopes(settings, unit)[0] * unit
    for i in range(2):
        for k in range(3):
            moved = [b.Cells(cells.bins, n, t, n, t, n, cells.score + d * np.eye(2)[:, [i]] * np.eye(3)[k]) for d in (1e-5, -1e-5)]
            slope = (moved[0].watched_loss(settings) - moved[1].watched_loss(settings)) / 2e-5
            assert g[i, k] == pytest.approx(slope, abs=1e-6)


def test_early_stopping_above_ten_thousand_rows(spark):
    df = spark.range(12000).select(F.col("id"), F.array((F.col("id") % 8).cast("double")).alias("x"), (F.pmod(F.xxhash64("id"), F.lit(100)) / 10).alias("label"))
    model = b.hist_regressor("label", rounds=200, depth=3).fit(df.withColumn("features", array_to_vector("x")))
    assert len(model.rounds) < 200


def test_saved_in_a_pipeline(spark, tmp_path):
    x, y = data(7, 120)
    df = vectors(spark, x, y)
    model = Pipeline(stages=[b.booster("label", rounds=4)]).fit(df)
    path = f"file://{tmp_path}/m"
    model.write().overwrite().save(path)
    again = PipelineModel.load(path)
    assert again.transform(df).select("id", "prediction").exceptAll(model.transform(df).select("id", "prediction")).count() == 0
    assert json.loads(again.stages[0].body) == json.loads(model.stages[0].body)


def test_edges(spark):
    x, y = np.array([[1.0], [np.nan], [2.0]] * 30), np.array([0.0, 9.0, 3.0] * 30)
    df = vectors(spark, x, y)
    odd = df.union(df.limit(1).withColumn("label", F.lit(None).cast("double")))
    model = b.booster("label", rounds=40, step=0.5, min_rows=5).fit(odd)
    got = {r.x[0]: r.prediction for r in model.transform(df).collect()}
    assert {k: round(v, 3) for k, v in got.items() if k == k} == {1.0: 0.0, 2.0: 3.0}
    assert [round(v, 3) for k, v in got.items() if k != k][0] == 9.0
    empty = b.booster("label", rounds=2).fit(df.limit(0))
    assert {r.prediction for r in empty.transform(df).collect()} == {0.0}
    same = b.booster("label", rounds=2).fit(df.withColumn("label", F.lit(4.0)))
    assert {r.prediction for r in same.transform(df).collect()} == {4.0}


def test_many_cells_are_dealt_to_many_tasks(spark):
    x = np.random.default_rng(5).integers(0, 200, (20_000, 3)).astype(float)
    rows = spark.createDataFrame([(list(map(float, r)), 1.0, False) for r in x], "x array<double>, y double, watched boolean")
    chunks = b.chunked(rows, b.feature_cuts(rows, 3, 255), 1, False, [1.0]).cache()
    assert max(r.n for r in chunks.select(F.expr("length(n) / 8").alias("n")).collect()) <= 1 << 14
    assert b.spread(chunks).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism


def test_of_two_siblings_one_is_added_up(monkeypatch):
    rng = np.random.default_rng(6)
    bins, n, t = rng.integers(0, 30, (1000, 2)).astype(np.uint8), np.ones(1000), rng.normal(size=(1000, 1))
    cells, added = b.Cells(bins, n, t, n * 0, t * 0, n * 0, np.zeros((1000, 1))), []
    sums = b.Cells.sums
    monkeypatch.setattr(b.Cells, "sums", lambda self, slopes, tree, at, nodes, width: added.append(int(np.isin(at, nodes).sum())) or sums(self, slopes, tree, at, nodes, width))
    settings = b.Settings(rounds=1, depth=4, leaves=0, min_rows=1)
    one = b.boosted(b.OneTask(cells, settings, 2.0**-30, 32), settings, 1)
    assert added[0] == 1000 and len(added) == 4 and max(added[1:]) <= 500
    monkeypatch.setattr(b, "HELD_BYTES", 0)
    assert b.boosted(b.OneTask(b.Cells(bins, n, t, n * 0, t * 0, n * 0, np.zeros((1000, 1))), settings, 2.0**-30, 32), settings, 1) == one
    assert max(added[4:]) == 1000


def test_a_cell_is_scored_once(monkeypatch):
    tree = b.Tree(feature=[1, 0, 0], bin=[0, 0, 0], left=[1, -1, -1], right=[2, -1, -1], value=[0.0, 1.5, -2.0], gain=[1.0, 0.0, 0.0], depth=[0, 1, 1])
    model = {"loss": "squared", "start": [10.0], "cuts": [[0.5, 1.5], [3.0]], "rounds": [[vars(tree)], [vars(tree)]]}
    values = np.array([[0.0, 1.0], [1.0, 9.0], [np.nan, np.nan], [0.0, 2.0]] * 50)
    scored, leaf_of = [], b.Tree.leaf_of
    monkeypatch.setattr(b.Tree, "leaf_of", lambda self, bins, at=None: scored.append(len(bins)) or leaf_of(self, bins, at))
    scores = b.scorer(model)
    assert scores(values).ravel().tolist() == [13.0, 6.0, 6.0, 13.0] * 50 and scored == [3, 3]
    assert scores(values[:7]).ravel().tolist() == ([13.0, 6.0, 6.0, 13.0] * 2)[:7] and sum(scored) == 6
    monkeypatch.setattr(b, "TABLE_CELLS", 0)
    assert b.scorer(model)(values).ravel().tolist() == [13.0, 6.0, 6.0, 13.0] * 50

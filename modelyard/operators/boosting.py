"""Boosted trees on binned features: regression by squared loss, classes by joint softmax.

Features are cut into bins once, and rows of equal bins become one cell with sums.
Each pass adds up gradients by (tree, node, feature, bin); trees grow best split
first. Gradients are whole multiples of a fixed unit, so sums do not depend on
their order: one task that holds all cells, or any number of tasks, give the same trees.
"""

from __future__ import annotations

import heapq
import json
import math
from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass, field
from functools import cached_property

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from modelyard.session import scratch_path

# Cells up to which one task grows all trees.
ONE_TASK_CELLS = 1 << 17
# Cells of one chunk: what a task works on at once, and what is dealt to tasks.
CHUNK_CELLS = 1 << 14
# Nodes whose sums travel in one row, and bytes of sums that a task holds before it passes them on.
NODES = 32
HELD_BYTES = 1 << 27
# Rounds after which the scores of the cells are written again.
REFRESH = 5
# One row in so many is left out of training and watched by early stopping.
WATCHED = 10
EXACT = 2.0**52
# Cells, seen or not, up to which a task keeps their scores.
TABLE_CELLS = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``loss`` is squared or softmax; ``leaves`` and ``depth`` 0 are no bounds; ``patience`` 0 never stops early."""

    loss: str = "squared"
    rounds: int = 100
    step: float = 0.1
    depth: int = 10
    leaves: int = 31
    min_rows: int = 20
    min_weight: float = 0.0
    l2: float = 0.0
    bins: int = 255
    patience: int = 0
    tolerance: float = 1e-7


@dataclass
class Tree:
    """Nodes by number, the root 0: bins up to ``bin`` go left; leaves have left -1 and a value."""

    feature: list[int] = field(default_factory=lambda: [0])
    bin: list[int] = field(default_factory=lambda: [0])
    left: list[int] = field(default_factory=lambda: [-1])
    right: list[int] = field(default_factory=lambda: [-1])
    value: list[float] = field(default_factory=lambda: [0.0])
    gain: list[float] = field(default_factory=lambda: [0.0])
    depth: list[int] = field(default_factory=lambda: [0])

    def add(self, depth: int, value: float) -> int:
        for column, entry in zip((self.feature, self.bin, self.left, self.right, self.value, self.gain, self.depth), (0, 0, -1, -1, value, 0.0, depth)):
            column.append(entry)
        return len(self.value) - 1

    def leaf_of(self, bins: np.ndarray, at: np.ndarray | None = None) -> np.ndarray:
        """The number of the leaf that each row of bins falls into, coming from the root or from the nodes ``at``, which are moved."""
        feature, cut, left, right = (np.array(c) for c in (self.feature, self.bin, self.left, self.right))
        at, rows = np.zeros(len(bins), dtype=np.int64) if at is None else at, np.arange(len(bins))
        while len(rows := rows[left[at[rows]] >= 0]):
            here = at[rows]
            at[rows] = np.where(bins[rows, feature[here]] <= cut[here], left[here], right[here])
        return at

    def scores(self, bins: np.ndarray) -> np.ndarray:
        return np.array(self.value)[self.leaf_of(bins)]


@dataclass
class Split:
    """The best split of a node, and the sums on both sides: gradient, curvature, rows."""

    gain: float
    feature: int
    bin: int
    sums: tuple[float, float, float]
    left: tuple[float, float, float]


def best_cuts(sums: np.ndarray, feature: int, settings: Settings, found: list[Split | None]) -> list[Split | None]:
    """Best split of each node so far, given ``found`` and the sums (gradient, curvature, rows; by node and bin) of one more feature."""
    upto = np.cumsum(sums, axis=2)
    total, left = upto[:, :, -1:], upto[:, :, :-1]
    right = total - left
    fine = (np.minimum(left[2], right[2]) >= max(settings.min_rows, 1)) & (np.minimum(left[1], right[1]) >= settings.min_weight)

    def score(side):
        return side[0] ** 2 / np.maximum(side[1] + settings.l2, 1e-300)

    gain = np.where(fine, score(left) + score(right) - score(total), -np.inf)
    at = gain.argmax(axis=1)
    out = list(found)
    for i, most in enumerate(gain[np.arange(len(at)), at].tolist()):
        if found[i] is None or most > found[i].gain:
            out[i] = Split(most, feature, int(at[i]), tuple(total[:, i, 0].tolist()), tuple(left[:, i, at[i]].tolist()))
    return out


def leaf_value(sums: tuple[float, float, float], settings: Settings) -> float:
    return -settings.step * sums[0] / (sums[1] + settings.l2) if sums[1] + settings.l2 > 0 else 0.0


@dataclass
class Cells:
    """Rows of equal bins: how many, their targets' sums, and the same of the watched rows with their squares."""

    bins: np.ndarray
    n: np.ndarray
    t: np.ndarray
    watched_n: np.ndarray
    watched_t: np.ndarray
    watched_q: np.ndarray
    score: np.ndarray

    def slopes(self, settings: Settings, unit: float) -> tuple[np.ndarray, np.ndarray]:
        """Gradient and curvature of each cell and tree, as whole multiples of ``unit``."""
        n = self.n[:, None]
        if settings.loss == "squared":
            g, h = n * self.score - self.t, np.broadcast_to(n, self.score.shape)
        else:
            chance = softmax(self.score)
            g, h = n * chance - self.t, n * np.maximum(2 * chance * (1 - chance), 1e-6)
        return np.rint(g / unit), np.rint(h / unit)

    def watched_loss(self, settings: Settings) -> float:
        if settings.loss == "squared":
            s = self.score[:, 0]
            return float((self.watched_q - 2 * s * self.watched_t[:, 0] + self.watched_n * s * s).sum())
        return float(-(self.watched_t * np.log(np.maximum(softmax(self.score), 1e-300))).sum())

    @cached_property
    def columns(self) -> np.ndarray:
        """The bins by feature."""
        return np.ascontiguousarray(self.bins.T)

    def sums(self, slopes, tree: int, at: np.ndarray, nodes: list[int], width: int) -> np.ndarray:
        """Sums by feature, kind (gradient, curvature, rows), place in ``nodes`` and bin, of the cells that are ``at`` these nodes."""
        place = np.full(max([*nodes, int(at.max(initial=0))]) + 1, -1)
        place[nodes] = np.arange(len(nodes))
        at = place[at]
        rows = np.flatnonzero(at >= 0)
        start, parts = at[rows] * width, [part[rows] for part in (slopes[0][:, tree], slopes[1][:, tree], self.n)]
        out = np.empty((len(self.columns), 3, len(nodes), width))
        for feature, column in enumerate(self.columns):
            key = start + column[rows]
            for kind, part in enumerate(parts):
                out[feature, kind] = np.bincount(key, part, minlength=len(nodes) * width).reshape(len(nodes), width)
        return out


def softmax(scores: np.ndarray) -> np.ndarray:
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def in_units(sums: np.ndarray, unit: float) -> np.ndarray:
    return sums * np.array([unit, unit, 1.0])[:, None, None]


class OneTask:
    """All sums from cells in memory.

    Of two siblings only the one with fewer cells is added up: sums are whole numbers
    of units, so what is left of their parent's is exactly the other's.
    """

    def __init__(self, cells: Cells, settings: Settings, unit: float, width: int) -> None:
        self.cells, self.settings, self.unit, self.width = cells, settings, unit, width
        self._begin()

    def _begin(self) -> None:
        self.slopes = self.cells.slopes(self.settings, self.unit)
        self.at: dict[int, np.ndarray] = {}
        self.kept: dict[tuple[int, int], np.ndarray] = {}

    def _sums(self, k: int, tree: Tree, nodes: list[int]) -> np.ndarray:
        at = self.at[k] = tree.leaf_of(self.cells.bins, self.at.get(k))
        parents = {child: p for p, pair in enumerate(zip(tree.left, tree.right)) for child in pair if child > 0}
        sizes, known, rest = np.bincount(at, minlength=len(tree.value)), set(nodes), {}
        for node in nodes:
            parent = parents.get(node)
            if parent is not None and node == tree.left[parent] and tree.right[parent] in known and (k, parent) in self.kept:
                few, many = sorted((node, tree.right[parent]), key=lambda n: sizes[n])
                rest[many] = (parent, few)
        added = [node for node in nodes if node not in rest]
        place = {node: i for i, node in enumerate(nodes)}
        out = np.empty((len(self.cells.columns), 3, len(nodes), self.width))
        out[:, :, [place[node] for node in added]] = self.cells.sums(self.slopes, k, at, added, self.width)
        for many, (parent, few) in rest.items():
            np.subtract(self.kept[k, parent], out[:, :, place[few]], out=out[:, :, place[many]])
        for node in nodes:
            self.kept.pop((k, parents.get(node)), None)
        room = HELD_BYTES // max(out[:, :, 0].nbytes, 1) - len(self.kept)
        for node in nodes[: max(room, 0)]:
            if not self.settings.depth or tree.depth[node] + 1 < self.settings.depth:
                self.kept[k, node] = out[:, :, place[node]].copy()
        return out

    def splits(self, trees: list[Tree], asked: dict[int, list[int]]) -> dict[tuple[int, int], Split]:
        out = {}
        for k, nodes in asked.items():
            best: list[Split | None] = [None] * len(nodes)
            for feature, sums in enumerate(self._sums(k, trees[k], nodes)):
                best = best_cuts(in_units(sums, self.unit), feature, self.settings, best)
            out |= {(k, node): split for node, split in zip(nodes, best) if split}
        return out

    def add(self, trees: list[Tree]) -> None:
        for k, tree in enumerate(trees):
            self.cells.score[:, k] += tree.scores(self.cells.bins)
        self._begin()

    def watched_loss(self) -> float:
        return self.cells.watched_loss(self.settings)


def unpacked(row, features: int, classes: int) -> Cells:
    """The cells of a chunk row."""
    def numbers(data, width=None):
        values = np.frombuffer(data, dtype=float)
        return values.copy() if width is None else values.reshape(-1, width).copy()

    bins = np.frombuffer(row["bins"], dtype=np.uint8).reshape(-1, features)
    return Cells(
        bins, numbers(row["n"]), numbers(row["t"], classes), numbers(row["watched_n"]), numbers(row["watched_t"], classes),
        numbers(row["watched_q"]), numbers(row["score"], classes),
    )


CHUNK = "bins binary, n binary, t binary, watched_n binary, watched_t binary, watched_q binary, score binary"
CHUNK_NAMES = [c.split()[0] for c in CHUNK.split(", ")]


def packed(cells: Cells) -> list[bytes]:
    return [np.ascontiguousarray(getattr(cells, c)).tobytes() for c in CHUNK_NAMES]


def spread(chunks: DataFrame) -> DataFrame:
    """The chunks kept for passes over all cores, however few files they lie in."""
    return chunks.repartition(chunks.sparkSession.sparkContext.defaultParallelism).persist()


class ManyTasks:
    """Sums over a table of chunks: tasks add up their cells, one group of each feature the tasks' sums, and each node's features are compared."""

    def __init__(self, chunks: DataFrame, settings: Settings, unit: float, width: int, features: int, classes: int) -> None:
        self.chunks, self.settings, self.unit, self.width = chunks, settings, unit, width
        self.features, self.classes = features, classes
        self.since: list[list[Tree]] = []

    def _cells(self, batches: Iterator[pd.DataFrame], since: list[list[Tree]]) -> Iterator[Cells]:
        for batch in batches:
            for row in batch.to_dict("records"):
                cells = unpacked(row, self.features, self.classes)
                for trees in since:
                    for k, tree in enumerate(trees):
                        cells.score[:, k] += tree.scores(cells.bins)
                yield cells

    def _parts(self) -> ManyTasks:
        """What tasks need: everything but the table."""
        return ManyTasks(None, self.settings, self.unit, self.width, self.features, self.classes)

    def splits(self, trees: list[Tree], asked: dict[int, list[int]]) -> dict[tuple[int, int], Split]:
        own, since, settings, unit, width = self._parts(), self.since, self.settings, self.unit, self.width

        blocks = [(k, nodes[i : i + NODES]) for k, nodes in asked.items() for i in range(0, len(nodes), NODES)]

        def sums(batches):
            held: dict[int, np.ndarray] = {}

            def rows():
                for block, found in held.items():
                    yield pd.DataFrame({"block": block, "feature": np.arange(len(found)), "sums": [f.tobytes() for f in found]})
                held.clear()

            for cells in own._cells(batches, since):
                slopes, at = cells.slopes(settings, unit), {k: trees[k].leaf_of(cells.bins) for k in asked}
                for block, (k, nodes) in enumerate(blocks):
                    found = cells.sums(slopes, k, at[k], nodes, width)
                    held[block] = held[block] + found if block in held else found
                    if sum(h.nbytes for h in held.values()) > HELD_BYTES:
                        yield from rows()
            yield from rows()

        def best(frame: pd.DataFrame) -> pd.DataFrame:
            block, feature = int(frame["block"].iloc[0]), int(frame["feature"].iloc[0])
            summed = sum(np.frombuffer(part) for part in frame["sums"]).reshape(3, len(blocks[block][1]), width)
            found = best_cuts(in_units(summed, unit), feature, settings, [None] * summed.shape[1])
            return pd.DataFrame([(block, feature, json.dumps([asdict(split) for split in found]))], columns=["block", "feature", "splits"])

        parts = self.chunks.mapInPandas(sums, "block int, feature int, sums binary")
        rows = parts.groupBy("block", "feature").applyInPandas(best, "block int, feature int, splits string").collect()
        found: dict[tuple[int, int], Split] = {}
        for row in sorted(rows, key=lambda r: (r.block, r.feature)):
            k, nodes = blocks[row.block]
            for node, values in zip(nodes, json.loads(row.splits)):
                if (k, node) not in found or values["gain"] > found[k, node].gain:
                    found[k, node] = Split(values["gain"], values["feature"], values["bin"], tuple(values["sums"]), tuple(values["left"]))
        return found

    def add(self, trees: list[Tree]) -> None:
        self.since = [*self.since, trees]
        if len(self.since) >= REFRESH:
            own, since = self._parts(), self.since
            path = scratch_path(self.chunks.sparkSession, "boosted-cells")
            fresh = self.chunks.mapInPandas(lambda batches: (pd.DataFrame([packed(c)], columns=CHUNK_NAMES) for c in own._cells(batches, since)), CHUNK)
            fresh.write.parquet(path)
            self.chunks.unpersist()
            self.chunks, self.since = spread(self.chunks.sparkSession.read.parquet(path)), []

    def watched_loss(self) -> float:
        own, since, settings = self._parts(), self.since, self.settings
        losses = self.chunks.mapInPandas(
            lambda batches: (pd.DataFrame({"loss": [c.watched_loss(settings)]}) for c in own._cells(batches, since)), "loss double"
        )
        return losses.agg(F.sum("loss")).first()[0] or 0.0


def grown(sums, settings: Settings, classes: int) -> list[Tree]:
    """One tree for each class, best split first, at most ``leaves`` leaves.

    Whether a node is among the best splits is known before its children are: what
    is asked later can only take places away. So each pass asks for the children
    of all splits that are chosen by what is known, and ends when none is new.
    """
    trees = [Tree() for _ in range(classes)]
    known: dict[tuple[int, int], Split | None] = {}
    asked = {k: [0] for k in range(classes)}
    chosen: list[set[int]] = [set() for _ in range(classes)]
    while asked:
        found = sums.splits(trees, asked)
        for k, nodes in asked.items():
            for node in nodes:
                split = known[k, node] = found.get((k, node))
                if node == 0 and split:
                    trees[k].value[0] = leaf_value(split.sums, settings)
        asked = {}
        for k, tree in enumerate(trees):
            chosen[k] = best_first(tree, k, known, settings)
            for node in sorted(chosen[k]):
                if tree.left[node] < 0:
                    split = known[k, node]
                    right = tuple(a - b for a, b in zip(split.sums, split.left))
                    tree.feature[node], tree.bin[node], tree.gain[node] = split.feature, split.bin, split.gain
                    tree.left[node] = tree.add(tree.depth[node] + 1, leaf_value(split.left, settings))
                    tree.right[node] = tree.add(tree.depth[node] + 1, leaf_value(right, settings))
                    for child, side in ((tree.left[node], split.left), (tree.right[node], right)):
                        if (not settings.depth or tree.depth[child] < settings.depth) and side[2] >= 2 * max(settings.min_rows, 1):
                            asked.setdefault(k, []).append(child)
                        else:
                            known[k, child] = None
    return [pruned(tree, keep) for tree, keep in zip(trees, chosen)]


def best_first(tree: Tree, k: int, known: dict, settings: Settings) -> set[int]:
    """The nodes that are split, taking the split of most gain each time."""
    chosen, todo = set(), []

    def offer(node: int) -> None:
        split = known.get((k, node))
        if split is not None and split.gain > 1e-12:
            heapq.heappush(todo, (-split.gain, node))

    offer(0)
    while todo and (not settings.leaves or len(chosen) + 1 < settings.leaves):
        node = heapq.heappop(todo)[1]
        chosen.add(node)
        if tree.left[node] >= 0:
            offer(tree.left[node])
            offer(tree.right[node])
    return chosen


def pruned(tree: Tree, keep: set[int]) -> Tree:
    """The tree with the splits in ``keep`` only."""
    out, todo = Tree(), [(0, 0)]
    out.value[0] = tree.value[0]
    while todo:
        old, new = todo.pop()
        if old in keep:
            out.feature[new], out.bin[new], out.gain[new] = tree.feature[old], tree.bin[old], tree.gain[old]
            out.left[new] = out.add(out.depth[new] + 1, tree.value[tree.left[old]])
            out.right[new] = out.add(out.depth[new] + 1, tree.value[tree.right[old]])
            todo += [(tree.left[old], out.left[new]), (tree.right[old], out.right[new])]
    return out


def boosted(sums, settings: Settings, classes: int) -> list[list[Tree]]:
    """Rounds of one tree for each class, until ``rounds`` or no better watched loss for ``patience`` rounds."""
    rounds: list[list[Tree]] = []
    losses = [sums.watched_loss()] if settings.patience else []
    while len(rounds) < settings.rounds:
        trees = grown(sums, settings, classes)
        rounds.append(trees)
        sums.add(trees)
        if settings.patience:
            losses.append(sums.watched_loss())
            recent, before = losses[-settings.patience :], losses[: -settings.patience]
            if before and min(recent) >= min(before) - settings.tolerance:
                break
    return rounds


def binned(values: np.ndarray, cuts: list[list[float]]) -> np.ndarray:
    """Bin of each value: how many cuts lie below it; missing values have a bin of their own above all others."""
    out = np.empty(values.shape, dtype=np.uint8)
    for feature, at in enumerate(cuts):
        column = values[:, feature]
        out[:, feature] = np.where(np.isnan(column), len(at) + 1, np.searchsorted(at, column))
    return out


def chunked(rows: DataFrame, cuts: list[list[float]], classes: int, softmax_: bool, start: list[float]) -> DataFrame:
    """Chunks of cells of rows with x (array), y and watched.

    Rows become cells in the tasks and merge before the shuffle.
    """

    def bins(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                found = binned(np.stack(batch["x"]).astype(float), cuts)
                yield pd.DataFrame({"bins": [r.tobytes() for r in found], "y": batch["y"], "watched": batch["watched"]})

    parts = rows.mapInPandas(bins, "bins binary, y double, watched boolean")
    y = F.col("y")
    targets = [(y == k).cast("double") for k in range(classes)] if softmax_ else [y]

    def total(value, flag):
        return F.coalesce(F.sum(F.when(F.col("watched") == flag, value)), F.lit(0.0))

    one = F.lit(1.0)
    cells = parts.groupBy("bins").agg(
        total(one, False).alias("n"), F.array(*[total(t, False) for t in targets]).alias("t"),
        total(one, True).alias("watched_n"), F.array(*[total(t, True) for t in targets]).alias("watched_t"), total(y * y, True).alias("watched_q"),
    )

    def pack(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: list[pd.DataFrame] = []

        def chunk() -> pd.DataFrame:
            frame = pd.concat(held).sort_values("bins")
            bins = np.frombuffer(b"".join(frame["bins"]), dtype=np.uint8).reshape(-1, max(len(cuts), 1))
            columns = [frame["n"].to_numpy(), np.stack(frame["t"]), frame["watched_n"].to_numpy(), np.stack(frame["watched_t"]), frame["watched_q"].to_numpy()]
            cells = Cells(bins, *(np.array(c, dtype=float) for c in columns), np.tile(np.array(start, dtype=float), (len(frame), 1)))
            return pd.DataFrame([packed(cells)], columns=CHUNK_NAMES)

        for batch in batches:
            for at in range(0, len(batch), CHUNK_CELLS):
                held.append(batch.iloc[at : at + CHUNK_CELLS])
                if sum(map(len, held)) >= CHUNK_CELLS:
                    yield chunk()
                    held = []
        if sum(map(len, held)):
            yield chunk()

    return cells.mapInPandas(pack, CHUNK)


def merged(chunks: list[Cells]) -> Cells:
    parts = [np.concatenate([getattr(c, name) for c in chunks]) for name in CHUNK_NAMES]
    order = np.lexsort(parts[0].T[::-1])
    return Cells(*(p[order] for p in parts))


def fit_rounds(chunks: DataFrame, settings: Settings, unit: float, width: int, features: int, classes: int, one_task_cells: int = ONE_TASK_CELLS) -> list[list[Tree]]:
    """The rounds of trees. Up to ``one_task_cells`` cells are boosted by one task, more by passes over all tasks; the trees are the same."""
    n_cells = chunks.agg(F.sum(F.length("n")) / 8).first()[0] or 0
    if n_cells > one_task_cells:
        sums = ManyTasks(spread(chunks), settings, unit, width, features, classes)
        rounds = boosted(sums, settings, classes)
        sums.chunks.unpersist()
        return rounds

    def work(frame: pd.DataFrame) -> pd.DataFrame:
        cells = merged([unpacked(r, features, classes) for r in frame.to_dict("records")])
        rounds = boosted(OneTask(cells, settings, unit, width), settings, classes)
        return pd.DataFrame({"rounds": [json.dumps([[asdict(t) for t in trees] for trees in rounds])]})

    row = chunks.groupBy().applyInPandas(work, "rounds string").first()
    return [[Tree(**t) for t in trees] for trees in json.loads(row["rounds"])] if row else []


class _BoosterParams(HasFeaturesCol, HasLabelCol, HasPredictionCol, HasProbabilityCol, HasSeed):
    settings = Param(Params._dummy(), "settings", "settings of the booster, as JSON", typeConverter=TypeConverters.toString)

    def read_settings(self) -> Settings:
        return Settings(**json.loads(self.getOrDefault("settings")))

    def getMaxIter(self) -> int:
        return self.read_settings().rounds

    def getMaxDepth(self) -> int:
        return self.read_settings().depth

    def getStepSize(self) -> float:
        return self.read_settings().step


class HistBooster(Estimator, _BoosterParams, DefaultParamsReadable, DefaultParamsWritable):
    """Fits a ``HistBoosterModel``; ``settings`` are those of ``Settings``.

    Classes are 0, 1, 2 and so on. Rows with a null label or null features are
    left out; a missing value (NaN) is above all others. A table without rows, or
    one without features, gives a constant. With ``patience``, a table of more
    than 10,000 rows leaves out and watches a tenth of them (by digest) and stops early.
    """

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=42, settings="{}") -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=42, settings="{}")
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> HistBoosterModel:
        settings = self.read_settings()
        soft = settings.loss == "softmax"
        rows = dataset.select(vector_to_array(F.col(self.getFeaturesCol())).alias("x"), F.col(self.getLabelCol()).cast("double").alias("y"))
        rows = rows.filter("x IS NOT NULL AND y IS NOT NULL AND NOT isnan(y)")
        n, size, classes, low, high, mean = rows.agg(
            F.count(F.lit(1)), F.max(F.size("x")), F.max("y") + 1, F.min("y"), F.max("y"), F.avg("y")
        ).first()
        classes = int(classes or 1) if soft else 1
        start = [0.0] * classes if soft else [mean or 0.0]
        rounds: list[list[Tree]] = []
        cuts: list[list[float]] = [[] for _ in range(size or 0)]
        if n and size:
            patience = settings.patience if n > 10_000 else 0
            settings = Settings(**{**asdict(settings), "patience": patience})
            watched = F.pmod(F.xxhash64(F.lit(self.getSeed()), "x", "y"), F.lit(WATCHED)) == 0 if patience else F.lit(False)
            rows = rows.withColumn("watched", watched)
            cuts = feature_cuts(rows, size, settings.bins)
            # Sums of all gradients stay below 2^52 units, whole numbers that doubles hold exactly.
            largest = 1.0 if soft else 2.0 * max(high - low, abs(mean), 1e-9)
            unit = 2.0 ** np.ceil(np.log2(n * max(largest, 1.0) / EXACT))
            path = scratch_path(dataset.sparkSession, "cells")
            chunked(rows, cuts, classes, soft, start).write.parquet(path)
            width = max(map(len, cuts)) + 2
            rounds = fit_rounds(dataset.sparkSession.read.parquet(path), settings, unit, width, size, classes)
        model = HistBoosterModel(json.dumps({"loss": settings.loss, "start": start, "cuts": cuts, "rounds": [[asdict(t) for t in trees] for trees in rounds]}))
        return self._copyValues(model)


def feature_cuts(rows: DataFrame, size: int, bins: int) -> list[list[float]]:
    """Cuts halfway between neighbouring values among the quantiles of each feature, at most ``bins`` - 1 of them."""
    columns = [f"x{i}" for i in range(size)]
    wide = rows.select(*[F.get("x", F.lit(i)).alias(c) for i, c in enumerate(columns)])
    shares = [i / bins for i in range(bins + 1)]
    found = wide.stat.approxQuantile(columns, shares, 1 / (8 * bins))
    out = []
    for values in found:
        values = sorted({v for v in values if v == v})
        out.append([a + (b - a) / 2 for a, b in zip(values, values[1:])][: bins - 1])
    return out


def scorer(model: dict) -> Callable[[np.ndarray], np.ndarray]:
    """Scores by class of rows of values. Where features have few bins, each cell is scored once, however many rows it has."""
    rounds = [[Tree(**t) for t in trees] for trees in model["rounds"]]
    start, sizes = np.array(model["start"], dtype=float), [len(at) + 2 for at in model["cuts"]]

    def scored(bins: np.ndarray) -> np.ndarray:
        sums = np.tile(start, (len(bins), 1))
        for trees in rounds:
            for k, tree in enumerate(trees):
                sums[:, k] += tree.scores(bins)
        return softmax(sums) if model["loss"] == "softmax" else sums

    if math.prod(sizes) > TABLE_CELLS:
        return lambda values: scored(binned(values, model["cuts"]))
    known, table = np.zeros(math.prod(sizes), dtype=bool), np.empty((math.prod(sizes), len(start)))

    def looked_up(values: np.ndarray) -> np.ndarray:
        bins = binned(values, model["cuts"])
        cell = np.ravel_multi_index(tuple(bins.T), sizes) if sizes else np.zeros(len(bins), dtype=int)
        new, first = np.unique(cell[~known[cell]], return_index=True)
        table[new], known[new] = scored(bins[~known[cell]][first]), True
        return table[cell]

    return looked_up


class HistBoosterModel(Model, _BoosterParams, MLWritable, MLReadable):
    """Prediction, and for classes probability, of the features."""

    def __init__(self, body: str = "{}") -> None:
        super().__init__()
        self._setDefault(featuresCol="features", labelCol="label", predictionCol="prediction", probabilityCol="probability", seed=42, settings="{}")
        self.body = body

    @property
    def cuts(self) -> list[list[float]]:
        return json.loads(self.body)["cuts"]

    @property
    def rounds(self) -> list[list[Tree]]:
        return [[Tree(**t) for t in trees] for trees in json.loads(self.body)["rounds"]]

    @property
    def featureImportances(self):
        """Share of each feature in the gain of all splits."""
        sums = np.zeros(len(self.cuts))
        for trees in self.rounds:
            for tree in trees:
                np.add.at(sums, [f for f, left in zip(tree.feature, tree.left) if left >= 0], [g for g, left in zip(tree.gain, tree.left) if left >= 0])
        return Vectors.dense(sums / sums.sum() if sums.sum() > 0 else sums)

    def split_features(self) -> list[int]:
        """The feature of every split of every tree."""
        return [f for trees in self.rounds for tree in trees for f, left in zip(tree.feature, tree.left) if left >= 0]

    def _transform(self, dataset: DataFrame) -> DataFrame:
        body = self.body

        @F.pandas_udf("array<double>")
        def score(columns: Iterator[pd.Series]) -> Iterator[pd.Series]:
            scores_of = scorer(json.loads(body))
            for column in columns:
                there = column.notna().to_numpy()
                out: list[list[float] | None] = [None] * len(column)
                if there.any():
                    for at, line in zip(np.flatnonzero(there), scores_of(np.stack(column[there]).astype(float)).tolist()):
                        out[at] = line
                yield pd.Series(out, dtype=object)

        scores = score(vector_to_array(F.col(self.getFeaturesCol())))
        if json.loads(body).get("loss") != "softmax":
            return dataset.withColumn(self.getPredictionCol(), F.get(scores, F.lit(0)))
        marked = dataset.withColumn(self.getProbabilityCol(), scores)
        best = F.array_position(F.col(self.getProbabilityCol()), F.array_max(self.getProbabilityCol())) - 1
        return marked.withColumn(self.getPredictionCol(), best.cast("double")).withColumn(
            self.getProbabilityCol(), array_to_vector(F.col(self.getProbabilityCol()))
        )

    def copy(self, extra=None):
        again = super().copy(extra)
        again.body = self.body
        return again

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader(cls)


class _Writer(MLWriter):
    def __init__(self, model: HistBoosterModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.sparkSession.createDataFrame([(self.model.body,)], "body string").write.parquet(f"{path}/body")


class _Reader(MLReader):
    def __init__(self, kind) -> None:
        super().__init__()
        self.kind = kind

    def load(self, path: str) -> HistBoosterModel:
        metadata = DefaultParamsReader.loadMetadata(path, self.sparkSession)
        model = self.kind(self.sparkSession.read.parquet(f"{path}/body").first()["body"])
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model


# Names that MLlib's estimators have for the same settings.
MLLIB_NAMES = {"maxIter": "rounds", "maxDepth": "depth", "stepSize": "step", "maxBins": "bins", "minInstancesPerNode": "min_rows"}


def booster(label: str, features: str = "features", seed: int = 42, **settings) -> HistBooster:
    """A booster by ``Settings``, which may go by MLlib's names."""
    named = {MLLIB_NAMES.get(k, k): v for k, v in settings.items()}
    return HistBooster(labelCol=label, featuresCol=features, seed=seed, settings=json.dumps(asdict(Settings(**named))))


# What the two common libraries of this kind do unless told otherwise.
def hist_regressor(label: str, **settings) -> HistBooster:
    own = {"loss": "squared", "rounds": 100, "step": 0.1, "depth": 0, "leaves": 31, "min_rows": 20, "patience": 10}
    return booster(label, **{**own, **{MLLIB_NAMES.get(k, k): v for k, v in settings.items()}})


def joint_classifier(label: str, **settings) -> HistBooster:
    own = {"loss": "softmax", "rounds": 100, "step": 0.3, "depth": 6, "leaves": 0, "min_rows": 1, "min_weight": 1.0, "l2": 1.0}
    return booster(label, **{**own, **{MLLIB_NAMES.get(k, k): v for k, v in settings.items()}})

"""Toxicity scores by a factorization machine over hashed terms.

A text is the set of its terms: words, and the first letters of longer words,
each as a 64-bit hash. The machine has a weight and a short vector per kept
term; the dot product of two vectors is the weight of the two terms together.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, per_text, table, texts
from .mixing import stored

# Bound of the labelled rows that the machine learns from (those with the lowest digests).
FIT_ROWS = 20_000
# Terms kept: in enough texts, the most frequent first, whatever they tell on their own.
MIN_TEXTS, MAX_TERMS = 4, 1 << 18
# Terms whose log odds are off by so many standard errors tell something on their own.
MIN_Z = 3.0
PREFIXES = (4, 5)
FACTORS, TURNS, HISTORY = 8, 40, 4
# Decay of the weights of terms that tell something on their own, of other weights, and of vectors.
CLEAR_DECAY, DECAY, PAIR_DECAY = 1e-6, 3e-2, 1e-2
CUT = 0.7
SEED = 11
REMEMBERED = 300_000

letters = re.compile(r"[^\W\d_]+").findall


def word_terms(word: str) -> tuple[int, ...]:
    """Signed 64-bit hashes of a word and of its beginnings."""
    names = [f"w:{word}", *(f"p:{word[:n]}" for n in PREFIXES if len(word) > n)]
    return tuple(xxhash.xxh64_intdigest(name.encode("utf-8", "surrogatepass")) - (1 << 63) for name in names)


class Memory(dict):
    """A function's results, forgotten all at once when there are too many."""

    def __init__(self, work: Callable) -> None:
        super().__init__()
        self.work = work

    def __missing__(self, key):
        if len(self) >= REMEMBERED:
            self.clear()
        value = self[key] = self.work(key)
        return value


def text_terms(text: str, memory: Memory) -> set:
    return {term for word in set(letters(text.lower())) for term in memory[word]}


@dataclass(frozen=True)
class Machine:
    """Terms in order, their weights and vectors (at most MAX_TERMS), and the constant."""

    terms: np.ndarray
    weights: np.ndarray
    vectors: np.ndarray
    constant: float

    def scorer(self) -> Callable[[str], float]:
        place = {int(t): i for i, t in enumerate(self.terms)}
        memory = Memory(lambda word: tuple(place[t] for t in word_terms(word) if t in place))

        def score(text: str) -> float:
            return self.score(sorted(text_terms(text, memory)))

        return score

    def score(self, at: list[int]) -> float:
        """Probability of a text that holds the terms at these places."""
        vectors = self.vectors[at]
        pairs = 0.5 * float((vectors.sum(axis=0) ** 2 - (vectors**2).sum(axis=0)).sum())
        margin = self.constant + float(self.weights[at].sum()) + pairs
        return float(1 / (1 + np.exp(-np.clip(margin, -40, 40))))


class Places:
    """Rows of places in the terms, for sums over the terms of a row and over the rows of a term."""

    def __init__(self, rows: list[np.ndarray], width: int) -> None:
        self.n, self.width = len(rows), width
        lengths = np.array([len(at) for at in rows], dtype=np.int64)
        self.at = np.concatenate([np.empty(0, dtype=np.int32), *rows]).astype(np.int32)
        self.full = np.flatnonzero(lengths)
        self.starts = (np.cumsum(lengths) - lengths)[self.full]
        self.of = np.repeat(np.arange(self.n, dtype=np.int32), lengths)[np.argsort(self.at, kind="stable")]
        counts = np.bincount(self.at, minlength=width)
        self.used = np.flatnonzero(counts)
        self.firsts = (np.cumsum(counts) - counts)[self.used]

    def by_row(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.n)
        if len(self.full):
            out[self.full] = np.add.reduceat(values.astype(np.float32)[self.at], self.starts)
        return out

    def by_term(self, values: np.ndarray) -> np.ndarray:
        out = np.zeros(self.width)
        if len(self.used):
            out[self.used] = np.add.reduceat(values.astype(np.float32)[self.of], self.firsts)
        return out


def least(loss: Callable[[np.ndarray], tuple[float, np.ndarray]], point: np.ndarray) -> np.ndarray:
    """A low point of ``loss`` (value and gradient) by at most TURNS steps of the limited-memory BFGS method."""
    value, grad = loss(point)
    known: list[tuple[np.ndarray, np.ndarray]] = []
    for _ in range(TURNS):
        way, shares = -grad, []
        for step, change in reversed(known):
            shares.append((step @ way) / (step @ change))
            way = way - shares[-1] * change
        if known:
            way *= (known[-1][0] @ known[-1][1]) / (known[-1][1] @ known[-1][1])
        for (step, change), share in zip(known, reversed(shares)):
            way = way + step * (share - (change @ way) / (step @ change))
        slope = grad @ way
        if slope >= 0:
            break
        size, low, high = 1.0 if known else 5 * min(1.0, 1 / np.abs(grad).sum()), 0.0, np.inf
        for _ in range(12):
            now, turned = loss(point + size * way)
            if now > value + 1e-4 * size * slope:
                high = size
                size = (low + high) / 2 if low else size / 4
            elif turned @ way < 0.9 * slope:
                low = size
                size = size * 4 if high == np.inf else (low + high) / 2
            else:
                break
        if now >= value:
            break
        step, change = size * way, turned - grad
        if step @ change > 1e-12:
            known = [*known, (step, change)][-HISTORY:]
        point, value, grad = point + step, now, turned
    return point


def fit_machine(terms: np.ndarray, rows: list[np.ndarray], labels: np.ndarray, clear: np.ndarray | None = None) -> Machine:
    """Logistic loss over all rows, which are places in ``terms``, with decay.

    ``clear`` says which terms tell something on their own (None: all). The others'
    weights are held near zero, but their vectors learn as freely as any.
    """
    n, width = len(rows), len(terms)
    share = np.clip(labels.mean() if n else 0.5, 1e-3, 1 - 1e-3)
    constant = np.log(share / (1 - share))
    if not n or not width:
        return Machine(terms, np.zeros(width), np.zeros((width, FACTORS)), float(constant))
    places = Places(rows, width)
    start = np.random.default_rng(SEED).normal(0, 0.01, FACTORS * width)
    weight_decay = np.where(np.ones(width, dtype=bool) if clear is None else clear, CLEAR_DECAY, DECAY)
    decay = np.concatenate([[0.0], weight_decay, np.full(FACTORS * width, PAIR_DECAY)])
    # Steps are taken in units of the loss's own curvature, or else rare terms would move last.
    bend = share * (1 - share)
    often = bend * np.bincount(places.at, minlength=width) / n
    unit = 1 / np.sqrt(np.concatenate([[bend], often, np.zeros(FACTORS * width)]) + decay)

    def loss(at: np.ndarray) -> tuple[float, np.ndarray]:
        point = at * unit
        weights, vectors = point[1 : 1 + width], point[1 + width :].reshape(FACTORS, width)
        sums = [places.by_row(v) for v in vectors]
        margin = point[0] + places.by_row(weights - 0.5 * (vectors**2).sum(axis=0)) + 0.5 * sum(s**2 for s in sums)
        slope = (1 / (1 + np.exp(-np.clip(margin, -40, 40))) - labels) / n
        pull = places.by_term(slope)
        grads = [places.by_term(slope * s) - pull * v for s, v in zip(sums, vectors)]
        value = (np.logaddexp(0, margin) - labels * margin).mean() + 0.5 * float(decay @ point**2)
        return float(value), (np.concatenate([[slope.sum()], pull, *grads]) + decay * point) * unit

    found = least(loss, np.concatenate([[constant], np.zeros(width), start]) / unit) * unit
    vectors = np.ascontiguousarray(found[1 + width :].reshape(FACTORS, width).T)
    return Machine(terms, found[1 : 1 + width], vectors, float(found[0]))


def trained(docs: DataFrame, labels: DataFrame, label: str = "toxic") -> Machine:
    """A machine from at most FIT_ROWS labelled rows; rows with a null label or id don't count.

    ``labels`` has doc_id and ``label``, 0 or 1 (repeated ids: 1 if any says 1).
    Of rows that share an id one text counts, that of the lowest digest, so the bound
    holds whatever the ids. Counting terms and reading texts is work of all tasks;
    one task then trains on the kept terms of the rows, both bounded by the parameters
    above, and the driver gets the finished machine. No term is left out for what it
    tells on its own, as pairs may tell what terms do not.
    """
    marked = labels.filter(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max(label).cast("int").alias("label"))
    digest = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.col("doc_id").cast("string")))
    chosen = marked.orderBy(digest, "doc_id").limit(FIT_ROWS)
    sample = texts(docs).join(F.broadcast(chosen), "doc_id")
    sample = stored(sample.groupBy("doc_id", "label").agg(F.min_by("text", F.md5(F.col("text").cast("binary"))).alias("text")), "labelled-texts")

    def term_counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = Memory(word_terms)
        for batch in batches:
            if not len(batch):
                continue
            found = [np.fromiter(text_terms(text, memory), dtype=np.int64) for text in batch["text"]]
            flags = np.repeat(batch["label"].to_numpy(), [len(x) for x in found])
            values, place = np.unique(np.concatenate(found), return_inverse=True)
            yes = np.bincount(place, flags, minlength=len(values)).astype(np.int64)
            yield pd.DataFrame({"term": values, "yes": yes, "total": np.bincount(place, minlength=len(values))})

    counts = sample.mapInPandas(term_counts, "term long, yes long, total long").groupBy("term")
    counts = counts.agg(F.sum("yes").alias("yes"), F.sum("total").alias("total")).filter(F.col("total") >= MIN_TEXTS)
    size = sample.agg(F.count(F.lit(1)), F.coalesce(F.sum("label"), F.lit(0))).first()
    cells = [F.col("yes") + 0.5, F.lit(size[1]) - F.col("yes") + 0.5]
    cells += [F.col("total") - F.col("yes") + 0.5, F.lit(size[0] - size[1]) - F.col("total") + F.col("yes") + 0.5]
    z = (F.log(cells[0]) - F.log(cells[1]) - F.log(cells[2]) + F.log(cells[3])) / F.sqrt(sum((1 / c for c in cells[1:]), 1 / cells[0]))
    kept = counts.withColumn("clear", F.round(F.abs(z), 9) >= MIN_Z).orderBy(F.desc("total"), "term").limit(MAX_TERMS)
    kept = kept.select("term", "clear").toArrow()
    terms, clear = (kept[c].to_numpy() for c in ("term", "clear"))
    clear, terms = clear[np.argsort(terms)], np.sort(terms)

    def kept_terms(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        place = {int(t): i for i, t in enumerate(terms)}
        memory = Memory(lambda word: tuple(place[t] for t in word_terms(word) if t in place))
        for batch in batches:
            found = [np.array(sorted(text_terms(text, memory)), dtype=np.int32).tobytes() for text in batch["text"]]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "label": batch["label"], "found": found})

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["doc_id", "found"])
        rows = [np.frombuffer(x, dtype=np.int32) for x in frame["found"]]
        machine = fit_machine(terms, rows, frame["label"].to_numpy(dtype=float), clear)
        columns = (machine.weights, machine.vectors)
        return pd.DataFrame([[machine.constant, *(c.astype(np.float32).tobytes() for c in columns)]], columns=["constant", "weights", "vectors"])

    id_type = dict(sample.dtypes)["doc_id"]
    rows = sample.mapInPandas(kept_terms, f"doc_id {id_type}, label int, found binary")
    found = rows.groupBy().applyInPandas(fit, "constant double, weights binary, vectors binary").first()
    if found is None:
        return fit_machine(terms, [], np.zeros(0))
    weights, vectors = (np.frombuffer(x, dtype=np.float32).astype(float) for x in (found.weights, found.vectors))
    return Machine(terms, weights, vectors.reshape(-1, FACTORS), found.constant)


def scored(docs: DataFrame, machine: Machine) -> DataFrame:
    """doc_id, score (0 to 1) and predicted (1 from CUT on) of every whole text.

    A null or empty text holds no terms and gets the machine's constant; repeated
    rows and null doc_ids come out as they are; an empty table gives no rows;
    other columns are not read. No shuffle.
    """
    memory = Memory(lambda _: machine.scorer())  # built in the task

    def measure(text: str) -> tuple[float, int]:
        score = memory["scorer"](text)
        return score, int(score >= CUT)

    return per_text(docs, measure, "score double, predicted int")


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    """Toxicity of all documents; rows whose id leaves remainder 1 modulo 3 teach nothing."""
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    machine = trained(docs, labels.filter(id_remainder(3) != 1))
    found = scored(docs, machine)
    return found.select("doc_id", (id_remainder(3) == 1).alias("held_out"), "score", "predicted")

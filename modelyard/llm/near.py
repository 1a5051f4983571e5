"""Near-duplicates by ProbMinHash over word shingles, banding and exact verification.

A document is a weighted set: its runs of five words with their counts. Each
element sends exponential arrivals at the rate of its weight; each arrival goes
to one register, and a register keeps its first arrival. Two documents agree in
a register with the probability Jaccard similarity of their sets.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import WORD, table, texts
from .mixing import stored

SHINGLE = 5
THRESHOLD = 0.8
# A pair at 0.8 shares no band of 6 registers once in 9,000 times, a pair at 0.3 shares one in 50.
BANDS, ROWS = 30, 6
REGISTERS = BANDS * ROWS
# Two bits of each register, as longs; pairs at 0.8 agree in fewer registers once in 30,000 times.
BITS = 2
LONGS = -(-REGISTERS // 64)
_AGREE = THRESHOLD + (1 - THRESHOLD) / 2**BITS
LEAST_AGREE = int(REGISTERS * _AGREE - 4 * (REGISTERS * _AGREE * (1 - _AGREE)) ** 0.5)
# Texts of a hub, and their bytes, that meet those of another block in one group.
BLOCK, BLOCK_BYTES = 1024, 1 << 24
# Pairs that one part of a text's pairs holds when they are measured.
PART = 1024
# Elements that a task draws arrivals for at once.
AT_ONCE = 400_000

words_of = re.compile(WORD).findall
U = np.uint64
M1, M2, G = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB), U(0x9E3779B97F4A7C15)


def mixed_bits(x: np.ndarray) -> np.ndarray:
    """A fixed scrambling of 64-bit numbers, the finaliser of the splitmix generator."""
    x = (x ^ (x >> U(30))) * M1
    x = (x ^ (x >> U(27))) * M2
    return x ^ (x >> U(31))


class WordNumbers(dict):
    """64-bit numbers of words, the same in every task."""

    LIMIT = 150_000

    def __missing__(self, word: str | bytes) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        data = word if isinstance(word, bytes) else word.encode("utf-8", "surrogatepass")
        number = self[word] = xxhash.xxh64_intdigest(data)
        return number


def shingles(text: str, numbers: WordNumbers) -> tuple[np.ndarray, np.ndarray]:
    """The elements (sorted 64-bit numbers) and weights (counts) of a text.

    Words are in lower case. A text of one to four words is one element; a text
    without words has none.
    """
    words = words_of(text.lower())
    ids = np.fromiter(map(numbers.__getitem__, words), dtype=U, count=len(words))
    width = min(SHINGLE, len(ids))
    if not width:
        return np.empty(0, dtype=U), np.empty(0)
    runs = np.full(len(ids) - width + 1, U(width))
    for i in range(width):
        runs = mixed_bits(runs * G + ids[i : len(ids) - width + 1 + i])
    elements, counts = np.unique(runs, return_counts=True)
    return elements, counts.astype(float)


def signatures(elements: np.ndarray, weights: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """ProbMinHash registers of several sets, a row each: the element whose arrival came first.

    ``lengths`` says how many of the elements belong to each set, one at least.
    Arrivals are made up to a time that likely fills all registers of the set:
    later ones cannot change a full register, so the rest of the (endless)
    processes is left out. Where a register is still empty, the time doubles.
    """
    sets = len(lengths)
    owner = np.repeat(np.arange(sets), lengths)
    limit = REGISTERS * (np.log(REGISTERS) + 3) / np.bincount(owner, weights, minlength=sets)
    best, first = np.zeros(sets * REGISTERS, dtype=U), np.full(sets * REGISTERS, np.inf)
    state = (elements, weights, owner, np.zeros(len(elements)), np.zeros(len(elements), dtype=U))
    late = []
    while True:
        while len(state[0]):
            element, rate, of, time, turn = state
            draw = mixed_bits(element + (turn + U(1)) * G)
            arrival = time - np.log(((draw >> U(11)).astype(float) + 0.5) / 2.0**53) / rate
            early = arrival <= limit[of]
            late.append(tuple(x[~early] for x in state))
            element, rate, of, turn, arrival = (x[early] for x in (element, rate, of, turn, arrival))
            register = (mixed_bits(element ^ mixed_bits(turn + G)) % U(REGISTERS)).astype(np.int64) + of * REGISTERS
            order = np.argsort(-arrival, kind="stable")
            slot, when, what = register[order], arrival[order], element[order]
            soonest, winner = np.full(len(first), np.inf), np.zeros(len(first), dtype=U)
            soonest[slot], winner[slot] = when, what
            better = soonest < first
            best[better], first[better] = winner[better], soonest[better]
            state = (element, rate, of, arrival, turn + U(1))
        short = np.isinf(first.reshape(sets, REGISTERS)).any(axis=1)
        if not short.any():
            return best.reshape(sets, REGISTERS)
        limit = np.where(short, limit * 2, limit)
        state = tuple(np.concatenate([x[i] for x in late]) for i in range(5))
        keep = short[state[2]]
        state, late = tuple(x[keep] for x in state), []


def band_keys(registers: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of registers."""
    keys = np.tile(np.arange(BANDS, dtype=U) + U(1), (len(registers), 1))
    for i in range(ROWS):
        keys = mixed_bits(keys * G + registers.reshape(-1, BANDS, ROWS)[:, :, i])
    return keys.view(np.int64)


def packed_bits(registers: np.ndarray) -> np.ndarray:
    """BITS times LONGS longs a row: the first bits of all registers, then the second ones."""
    scrambled = mixed_bits(registers)
    out = []
    for bit in range(BITS):
        flags = np.zeros((len(registers), LONGS * 64), dtype=np.uint8)
        flags[:, :REGISTERS] = (scrambled >> U(bit)) & U(1)
        out.append(np.packbits(flags, axis=1).view(">i8").astype(np.int64))
    return np.hstack(out) if len(registers) else np.empty((0, BITS * LONGS), dtype=np.int64)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements d of 1 / sum over all e of max(a_e / a_d, b_e / b_d).

    An element e counts with a_e / a_d if a_e / b_e is at least a_d / b_d, so the
    inner sums are running totals over the elements in the order of that ratio.
    """
    if not len(a[0]) or not len(b[0]):
        return float(len(a[0]) == len(b[0]))
    _, at_a, at_b = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    wa, wb = a[1][at_a], b[1][at_b]
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    if (wa == wb).all():
        return float((wa / (wa.sum() + only_a + only_b)).sum())
    order = np.argsort(wa / wb, kind="stable")
    wa, wb = wa[order], wb[order]
    ratio = wa / wb
    behind = np.searchsorted(ratio, ratio, side="left")
    sum_a = only_a + np.concatenate([np.cumsum(wa[::-1])[::-1], [0.0]])[behind]
    sum_b = only_b + np.concatenate([[0.0], np.cumsum(wb)])[behind]
    return float((1.0 / (sum_a / wa + sum_b / wb)).sum())


def sketched(docs: DataFrame) -> DataFrame:
    """doc_id, text_key (md5), bands, bits of every row; bands and bits are null for texts without words."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers = WordNumbers()
        for batch in batches:
            todo, size = [], 0
            for doc_id, text in zip(batch["doc_id"], batch["text"]):
                elements, weights = shingles(text, numbers)
                todo.append((doc_id, hashlib.md5(text.encode("utf-8", "surrogatepass")).digest(), elements, weights))
                size += len(elements)
                if size >= AT_ONCE:
                    yield frame(todo)
                    todo, size = [], 0
            if todo:
                yield frame(todo)

    def frame(todo) -> pd.DataFrame:
        bands, bits = [None] * len(todo), [None] * len(todo)
        full = [i for i, x in enumerate(todo) if len(x[2])]
        if full:
            registers = signatures(
                np.concatenate([todo[i][2] for i in full]),
                np.concatenate([todo[i][3] for i in full]),
                np.array([len(todo[i][2]) for i in full]),
            )
            for i, keys, longs in zip(full, band_keys(registers), packed_bits(registers)):
                bands[i], bits[i] = keys, longs
        ids = pd.Series([x[0] for x in todo], dtype=object)
        return pd.DataFrame({"doc_id": ids, "text_key": [x[1] for x in todo], "bands": bands, "bits": bits})

    rows = texts(docs)
    return rows.mapInPandas(run, f"doc_id {dict(rows.dtypes)['doc_id']}, text_key binary, bands array<bigint>, bits array<bigint>")


def measured(pairs: DataFrame, sources: DataFrame) -> DataFrame:
    """a, b, similarity: the exact similarity of each pair of text keys.

    Only texts that some pair names are read on; ``sources`` has text_key and
    text of each distinct text once.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        numbers, memory = WordNumbers(), {}

        def held(key, text):
            if key not in memory:
                if len(memory) >= 500:
                    memory.clear()
                memory[key] = shingles(text, numbers)
            return memory[key]

        for batch in batches:
            found = [
                probability_jaccard(held(a, x), held(b, y))
                for a, x, b, y in zip(batch["a"], batch["text_a"], batch["b"], batch["text_b"])
            ]
            yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "similarity": np.array(found, dtype=float)})

    rows = with_text(with_text(pairs.select("a", "b"), sources, "a", "b"), sources, "b", "a")
    return rows.mapInPandas(run, "a binary, b binary, similarity double")


def with_text(pairs: DataFrame, sources: DataFrame, side: str, other: str) -> DataFrame:
    """The pairs with the text of one side as text_<side>.

    The pairs of a text are dealt into parts of about PART, and the text goes to
    each of them, so that a hub's pairs spread over many tasks.
    """
    parts = pairs.groupBy(side).agg(F.ceil(F.count(F.lit(1)) / PART).alias("parts"))
    each = F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part")
    known = sources.withColumnRenamed("text_key", side).join(parts, side).select(side, F.col("text").alias(f"text_{side}"), each)
    many = parts.filter("parts > 1")
    part = F.pmod(F.xxhash64(other), F.coalesce("parts", F.lit(1).cast("long"))).alias("part")
    return pairs.join(many, side, "left").select(*pairs.columns, part).join(known, [side, "part"]).drop("part")


def components(links: DataFrame) -> DataFrame:
    """node, root: the smallest node that ``links`` (a, b) connect each of their nodes with.

    Large-star and small-star steps: links are turned towards smaller and smaller
    neighbours until each node hangs on its root. Minima merge before the
    shuffle and neighbours are joined, never gathered, so a hub of any degree is fine.
    """
    links = stored(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "links")
    if links.isEmpty():
        return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
    seen = None
    while True:
        both = links.union(links.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").select(F.greatest("b", "m").alias("a"), F.least("b", "m").alias("b"))
        small = small.union(least.select("a", F.col("m").alias("b")))
        links = stored(small.filter("a <> b").distinct(), "links")
        now = links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if now == seen:
            break
        seen = now
    roots = links.select(F.col("b").alias("node")).distinct()
    return links.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", F.col("node").alias("root")))


def near_classes(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, root, class_id, copies, links of every row.

    root is the smallest text_key of the row's class, which tells classes apart,
    and class_id its smallest doc_id, which unlike classes may share if ids are
    repeated or null. A class is the rows whose texts are connected by exact
    copies and by links of probability Jaccard similarity THRESHOLD or more;
    copies counts the rows with the very same text, links the
    different texts that it was linked with on the way (texts that are connected
    already need no further link and are not compared again).

    First each text meets, in each of its buckets, the bucket's hub, the text
    with most neighbours; what is not connected then meets the other texts of
    its hubs that its registers leave possible, likeliest first, until all pairs
    are measured or connected. These pairs are measured where their texts meet, block
    by block, and never are rows of their own: only links leave. A text of
    any length is one set; a task holds the sets of two blocks of texts. A null text reads as empty;
    texts without words are linked by exact copy only. Null doc_ids are kept (a
    class of nothing else has a null class_id), repeated rows are rows of their
    own, an empty table gives no rows, other columns are not read.
    """
    sketches = stored(sketched(docs), "sketches")
    nodes = sketches.groupBy("text_key").agg(
        F.min("doc_id").alias("least_id"), F.count(F.lit(1)).alias("copies"), F.any_value("bands").alias("bands"), F.any_value("bits").alias("bits")
    )
    nodes = stored(nodes, "nodes")
    rows = nodes.filter("bands IS NOT NULL").select("text_key", F.posexplode("bands").alias("turn", "band"))
    shared = stored(rows.groupBy("band").agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "shared")
    members = stored(rows.join(shared, "band"), "members")
    reach = members.groupBy("text_key").agg(F.sum(F.col("n") - 1).alias("reach"))
    ranked = stored(members.join(reach, "text_key"), "ranked")
    hubs = ranked.groupBy("band").agg(F.max(F.struct("reach", "text_key")).getField("text_key").alias("hub"))
    met = stored(ranked.join(hubs, "band"), "met")
    key = F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary"))
    sources = docs.select(F.unhex(key).alias("text_key"), F.col("doc_id").alias("least_id"), F.coalesce("text", F.lit("")).alias("text"))
    firsts = nodes.filter("bands IS NOT NULL").select("text_key", "least_id")
    pairs = met.filter("text_key <> hub").select(F.col("text_key").alias("a"), F.col("hub").alias("b")).distinct()
    busy = met.select("text_key").distinct()
    # The id is part of the join's key, so that the copies of one text do not meet in one task.
    firsts = firsts.join(busy, "text_key", "left_semi").select(F.col("text_key").alias("key"), F.col("least_id").alias("of"))
    sources = sources.join(firsts, (F.col("text_key") == F.col("key")) & F.col("least_id").eqNullSafe(F.col("of")))
    sources = stored(sources.dropDuplicates(["text_key"]).select("text_key", "text"), "texts")
    near = stored(measured(pairs, sources), "similar")
    links = near.filter(F.col("similarity") >= THRESHOLD).select("a", "b")
    roots = stored(components(links), "roots")

    labelled = met.join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
    labelled = labelled.withColumn("root", F.coalesce("root", "text_key"))
    split = labelled.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low <> high")
    # Texts that share a band share its hub, which each of them has met: the rest is looked for hub by hub.
    apart = labelled.join(split.select("band"), "band", "left_semi").filter("text_key <> hub")
    apart = apart.select("hub", "text_key", "root").distinct()
    to_hub = near.select(F.col("a").alias("text_key"), F.col("b").alias("hub"), "similarity")
    apart = apart.join(to_hub, ["text_key", "hub"]).join(nodes.select("text_key", "bits"), "text_key")
    rest_links = stored(joining_links(apart.join(sources, "text_key")), "links")
    joined = stored(components(root_links(rest_links)), "roots")
    ends = ("a", "b")
    all_links = links.select(F.least(*ends).alias("a"), F.greatest(*ends).alias("b")).distinct()
    all_links = all_links.union(rest_links.select(*ends))
    degree = all_links.select(F.explode(F.array("a", "b")).alias("text_key")).groupBy("text_key").agg(F.count(F.lit(1)).alias("links"))
    named = nodes.select("text_key", "least_id", "copies").join(roots.withColumnRenamed("node", "text_key"), "text_key", "left")
    named = renamed_roots(named.withColumn("root", F.coalesce("root", "text_key")), joined)
    ids = named.groupBy("root").agg(F.min("least_id").alias("class_id"))
    classes = stored(named.join(ids, "root").join(degree, "text_key", "left").select("text_key", "root", "class_id", "copies", "links"), "classes")
    return (
        sketches.select("doc_id", "text_key")
        .join(classes, "text_key")
        .select("doc_id", "text_key", "root", "class_id", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"))
    )


def root_links(links: DataFrame) -> DataFrame:
    return links.select(F.col("root_a").alias("a"), F.col("root_b").alias("b"))


def renamed_roots(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """The rows with their root's root, where ``joined`` (node, root) has one."""
    newer = joined.select(F.col("node").alias("root"), F.col("root").alias("newer"))
    return rows.join(newer, "root", "left").withColumn("root", F.coalesce("newer", "root")).drop("newer")


def joining_links(apart: DataFrame) -> DataFrame:
    """a, b, root_a, root_b: similar pairs of one hub that connect all roots which similar pairs connect, a below b.

    ``apart`` has hub, text_key, root, similarity (to the hub), bits, text. A hub's texts
    are dealt into blocks of about BLOCK texts and BLOCK_BYTES, and each pair of blocks is one
    group, so that no group grows with the hub. A group measures the pairs that their
    sketches leave possible, likeliest first, and passes over those whose roots it has
    connected already; only similar pairs leave it.
    """
    wanted = F.greatest(F.count(F.lit(1)) / BLOCK, F.sum(F.octet_length("text")) / BLOCK_BYTES)
    sizes = apart.groupBy("hub").agg(F.greatest(F.ceil(wanted), F.lit(1)).alias("blocks"))
    rows = apart.join(sizes, "hub").withColumn("own", F.pmod(F.xxhash64("text_key"), F.col("blocks")))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    rows = rows.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")}).drop("other", "blocks")

    def find(frame: pd.DataFrame) -> pd.DataFrame:
        low, high = frame["low"].iloc[0], frame["high"].iloc[0]
        frame = frame.sort_values("text_key")
        names = pd.factorize(frame["root"])[0]
        one, two = possible_pairs(frame, names, frame["own"].to_numpy() == low, frame["own"].to_numpy() == high)
        keys, root, texts_of = frame["text_key"].to_numpy(), frame["root"].to_numpy(), frame["text"].to_numpy()
        numbers, sets = WordNumbers(), {}

        def held(i: int):
            if i not in sets:
                sets[i] = shingles(texts_of[i], numbers)
            return sets[i]

        def similar(i: int, j: int) -> bool:
            return probability_jaccard(held(i), held(j)) >= THRESHOLD

        found = np.array(spanning(zip(one.tolist(), two.tolist()), names.tolist(), similar), dtype=int).reshape(-1, 2)
        one, two = found[:, 0], found[:, 1]
        return pd.DataFrame({"a": keys[one], "b": keys[two], "root_a": root[one], "root_b": root[two]})

    found = rows.groupBy("hub", "low", "high").applyInPandas(find, "a binary, b binary, root_a binary, root_b binary")
    return found.distinct()


def spanning(pairs, names: list[int], similar) -> list[tuple[int, int]]:
    """The pairs (i, j) that are similar and whose names no earlier such pair connects; other pairs are not measured."""
    top = list(range(len(names)))

    def name(i: int) -> int:
        at = names[i]
        while top[at] != at:
            top[at] = top[top[at]]
            at = top[at]
        return at

    out = []
    for i, j in pairs:
        x, y = name(i), name(j)
        if x != y and similar(i, j):
            top[max(x, y)] = min(x, y)
            out.append((i, j))
    return out


def possible_pairs(frame: pd.DataFrame, names: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers i below j of pairs of the left and right rows with unlike names that may be similar, likeliest first.

    ``frame`` is in the order of text_key and has bits and similarity (to the hub).
    """
    same = bool((left == right).all())
    left, right = np.flatnonzero(left), np.flatnonzero(right)
    # A row for each long, so that a text meets all others in whole rows.
    bits = np.ascontiguousarray(np.stack(frame["bits"]).view(U).T)
    firsts, seconds = bits[:LONGS], bits[LONGS:]
    facing = np.ascontiguousarray(bits[:, right])
    near_hub = frame["similarity"].to_numpy()
    one, two, unlike = [], [], []
    for i in left:
        differ = np.zeros(len(right), dtype=np.int32)
        for x, y, mine, yours in zip(facing[:LONGS], facing[LONGS:], firsts[:, i], seconds[:, i]):
            differ += np.bitwise_count((x ^ mine) | (y ^ yours))
        keep = (differ <= REGISTERS - LEAST_AGREE) & (names[right] != names[i])
        if same:
            keep &= right > i
        # The distance 1 - similarity is a metric, so distances to the hub bound this one.
        keep &= np.abs(near_hub[right] - near_hub[i]) <= 1 - THRESHOLD + 1e-9
        one.append(np.full(int(keep.sum()), i))
        two.append(right[keep])
        unlike.append(differ[keep])
    one, two, unlike = (np.concatenate([np.empty(0, dtype=int), *x]) for x in (one, two, unlike))
    one, two = np.minimum(one, two), np.maximum(one, two)  # in the order of text_key
    order = np.lexsort((two, one, unlike))
    return one[order], two[order]


def one_of_each(docs: DataFrame) -> DataFrame:
    """One row of each class, with the smallest doc_id, in the columns of ``docs``.

    Classes of null ids only, and unlike classes with the same smallest id, keep a
    row each.
    """
    classes = near_classes(docs)
    kept = classes.filter(F.col("doc_id").eqNullSafe(F.col("class_id"))).groupBy("root", "class_id").agg(F.min("text_key").alias("kept_key"))
    key = F.unhex(F.md5(F.coalesce(F.col("text"), F.lit("")).cast("binary")))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("own_key"), "doc_id")
    same = (F.col("own_key") == F.col("kept_key")) & F.col("doc_id").eqNullSafe(F.col("class_id"))
    found = rows.join(kept, same).dropDuplicates(["kept_key"])
    return found.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op6_near_classes(spark: SparkSession, folder: str) -> DataFrame:
    """The class of near-duplicates of every document, its exact copies and its links."""
    return near_classes(table(spark, folder, "documents")).drop("text_key", "root")

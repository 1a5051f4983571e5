"""Exact nearest binary codes by incremental multi-index hashing.

A code is cut into segments, each with an index of its own. A query looks up its
segments with 0, 1, 2, ... bits changed. Codes not met after radius r differ in
more than r bits of each of the m segments, so in m * (r + 1) bits at least: a
query whose k-th verified distance is smaller is done.

An index is cut into blocks by the first bits of its segment. A query travels once
to each block that its changed values can be in; the values themselves are made
and looked up there, so neither they nor the rows met at them leave a task.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .mixing import stored

BITS = 64
K = 10
EVERY = 100
# Codes in a block of an index, of a block that is still cut, and in a stored row of a block.
BLOCK = 1 << 18
LEAST = 1 << 10
SLICE = 1 << 14
# Queries that meet a block in one task.
ASKED = 1 << 18
# Changed values, and pairs with the codes met, that a task has at once.
CELLS = 1 << 18


def sign_code(vector: Column) -> Column:
    """The signs of BITS numbers as the bits of a long; null for vectors of another length.

    A null or NaN entry counts as not positive.
    """
    code = F.lit(0).cast("long")
    for i in range(BITS):
        entry = F.coalesce(F.get(vector, F.lit(i)), F.lit(0.0))
        bit = F.lit((1 << i) - ((1 << 64) if i == 63 else 0)).cast("long")
        code = code.bitwiseOR(F.when((entry > 0) & ~F.isnan(entry), bit).otherwise(F.lit(0).cast("long")))
    return F.when(F.size(vector) == BITS, code)


def segments(rows: int) -> list[tuple[int, int]]:
    """(first bit, bits) of each segment: about log2(rows) bits each, so that a value has about one row."""
    m = min(16, max(2, math.ceil(BITS / math.log2(max(rows, 2)))))
    edges = [BITS * i // m for i in range(m + 1)]
    return [(a, b - a) for a, b in zip(edges, edges[1:])]


def _segment(code: Column, first: int, bits: int) -> Column:
    return F.shiftrightunsigned(code, first).bitwiseAND(F.lit((1 << bits) - 1).cast("long"))


def prefix_bits(rows: int) -> int:
    """Bits of a segment that name a block: even blocks have at most BLOCK codes, and 32 are made of LEAST codes or more."""
    n = max(rows, 1)
    return max(0, math.ceil(math.log2(n / BLOCK)), min(5, math.floor(math.log2(n / LEAST))))


def _places(code: Column, parts: list[tuple[int, int]], prefix: int) -> Column:
    """The block of each segment of a code: the segment's number and its first bits."""
    return F.array(*[_segment(code, first + bits - prefix, prefix) + F.lit(j << prefix) for j, (first, bits) in enumerate(parts)])


def nearest_codes(codes: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, id, distance: the k rows of ``codes`` (id, code) nearest to each of ``queries`` (id, code).

    Nearest is by Hamming distance, then id; a row that is also a query finds
    itself. Equal codes are one entry of the index with its k smallest ids, and
    equal queries are searched once. Rows with a null code are left out, repeated
    rows count as rows; with fewer than k rows all of them come out, and no rows
    give no rows. Each round writes what it found, so it can be done again alone.
    A block of more than BLOCK codes, as of one frequent value, is dealt out by code.
    """
    codes = stored(codes.select("id", "code").filter("code IS NOT NULL"), "codes")
    queries = stored(queries.select(F.col("id").alias("query_id"), "code").filter("code IS NOT NULL"), "queries")
    first_ids = Window.partitionBy("code").orderBy(F.asc_nulls_last("id"))
    members = stored(codes.withColumn("place", F.row_number().over(first_ids)).filter(F.col("place") <= k), "members")
    entries = stored(members.groupBy("code").agg(F.count(F.lit(1)).cast("int").alias("n")), "entries")
    distinct, needed = entries.count(), min(k, codes.count())
    parts, prefix = segments(distinct), prefix_bits(distinct)
    placed = entries.select("code", "n", F.posexplode(_places(F.col("code"), parts, prefix)).alias("part", "place"))
    # One row for BLOCK / 2 codes or more of each segment, or 32 rows.
    pieces = F.ceil(F.count(F.lit(1)) / BLOCK).cast("int")
    blocks = stored(placed.groupBy("part", "place").agg(pieces.alias("pieces")), "blocks")
    dealt = placed.join(F.broadcast(blocks.drop("part")), "place").withColumn("piece", F.pmod(F.xxhash64("code"), "pieces").cast("int"))
    packed = dealt.select("place", "piece", "code", "n").groupBy("place", "piece").applyInPandas(_pack(parts, prefix), INDEX)
    index = stored(packed, "segments")
    open_queries = queries.select(F.col("code").alias("q")).distinct().withColumn("bound", F.lit(BITS))
    open_queries, found, done = stored(open_queries, "open"), None, None
    radius = 0
    while needed and (left := open_queries.count()):
        pairs = _met(open_queries, left, index, blocks, parts, prefix, radius, needed)
        found = pairs if found is None else found.unionByName(pairs)
        found = stored(found, "found")
        up_to = Window.partitionBy("q").orderBy("distance").rowsBetween(Window.unboundedPreceding, 0)
        reached = found.groupBy("q", "distance").agg(F.sum("n").alias("n")).withColumn("seen", F.sum("n").over(up_to))
        bounds = reached.filter(F.col("seen") >= needed).groupBy("q").agg(F.min("distance").alias("kth"))
        covered = len(parts) * (radius + 1) - 1
        state = stored(open_queries.join(bounds.hint("merge"), "q", "left").select("q", F.least("bound", F.coalesce("kth", F.lit(BITS))).alias("bound"), "kth"), "state")
        over = F.col("kth").isNotNull() & (F.col("kth") <= covered)
        best = found.join(state.hint("merge"), "q").filter(F.col("distance") <= F.col("bound"))
        finished = best.filter(over).select("q", "code", "distance")
        done = finished if done is None else done.unionByName(finished)
        found = best.filter(~over).select("q", "code", "n", "distance")
        open_queries = state.filter(~over).select("q", "bound")
        radius += 1
    if done is None:
        done = entries.select(F.col("code").alias("q"), "code", F.lit(0).alias("distance")).limit(0)
    near = done.join(members.hint("merge"), "code").withColumn("rank", F.row_number().over(Window.partitionBy("q").orderBy("distance", F.asc_nulls_last("id"))))
    near = near.filter(F.col("rank") <= k).select("q", "rank", "id", "distance")
    return queries.join(near, F.col("q") == F.col("code")).select("query_id", "rank", "id", "distance")


INDEX = "place long, piece int, slice int, codes binary, sizes binary"


def _pack(parts: list[tuple[int, int]], prefix: int) -> Callable:
    """Of the codes of a block, in order of their values: rows of SLICE codes and their numbers of ids."""

    def pack(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        first, bits = parts[int(key[0]) >> prefix]
        codes, sizes = rows["code"].to_numpy().view(np.uint64), rows["n"].to_numpy(np.int32)
        order = np.argsort((codes >> first) & ((1 << bits - prefix) - 1))
        cuts = [order[i : i + SLICE] for i in range(0, len(order), SLICE)]
        return pd.DataFrame({"place": key[0], "piece": key[1], "slice": range(len(cuts)), "codes": [codes[x].tobytes() for x in cuts], "sizes": [sizes[x].tobytes() for x in cuts]})

    return pack


def _met(queries: DataFrame, n: int, index: DataFrame, blocks: DataFrame, parts: list[tuple[int, int]], prefix: int, radius: int, needed: int) -> DataFrame:
    """q, code, n, distance: what the n ``queries`` (q, bound) meet at ``radius``, within their bounds.

    A pair is met at the radius of its closest segment, and there at the first
    such segment: once in all.
    """
    turns = math.ceil(n / ASKED)
    asked = queries.select("q", "bound", F.posexplode(_places(F.col("q"), parts, prefix)).alias("part", "own"))
    asked = asked.join(F.broadcast(blocks), "part").filter(F.bit_count(F.col("own").bitwiseXOR(F.col("place"))) <= radius)
    asked = asked.select("place", F.explode(F.sequence(F.lit(0), F.col("pieces") - 1)).alias("piece"), F.pmod(F.xxhash64("q"), F.lit(turns)).cast("int").alias("turn"), "q", "bound")
    index = index.withColumn("turn", F.explode(F.sequence(F.lit(0), F.lit(turns - 1))))
    key = ["place", "piece", "turn"]

    def find(key: tuple, index: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found = []
        if len(index) and len(asked):
            rows = index.sort_values("slice")
            codes, sizes = (np.frombuffer(b"".join(rows[c]), kind) for c, kind in (("codes", np.uint64), ("sizes", np.int32)))
            q, bound = asked["q"].to_numpy().view(np.uint64), asked["bound"].to_numpy()
            found = [(q[i], codes[at], sizes[at], distance) for i, at, distance in search(codes, sizes, q, bound, int(key[0]), parts, prefix, radius, needed)]
        q, code, sizes, distance = map(np.concatenate, zip(*found)) if found else np.zeros((4, 0), np.uint64)
        return pd.DataFrame({"q": q.view(np.int64), "code": code.view(np.int64), "n": sizes.astype(np.int32), "distance": distance.astype(np.int32)})

    return index.groupBy(*key).cogroup(asked.groupBy(*key)).applyInPandas(find, "q long, code long, n int, distance int")


@lru_cache(64)
def _flips(bits: int, changed: int) -> np.ndarray:
    """Every number of ``bits`` bits of which ``changed`` are set."""
    numbers = np.arange(1 << bits, dtype=np.uint64)
    return numbers[np.bitwise_count(numbers) == changed]


def search(
    codes: np.ndarray, sizes: np.ndarray, q: np.ndarray, bound: np.ndarray, place: int, parts: list[tuple[int, int]], prefix: int, radius: int, needed: int
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Positions in ``q`` and ``codes``, and distances, of the pairs that block ``place`` has to give at ``radius``.

    Of a query's pairs those farther than ``needed`` ids of the same block are left
    out. Where a query has more changed values than the block has codes, it meets
    all codes instead.
    """
    part = place >> prefix
    first, low = parts[part][0], parts[part][1] - prefix
    own = (codes >> first) & ((1 << low) - 1)
    starts = np.concatenate([[0], np.cumsum(np.bincount(own.astype(np.int64), minlength=1 << low))]).astype(np.int32)
    apart = np.bitwise_count(((q >> first + low) & ((1 << prefix) - 1)) ^ (place & ((1 << prefix) - 1)))
    for changed in range(radius + 1):
        asked = np.flatnonzero(apart == radius - changed)
        ways = math.comb(low, changed)
        if not ways or not len(asked):
            continue
        masks = _flips(low, changed) if ways < len(codes) else None
        step = max(1, min(1 << 13, CELLS // min(ways, len(codes))))
        for rows in (asked[i : i + step] for i in range(0, len(asked), step)):
            if masks is None:
                begin, n = np.zeros((len(rows), 1), np.int32), np.full((len(rows), 1), len(codes), np.int32)
            else:
                values = ((q[rows] >> first) & ((1 << low) - 1))[:, None] ^ masks
                begin = starts[values]
                n = starts[values + 1] - begin
            of_row = n.sum(1, dtype=np.int64)
            ends = np.flatnonzero(np.diff(np.cumsum(of_row) // CELLS)) + 1
            for a, b in zip([0, *ends], [*ends, len(rows)]):
                many = n[a:b].ravel()
                upto = np.cumsum(many, dtype=np.int64)
                at = np.repeat(begin[a:b].ravel() - (upto - many), many) + np.arange(upto[-1])
                i = np.repeat(np.arange(b - a), of_row[a:b])
                i, at, distance = _nearest(codes, sizes, q[rows[a:b]], bound[rows[a:b]], i, at, parts, part, radius, needed)
                yield rows[a + i], at, distance


def _nearest(
    codes: np.ndarray, sizes: np.ndarray, q: np.ndarray, bound: np.ndarray, i: np.ndarray, at: np.ndarray, parts: list[tuple[int, int]], part: int, radius: int, needed: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of candidates (``i`` in ``q``, ``at`` in ``codes``): those within the bound that are met here first, and no farther ones than are needed."""
    apart = codes[at] ^ q[i]
    distance = np.bitwise_count(apart)
    keep = np.flatnonzero(distance <= bound[i])
    i, at, apart, distance = i[keep], at[keep], apart[keep], distance[keep]
    in_parts = np.stack([np.bitwise_count((apart >> first) & ((1 << bits) - 1)) for first, bits in parts])
    keep = np.flatnonzero((in_parts.argmin(0) == part) & (in_parts[part] == radius))
    i, at, distance = i[keep], at[keep], distance[keep].astype(np.int64)
    seen = np.bincount(i * (BITS + 1) + distance, sizes[at], len(q) * (BITS + 1)).reshape(-1, BITS + 1).cumsum(1)
    kth = np.where(seen[:, -1] >= needed, (seen >= needed).argmax(1), BITS)
    keep = np.flatnonzero(distance <= kth[i])
    return i[keep], at[keep], distance[keep]


def op8_multi_index_hashing(spark: SparkSession, folder: str) -> DataFrame:
    """The K nearest codes of every vector whose id is divisible by EVERY, against all vectors."""
    rows = table(spark, folder, "embeddings")
    codes = rows.select(F.col("vec_id").alias("id"), sign_code(F.col("embedding")).alias("code"))
    found = nearest_codes(codes, codes.filter(F.col("id") % EVERY == 0))
    return found.select("query_id", F.col("rank").cast("long").alias("rank"), F.col("id").alias("vec_id"), F.col("distance").cast("long").alias("distance"))

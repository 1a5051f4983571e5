import random

import numpy as np
import pytest

from modelyard.llm import binary_search
from modelyard.llm.binary_search import BITS, EVERY, K, nearest_codes, op8_multi_index_hashing, segments, sign_code
from tests.conftest import plan_of


def brute(codes, queries, k):
    out = []
    for query_id, q in queries:
        near = sorted((bin((c ^ q) & (1 << 64) - 1).count("1"), i is None, i) for i, c in codes)[:k]
        out += [(query_id, r + 1, i, d) for r, (d, _, i) in enumerate(near)]
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_segments_cover_all_bits():
    for n in (0, 1, 2, 100, 10**5, 10**10):
        parts = segments(n)
        assert parts[0][0] == 0 and sum(b for _, b in parts) == BITS and all(a + b == c for (a, b), (c, _) in zip(parts, parts[1:]))


def test_equals_brute_force_with_clusters_copies_and_ties(spark):
    pick = random.Random(8)
    signed = lambda: pick.getrandbits(64) - (1 << 63)
    centre = signed()
    codes = [(i, signed()) for i in range(60)] + [(100 + i, centre) for i in range(40)] + [(200 + i, centre ^ (1 << i)) for i in range(30)]
    codes += [(200, centre), (5, codes[5][1]), (300, None), (None, centre), (301, -1), (302, 0)]
    known = [x for x in codes if x[1] is not None]
    frame = spark.createDataFrame([(*x, "k") for x in codes], "id long, code long, rank string")
    queries = [x for x in known if x[0] is None or x[0] % 10 == 0] + [(100, centre)]
    asked = spark.createDataFrame([(*x, "k") for x in queries] + [(900, None, "k")], frame.schema)
    for k in (1, 5):
        assert rows_of(nearest_codes(frame, asked, k)) == brute(known, queries, k)


def test_changed_values_of_queries_are_not_broadcast(spark, monkeypatch):
    plans = []
    monkeypatch.setattr(binary_search, "stored", lambda df, name, keep=binary_search.stored: plans.append(plan_of(df)) or keep(df, name))
    pick = random.Random(9)
    codes = [(i, pick.getrandbits(64) - (1 << 63)) for i in range(300)]
    frame = spark.createDataFrame(codes, "id long, code long")
    asked = codes[::30]
    assert rows_of(nearest_codes(frame, frame.filter("id % 30 = 0"), 5)) == brute(codes, asked, 5)
    depth = lambda line: len(line) - len(line.lstrip(" :+-"))
    for lines in (x.splitlines() for x in plans):
        for i, line in enumerate(lines):
            if "BroadcastExchange" in line:
                below = next((j for j in range(i + 1, len(lines)) if depth(lines[j]) <= depth(line)), len(lines))
                assert not any("Generate" in x for x in lines[i:below]), "\n".join(lines)


def test_many_blocks_pieces_and_turns_equal_brute_force(spark, monkeypatch):
    for name, value in (("BLOCK", 32), ("LEAST", 8), ("SLICE", 5), ("ASKED", 7)):
        monkeypatch.setattr(binary_search, name, value)
    pick = random.Random(10)
    signed = lambda: pick.getrandbits(64) - (1 << 63)
    # Half of the codes have the same value in the first segments, so one block of each has to be dealt out.
    codes = [(i, signed() >> 40 << 40 | 77) for i in range(150)] + [(200 + i, signed()) for i in range(150)] + [(500 + i, -1) for i in range(15)] + [(None, 0)]
    frame = spark.createDataFrame(codes, "id long, code long")
    queries = [x for x in codes if x[0] is None or x[0] % 9 == 0]
    assert binary_search.prefix_bits(len(codes)) == 5
    assert rows_of(nearest_codes(frame, spark.createDataFrame(queries, frame.schema), 12)) == brute(codes, queries, 12)


@pytest.mark.parametrize("cells", [1, 50, 1 << 18])
def test_search_meets_each_pair_once_over_all_radii(monkeypatch, cells):
    monkeypatch.setattr(binary_search, "CELLS", cells)
    codes = np.random.default_rng(11).integers(0, 1 << 64, 90, np.uint64)
    codes[:40] &= np.uint64((1 << 64) - (1 << 20))
    q = np.concatenate([codes[::20], [np.uint64(0), np.uint64((1 << 64) - 1)]])
    for prefix in (0, 2):
        parts, met = segments(len(codes)), []
        for place in range(len(parts) << prefix):
            first, low = parts[place >> prefix][0], parts[place >> prefix][1] - prefix
            here = codes[(codes >> first + low) & ((1 << prefix) - 1) == place & ((1 << prefix) - 1)]
            here = here[np.argsort((here >> first) & ((1 << low) - 1))]
            for radius in range(max(b for _, b in parts) + 1 if len(here) else 0):
                for i, at, distance in binary_search.search(here, np.ones(len(here), np.int32), q, np.full(len(q), BITS), place, parts, prefix, radius, 10**9):
                    met += zip(i.tolist(), here[at].tolist(), distance.tolist())
        assert sorted(met) == sorted((i, int(c), int(a ^ c).bit_count()) for i, a in enumerate(q) for c in codes)


def test_search_leaves_out_what_is_farther_than_needed():
    parts, prefix = segments(8), 0
    codes = np.array([0, 1, 3, 7, 15, 16], np.uint64) << np.uint64(8)
    found = binary_search.search(codes, np.array([1, 1, 1, 1, 1, 1], np.int32), np.zeros(1, np.uint64), np.array([BITS]), 0, parts, prefix, 0, 2)
    assert sorted((int(c), d) for _, at, distance in found for c, d in zip(codes[at] >> np.uint64(8), distance.tolist())) == [(0, 0), (1, 1), (16, 1)]


def test_fewer_rows_than_k_and_none(spark):
    frame = spark.createDataFrame([(1, 5), (2, -7)], "id long, code long")
    assert rows_of(nearest_codes(frame, frame, 4)) == brute([(1, 5), (2, -7)], [(1, 5), (2, -7)], 4)
    assert nearest_codes(frame.limit(0), frame, 4).count() == 0 and nearest_codes(frame, frame.limit(0), 4).count() == 0


def test_codes_of_odd_vectors(spark):
    vectors = [[1.0] * 64, [-1.0] * 63 + [2.0], [1.0] * 63, None, [None] * 64, [float("nan")] * 64, [0.0] * 64]
    df = spark.createDataFrame([(v,) for v in vectors], "v array<float>")
    assert [r.c for r in df.select(sign_code(df.v).alias("c")).collect()] == [-1, -(1 << 63), None, None, 0, 0, 0]


def test_query_equals_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/embeddings.parquet").collect()
    codes = [(r.vec_id, sum((1 << i) for i, x in enumerate(np.array(r.embedding)) if x > 0)) for r in rows]
    want = brute(codes, [x for x in codes if x[0] % EVERY == 0], K)
    assert rows_of(op8_multi_index_hashing(spark, folder)) == want

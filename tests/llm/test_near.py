import random

import numpy as np
import pytest

from modelyard.llm.near import (
    LEAST_AGREE, REGISTERS, THRESHOLD, WordNumbers, components, joining_links, near_classes, one_of_each, op6_near_classes, packed_bits,
    probability_jaccard, shingles, signatures, spanning,
)


def brute_similarity(a, b):
    a, b = (dict(zip(x[0].tolist(), x[1].tolist())) for x in (a, b))
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in {*a, *b}) for d in a if d in b)


def brute_classes(rows):
    """class of each text by testing all pairs."""
    texts = sorted({t or "" for _, t in rows})
    sets = [shingles(t, WordNumbers()) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if len(sets[i][0]) and len(sets[j][0]) and probability_jaccard(sets[i], sets[j]) >= THRESHOLD:
                root[find(i)] = find(j)
    ids = {}
    for doc_id, text in rows:
        ids.setdefault(find(texts.index(text or "")), []).append(doc_id)
    return {(d, t or ""): min((x for x in ids[find(texts.index(t or ""))] if x is not None), default=None) for d, t in rows}


def family(pick, doc_id, words, copies, most):
    out = []
    for i in range(copies):
        copy = list(words)
        for _ in range(pick.randint(0, most)):
            copy[pick.randrange(len(copy))] = f"e{pick.randrange(10**6)}"
        out.append((doc_id + i, " ".join(copy)))
    return out


def test_similarity_equals_definition_and_registers_agree_as_often():
    pick, numbers, off = random.Random(1), WordNumbers(), []
    for _ in range(120):
        words = [f"w{pick.randint(0, 12)}" for _ in range(pick.randint(1, 60))]
        other = list(words) + words[: pick.choice([0, 0, 9])]
        for _ in range(pick.randint(0, 3)):
            other[pick.randrange(len(other))] = "q"
        a, b = shingles(" ".join(words), numbers), shingles(" ".join(other), numbers)
        assert probability_jaccard(a, b) == pytest.approx(brute_similarity(a, b), abs=1e-12)
        both = signatures(np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]]), np.array([len(a[0]), len(b[0])]))
        off.append((both[0] == both[1]).mean() - probability_jaccard(a, b))
        assert (signatures(*a, np.array([len(a[0])]))[0] == both[0]).all()
    assert abs(np.mean(off)) < 0.01 and np.std(off) < 0.05


def test_packed_bits_tell_equal_registers():
    registers = np.arange(2 * REGISTERS, dtype=np.uint64).reshape(2, REGISTERS)
    registers[1, :100] = registers[0, :100]
    a, b = packed_bits(registers).view(np.uint64)
    half = len(a) // 2
    differ = sum(bin(int((a[i] ^ b[i]) | (a[i + half] ^ b[i + half]))).count("1") for i in range(half))
    assert 100 <= REGISTERS - differ <= 100 + 80 and LEAST_AGREE < REGISTERS * 0.85


def test_components_of_chains_and_hubs(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 160)] + [(201, 200), (201, 200), (300, 300)]
    roots = {r.node: r.root for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert roots == {**dict.fromkeys(range(41), 0), **dict.fromkeys(range(100, 160), 100), 200: 200, 201: 200}


def test_equals_brute_force_with_families_and_edges(spark, monkeypatch):
    monkeypatch.setattr("modelyard.llm.near.BLOCK", 4)  # families span many blocks
    pick = random.Random(3)
    rows = []
    for f in range(6):
        rows += family(pick, 100 * f, [f"f{f}w{i}" for i in range(60 + 30 * f)], 14, 6)
    passage = [f"p{i}" for i in range(40)]
    rows += [(1000 + i, " ".join(passage + [f"o{i}x{j}" for j in range(60)])) for i in range(15)]
    rows += [(2000, None), (2001, ""), (2002, " \n"), (2003, "one two"), (2004, "One two"), (None, "one two"), (2003, "one two"), (None, "alone here")]
    rows += [(3000 + i, "the very same text again and again") for i in range(30)] + [(4000, "x " * 50000), (4001, "x " * 49000)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, bands string")
    want = brute_classes(rows)
    found = near_classes(docs).join(docs.select("doc_id", "text"), "doc_id").collect()
    assert near_classes(docs).count() == len(rows)
    by_id = {}
    for (doc_id, _), class_id in want.items():
        by_id.setdefault(doc_id, set()).add(class_id)
    for r in found:
        assert r.class_id in by_id[r.doc_id], (r, by_id[r.doc_id])
    kept = one_of_each(docs)
    assert kept.columns == docs.columns
    classes = {c for (d, _), c in want.items() if c is not None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(classes)
    assert near_classes(docs.limit(0)).count() == 0 and one_of_each(docs.limit(0)).count() == 0


def test_connected_pairs_are_not_measured():
    measured = []
    alike = lambda i, j: measured.append((i, j)) or (i < 50) == (j < 50)
    found = spanning([(i, j) for i in range(100) for j in range(i + 1, 100)], list(range(100)), alike)
    assert len(found) == 98 and len(measured) == 50 * 50 + 98  # of 4,950 pairs


def test_near_copies_of_one_hub_give_no_row_for_each_pair(spark, monkeypatch):
    """A group's rows are its links, which grow with its texts and not with their pairs, however it is dealt into blocks."""
    rows = family(random.Random(6), 0, [f"w{i}" for i in range(200)], 60, 1)
    sets = [shingles(t, WordNumbers()) for _, t in rows]
    bits = [packed_bits(signatures(*x, np.array([len(x[0])])))[0].tolist() for x in sets]
    frame = [(b"hub", b"%02d" % i, b"%02d" % i, 0.9, bits[i], t) for i, t in rows]
    apart = spark.createDataFrame(frame, "hub binary, text_key binary, root binary, similarity double, bits array<long>, text string")
    for size in (1024, 20):
        monkeypatch.setattr("modelyard.llm.near.BLOCK", size)
        links = joining_links(apart).collect()
        assert all(probability_jaccard(sets[int(r.a)], sets[int(r.b)]) >= THRESHOLD and r.a < r.b for r in links)
        blocks = -(-60 // size)
        assert 59 <= len(links) < 60 * blocks**2 and len({x for r in links for x in (r.a, r.b)}) == 60


def test_unlike_classes_with_the_same_or_no_smallest_id_keep_a_row_each(spark):
    words = lambda name: " ".join(f"{name}{i}" for i in range(40))
    rows = [(None, words("a")), (None, words("b")), (None, words("b")), (None, words("b") + " more"), (None, "")]
    rows += [(7, words("c")), (7, words("d")), (7, words("d")), (8, words("d")), (9, words("d") + " more"), (None, words("d")), (5, words("e")), (7, words("e"))]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, class_id string")
    kept = [(r.doc_id, r.text) for r in one_of_each(docs).collect()]
    alike = {words("b") + " more": words("b")}
    want = [(None, words("a")), (None, words("b")), (None, ""), (7, words("c")), (7, words("d")), (5, words("e"))]
    assert sorted(((d, alike.get(t, t)) for d, t in kept), key=str) == sorted(want, key=str)


def test_query_finds_classes_of_the_table(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    want = brute_classes(rows)
    got = {r.doc_id: r.class_id for r in op6_near_classes(spark, folder).collect()}
    assert got == {d: c for (d, _), c in want.items()} and len(got) == len(rows)

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from modelyard.llm.common import id_remainder
from modelyard.llm.lm import FOLD, PRIOR, ROUNDS, interpolated_scores, op1_deleted_interpolation, packed, unpacked


def tokens_of(text):
    lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", lower) if w]
    return words + ["\n"]


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def bucket(count):
    return 0 if not count else 1 + int(math.log2(count))


class Brute:
    """The same model by dictionaries, text by text."""

    def __init__(self, rows):
        train = [(d, tokens_of(t)) for d, t in rows if crc(d) % 7 != 2]
        learn = [x for x in train if crc(x[0]) % (7 * FOLD) // 7 == 0]
        rest = [x for x in train if crc(x[0]) % (7 * FOLD) // 7 != 0]
        self.n, self.whole = sum(len(t) for _, t in train), self.count(train)
        self.v = len(self.whole[0])
        self.weights = {}
        events, counts, n = Counter(), self.count(rest), sum(len(t) for _, t in rest)
        for _, text in learn:
            for a, b in zip(["\n"] + text, text):
                events[(bucket(counts[0][a]), *self.parts(a, b, counts, n))] += 1
        for _ in range(ROUNDS):
            sums = {}
            for (k, *p), times in events.items():
                shares = [w * x for w, x in zip(self.weight(k), p)]
                old = sums.setdefault(k, [PRIOR if k else 0, PRIOR, PRIOR])
                sums[k] = [o + times * s / sum(shares) for o, s in zip(old, shares)]
            self.weights = {k: [x / sum(s) for x in s] for k, s in sums.items()}

    @staticmethod
    def count(texts):
        one, two = Counter(), Counter()
        for _, text in texts:
            one.update(text)
            two.update(zip(["\n"] + text, text))
        return one, two

    def weight(self, k):
        return self.weights.get(k) or ([1 / 3] * 3 if k else [0, 0.5, 0.5])

    def parts(self, a, b, counts, n):
        one, two = counts
        return (two[a, b] / one[a] if one[a] else 0, one[b] / n if n else 1 / (self.v + 1), 1 / (self.v + 1))

    def score(self, text):
        total = 0
        for a, b in zip(["\n"] + text, text):
            p = self.parts(a, b, self.whole, self.n)
            total += math.log10(sum(w * x for w, x in zip(self.weight(bucket(self.whole[0][a])), p)))
        return total

    def base(self, text):
        return sum(math.log10((self.whole[0][w] + 1) / (self.n + self.v + 1)) for w in text)


def compare(rows, got):
    brute = Brute(rows)
    want = Counter()
    for d, t in rows:
        x = tokens_of(t)
        known = sum(brute.whole[0][w] > 0 for w in x)
        want[d, crc(d) % 7 == 2, len(x), known, brute.n, round(brute.base(x), 5), round(brute.score(x), 5)] += 1
    have = Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5), round(r.score, 5)) for r in got)
    assert have == want


@pytest.fixture
def small_blocks(monkeypatch):
    monkeypatch.setattr("modelyard.llm.lm.BLOCK_CHARS", 4000)


def test_numbers_survive_packing():
    numbers = np.array([0, 1, 255, 256, 2**63, 2**64 - 1], dtype=np.uint64)
    assert (unpacked(packed(numbers)) == numbers).all() and len(unpacked(packed(numbers[:0]))) == 0


def test_equals_dictionaries_over_many_blocks(spark, small_blocks):
    pick = random.Random(4)
    words = ["The", "the", "a", "é", "É", "x,", "-"] + [f"w{i}" for i in range(60)]
    rows = [(i, " \t".join(pick.choice(words[: pick.choice([5, 67])]) for _ in range(pick.randint(0, 60)))) for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, " \n "), (None, "the a"), (None, "the a"), (5, rows[5][1]), (1003, "the a " * 9000)]
    docs = spark.createDataFrame([(*r, "k") for r in rows], "doc_id long, text string, score string")
    compare(rows, interpolated_scores(docs, id_remainder(7) != 2).collect())


def test_without_rows_or_training(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    assert interpolated_scores(docs.limit(0), id_remainder(7) != 2).count() == 0
    rows = interpolated_scores(docs, id_remainder(7) < 0).collect()
    assert [(r.train_tokens, r.n_known) for r in rows] == [(0, 0)] * 2 and all(r.score == r.base_score == 0 for r in rows)


def test_query_equals_dictionaries_and_beats_the_base(spark, folder):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    got = op1_deleted_interpolation(spark, folder).collect()
    compare(rows, got)
    assert sum(r.score for r in got if r.held_out) > sum(r.base_score for r in got if r.held_out)

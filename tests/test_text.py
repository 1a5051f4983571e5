import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from modelyard.functions.scalars import argmax, cosine, value_or
from modelyard.functions.text import ari_grade, rouge2, sentence_count, word_count
from modelyard.operators.conversations import exchanges, histories


def python_rouge2(a, b):
    grams = []
    for text in (a, b):
        t = re.findall("[a-z0-9]+", text.lower())
        grams.append(Counter(zip(t, t[1:])))
    total = sum(grams[0].values()) + sum(grams[1].values())
    return 2 * sum((grams[0] & grams[1]).values()) / total if total else 0.0


def test_rouge2_counts_repeated_bigrams(spark):
    rng = random.Random(5)
    text = lambda n: " ".join(rng.choice(["a", "b", "c", "D", "é", "f1"]) + rng.choice(["", ".", ","]) for _ in range(n))
    rows = [(text(rng.randint(0, 40)), text(rng.randint(0, 40))) for _ in range(60)] + [("", ""), ("one", "one"), ("x y", "x y")]
    df = spark.createDataFrame(rows, "a string, b string")
    found = [r[0] for r in df.select(rouge2(F.col("a"), F.col("b"))).collect()]
    assert found == pytest.approx([python_rouge2(a, b) for a, b in rows])


def python_counts(text):
    blank = re.compile("[ \t\r\n]+")
    words = lambda s: [w for w in blank.split(s) if any(c.isalnum() for c in w)]
    pieces = re.split("[.!?]+", text)
    return len(words(text)), max(1, sum(len(words(p)) >= 3 for p in pieces))


def test_word_and_sentence_counts(spark):
    texts = [
        "One two three. Four five! Six seven eight nine? Ten", "", "...", "a.b.c d", "No. no no. no no no.", "-- a - b -- c --!",
        "éa ñ ü. x\ny\tz", "abc def", "word" * 3000, "a,b c;d e.f g h", "(one) [two] {three}...four five six",
    ]
    rng = random.Random(2)
    texts += ["".join(rng.choice("ab .!?,-\n") for _ in range(rng.randint(1, 80))) for _ in range(200)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    found = [tuple(r) for r in df.select(word_count(F.col("t")), sentence_count(F.col("t"))).collect()]
    assert found == [python_counts(t) for t in texts]


def test_ari(spark):
    df = spark.createDataFrame([("The cat sat here. It was fine today.",), ("...",)], "t string")
    good, none = [r[0] for r in df.select(ari_grade(F.col("t"))).collect()]
    assert good == pytest.approx(4.71 * 29 / 8 + 0.5 * 8 / 2 - 21.43) and none is None


def test_argmax_takes_the_first_largest(spark):
    df = spark.createDataFrame([([0.1, 0.9, 0.9],), ([5.0],)], "a array<double>")
    assert [r[0] for r in df.select(argmax(F.col("a"))).collect()] == [1, 0]


def test_cosine_and_default(spark):
    df = spark.createDataFrame([([1.0, 0.0], [1.0, 1.0]), ([0.0, 0.0], [1.0, 0.0])], "a array<double>, b array<double>")
    found = [r[0] for r in df.select(cosine(F.col("a"), F.col("b"))).collect()]
    assert found[0] == pytest.approx(2**-0.5) and found[1] is None
    settings = spark.createDataFrame([({"k": "v"},), ({},)], "m map<string,string>")
    assert [r[0] for r in settings.select(value_or(F.col("m"), "k", "d")).collect()] == ["v", "d"]


def test_histories_stay_in_order_and_bounded(spark):
    rows = [("long", i, "user" if i % 2 == 0 else "assistant", f"t{i}") for i in range(500)] + [("short", 0, "user", "x")]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "conv_id string, turn int, role string, text string")
    found = histories(df, turns=64).collect()
    assert max(r.n_turns for r in found) == 64 and sum(r.n_turns for r in found) == 501
    long = [m.content for r in sorted((r for r in found if r.conv_id == "long"), key=lambda r: r.segment) for m in r.history]
    assert long == [f"t{i}" for i in range(500)]
    assert exchanges(df).count() == 250

import random

import numpy as np

from modelyard.llm.common import id_remainder
from modelyard.llm.toxicity import CUT, Machine, Memory, fit_machine, op3_toxicity, scored, text_terms, trained, word_terms


def test_pair_sum_equals_brute_force():
    rng = np.random.default_rng(1)
    machine = Machine(np.arange(6), rng.normal(size=6), rng.normal(size=(6, 3)), 0.2)
    at = [0, 2, 3, 5]
    pairs = sum(machine.vectors[i] @ machine.vectors[j] for i in at for j in at if i < j)
    assert abs(machine.score(at) - 1 / (1 + np.exp(-(0.2 + machine.weights[at].sum() + pairs)))) < 1e-12


def test_machine_learns_a_pair_that_weights_alone_cannot():
    pick = random.Random(2)
    rows, labels = [], []
    for _ in range(1500):  # an insult and a group are harmless alone, or both absent; together they are not
        insult, group = pick.random() < 0.5, pick.random() < 0.5
        rows.append(np.array([i for i, on in enumerate((insult, group, pick.random() < 0.5)) if on], dtype=np.int64))
        labels.append(float(insult == group))
    machine = fit_machine(np.arange(3), rows, np.array(labels))
    assert machine.score([0, 1]) > 0.8 and machine.score([0]) < 0.2 and machine.score([1]) < 0.2 and machine.score([]) > 0.8


def test_training_keeps_terms_that_tell_something_together_only(spark):
    pick = random.Random(2)
    filler = [f"{a}{b}" for a in "bcdfghklmn" for b in "aeiou"]
    rows, labels = [], []
    for i in range(1600):  # each word is as frequent in clean as in toxic texts
        insult, group = i % 2, i // 2 % 2
        words = pick.choices(filler, k=10) + ["zug"] * insult + ["qor"] * group
        rows.append((i, " ".join(words)))
        labels.append((i, int(insult == group)))
    machine = trained(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert set(word_terms("zug")) | set(word_terms("qor")) <= set(machine.terms.tolist())
    score = machine.scorer()
    found = [[score(f"{' '.join(pick.choices(filler, k=10))} {more}") for _ in range(50)] for more in ("zug qor", "", "zug", "qor")]
    assert min(np.mean(x) for x in found[:2]) > 0.7 and max(np.mean(x) for x in found[2:]) < 0.3


def test_terms_are_words_and_beginnings():
    assert len(word_terms("abc")) == 1 and len(word_terms("abcde")) == 2 and len(word_terms("abcdef")) == 3
    memory = Memory(word_terms)
    assert text_terms("Idiots! idiot's", memory) >= set(word_terms("idiots")) and text_terms("12 --", memory) == set()


def training(spark, n=400):
    pick = random.Random(3)
    common = ["alpha", "beta", "gamma", "delta", "one", "two", "three"]
    rows, labels = [], []
    for i in range(n):
        words = [pick.choice(common) for _ in range(20)]
        if i % 3 == 0:
            words[pick.randrange(20)] = pick.choice(["idiotic", "moronic"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(i % 3 == 0), "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int, predicted string")


def test_edges(spark):
    docs, labels = training(spark)
    more = spark.createDataFrame([(0, None, "x"), (None, 1, "x"), (0, 1, "x")], labels.schema)
    machine = trained(docs, labels.union(more))
    assert len(machine.terms) <= 2048
    rows = [(1, None, "x"), (2, "", "x"), (None, "an idiotic one", "x"), (3, "alpha beta", "x"), (3, "alpha beta", "x"), (4, "alpha " * 200000 + "moronic", "x")]
    got = scored(spark.createDataFrame(rows, docs.schema), machine).collect()
    assert len(got) == 6 and all(0 <= r.score <= 1 and r.predicted == int(r.score >= CUT) for r in got)
    assert {r.doc_id for r in got if r.predicted} == {None, 4}
    nothing = trained(docs.limit(0), labels.limit(0))
    assert 0 <= scored(docs, nothing).first().score <= 1 and scored(docs.limit(0), machine).count() == 0


def test_repeated_ids_teach_once(spark, monkeypatch):
    """A thousand rows of one id reach the fit as one."""
    docs, labels = training(spark, 30)
    many = docs.union(spark.range(1000).selectExpr("0L", "concat('alpha ', id)", "'x'"))
    seen = []
    monkeypatch.setattr("modelyard.llm.toxicity.stored", lambda df, name: seen.append(df.count()) or df)
    trained(many, labels)
    assert seen == [30]


def test_query_equals_brute_force(spark, folder):
    """Scores from the definition: all pairs of a text's terms, one by one."""
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    machine = trained(docs, labels.filter(id_remainder(3) != 1))
    place = {int(t): i for i, t in enumerate(machine.terms)}
    found = {r.doc_id: r for r in op3_toxicity(spark, folder).collect()}
    rows = [r for r in docs.collect() if len(r.text or "") < 1500]
    assert len(found) == docs.count() and len(rows) > 50
    for r in rows:
        words = set("".join(c if c.isalpha() else " " for c in (r.text or "").lower()).split())
        at = sorted({place[t] for w in words for t in word_terms(w) if t in place})
        margin = machine.constant + sum(machine.weights[i] for i in at)
        margin += sum(float(machine.vectors[i] @ machine.vectors[j]) for n, i in enumerate(at) for j in at[:n])
        want = 1 / (1 + np.exp(-margin))
        assert abs(found[r.doc_id].score - want) < 1e-6 and found[r.doc_id].predicted == int(found[r.doc_id].score >= CUT)


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    found = op3_toxicity(spark, folder)
    assert found.columns == ["doc_id", "held_out", "score", "predicted"]
    rows = found.join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("held_out").collect()
    toxic = [r for r in rows if r.toxic]
    assert sum(r.predicted for r in toxic) >= 0.8 * len(toxic)
    assert sum(r.predicted for r in rows if not r.toxic) <= 0.005 * len(rows)
    assert found.count() == spark.read.parquet(f"{folder}/documents.parquet").count()
    assert found.filter((id_remainder(3) == 1) != found.held_out).count() == 0

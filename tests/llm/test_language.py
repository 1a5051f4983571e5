import math
import random

import numpy as np
import pytest

from modelyard.llm.language import (
    LEVELS, NONE, SMOOTH, STRENGTH, TextModel, address, declared_language, grams, identified, identified_documents,
    in_some_language, op4_language_evidence, text_model, visible_text,
)

WORDS = {"aa": "bab baba ab abba", "cc": "cdc cdcd dc dccd"}


def counted():
    counts = {}
    for k, text in enumerate(WORDS.values()):
        for word in text.split():
            for g in grams(word):
                counts.setdefault(g, [0, 0])[k] += 50
    return TextModel(list(WORDS), counts)


def brute(rows, model):
    """Posterior of each row by plain loops over all rows."""
    score = model.scorer()
    n = len(model.languages)
    scores = [score(r["text"] or "") for r in rows]
    priors = [(1 - 1e-6) / (n - 1)] * (n - 1) + [1e-6]
    soft = lambda x: np.exp(x - max(x)) / np.exp(x - max(x)).sum()
    alone = [soft(s + np.log(priors)) for s in scores]
    kinds = {k: len({r[k] for r in rows} - {None}) for k in ("declared", "suffix")}
    out = []
    for i, r in enumerate(rows):
        total = sum(alone) - alone[i]
        prior = (total + SMOOTH) / (total + SMOOTH).sum()
        for key in LEVELS:
            own = sum((alone[j] for j, o in enumerate(rows) if j != i and r[key] is not None and o[key] == r[key]), np.zeros(n))
            prior = (own + STRENGTH * prior) / (own.sum() + STRENGTH)
        x = scores[i] + np.log(prior)
        for key, many in kinds.items():
            if r[key] is not None:
                own = sum((alone[j] for j, o in enumerate(rows) if j != i and o[key] == r[key]), np.zeros(n))
                x = x + np.log((own + SMOOTH) / (total + SMOOTH * max(many, 1)))
        out.append(soft(x))
    return out


def test_fusion_equals_plain_loops(spark):
    rows = []
    for i in range(40):
        kind = "aa" if i % 3 else "cc"
        text = [WORDS[kind], WORDS[kind].split()[0], None, "", "12 34", "zzz qqq xxx " * 30][i % 6]
        rows.append(
            {"id": i // 2, "text": text, "declared": [kind, None, "aa"][i % 3], "suffix": ["x", None][i % 2], "domain": f"d{i % 2}",
             "site": f"s{i % 4}", "host": None if i == 7 else f"h{i % 5}", "language": "k"}
        )
    model = counted()
    want = brute(rows, model)
    types = "id long, text string, declared string, suffix string, domain string, site string, host string, language string"
    frame = spark.createDataFrame([tuple(r.values()) for r in rows], types)
    got = identified(frame, model).collect()
    assert len(got) == len(rows)
    key = lambda i, p, e: (i, round(p, 9), str(e))
    have = sorted(key(r.id, r.posterior, (r.declared, r.suffix, r.host)) for r in got)
    assert have == sorted(key(r["id"], float(max(w)), (r["declared"], r["suffix"], r["host"])) for r, w in zip(rows, want))
    assert {r.language for r in got} >= {"aa", "cc", NONE} and identified(frame.limit(0), model).count() == 0


def test_evidence_decides_where_the_text_is_silent(spark):
    types = "id long, text string, declared string, suffix string, domain string, site string, host string"
    rows = [(i, WORDS["cc"], "cc", None, None, None, "h") for i in range(20)] + [(i, WORDS["aa"], "aa", None, None, None, "g") for i in range(100, 160)]
    rows += [(1000, "", "cc", None, None, None, None), (1001, None, None, None, None, None, "h"), (1002, "123", None, None, None, None, None)]
    got = {r.id: r.language for r in identified(spark.createDataFrame(rows, types), counted()).collect()}
    assert got[1000] == "cc" and got[1001] == "cc" and got[1002] == "aa"


def test_markup_and_addresses(spark):
    page = "<!DOCTYPE html><HTML class=x lang='DE-at'><script>no</script><p>Gr&ouml;&szlig;e<br>x<!-- no --><nav>no</nav></p>"
    assert visible_text(page).split() == ["Größe", "x"]
    rows = [(page, "HTTPS://u:p@A.b.Example.com:80/x?y=z.q"), ("<html>", "no address"), (None, None), ("", "http://localhost/")]
    df = spark.createDataFrame(rows, "html string, url string")
    got = df.select(declared_language(df.html).alias("d"), *[c.alias(n) for n, c in address(df.url).items()]).collect()
    assert tuple(got[0]) == ("de", "a.b.example.com", "b.example.com", "example.com", "com")
    assert tuple(got[1]) == tuple(got[2]) == (None,) * 5 and tuple(got[3]) == (None, "localhost", "localhost", "localhost", None)


def test_rejected_documents_go(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet").withColumnRenamed("n_chars", "id")
    pick = random.Random(9)
    noise = " ".join("".join(pick.choice("bcdfghjklmnpqrstvwxz") for _ in range(6)) for _ in range(60))
    junk = spark.createDataFrame([(10**6, noise, "en", "src1", 1), (10**6 + 1, None, "en", "src1", 1), (None, "Thtion.", "en", None, 1)], docs.schema)
    kept = in_some_language(docs.union(junk).union(docs.limit(1)))
    ids = [r.doc_id for r in kept.collect()]
    assert kept.columns == docs.columns and 10**6 not in ids and 10**6 + 1 in ids and None in ids
    assert len(ids) >= docs.count() * 0.99 + 2 and in_some_language(docs.limit(0)).count() == 0


def test_a_rare_language_of_another_script_is_learned_and_stays(spark, monkeypatch):
    monkeypatch.setattr("modelyard.llm.language.FIT_ROWS", 30)
    monkeypatch.setattr("modelyard.llm.language.MAX_GRAMS", 15)
    greek = "και κακα ακ ακκα και κακα"
    rows = [(i, WORDS["aa"], "aa", f"s{i % 3}") for i in range(600)] + [(1000 + i, greek, "el", "s0") for i in range(4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    model = text_model(docs)
    assert model.languages == ["aa", "el", NONE] and all(sum(n[k] > 0 for n in model.counts.values()) > 3 for k in (0, 1))
    assert max(n[0] for n in model.counts.values()) <= 30 * 4
    assert {r.doc_id for r in in_some_language(docs).collect()} == {r[0] for r in rows}


@pytest.mark.parametrize("share", [0.99])
def test_accuracy(spark, share):
    folder = "/root/testdata/sf0.01"
    pages = op4_language_evidence(spark, folder).collect()
    assert len(pages) == spark.read.parquet(f"{folder}/pages.parquet").count()
    assert sum(r.language == r.declared for r in pages) >= share * len(pages)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    rows = identified_documents(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.language == r.lang for r in rows) >= share * len(rows)
    assert all(0 <= r.posterior <= 1 + 1e-9 and math.isfinite(r.posterior) for r in rows)
    assert set(text_model(docs).languages) == {"de", "en", "es", "fr", NONE}

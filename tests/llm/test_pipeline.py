import os

import pytest

from corpus_pipeline import ORACLE_SQL, STAGES, run
from modelyard.llm.bpe import _spec, codec
from modelyard.llm.language import identified_documents
from modelyard.llm.mixing import word_takes
from modelyard.llm.near import near_classes
from modelyard.llm.queries import ORACLE_SQL as SQL
from modelyard.llm.queries import QUERIES
from modelyard.llm.secrets import make_finder

os.environ["TOKENIZERS_PARALLELISM"] = "false"
tokenizers = pytest.importorskip("tokenizers")


@pytest.fixture(scope="module")
def steps(spark):
    folder = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    out = [docs]
    for _, stage in STAGES:
        rows = stage(spark, out[-1], folder)
        out.append(spark.createDataFrame(rows.collect(), rows.schema).cache())
    return out


def test_stages_in_order(steps):
    assert [name for name, _ in STAGES] == ["language", "near_duplicates", "secrets", "mix", "tokens"] and ORACLE_SQL is None
    for before, after in zip(steps, steps[1:-1]):
        assert after.columns == before.columns


def test_languages_and_near_duplicates(steps):
    docs, spoken, unique = steps[:3]
    rejected = {r.doc_id for r in identified_documents(docs).filter("language = 'und'").collect()}
    assert {r.doc_id for r in spoken.collect()} == {r.doc_id for r in docs.collect()} - rejected
    classes = {r.class_id for r in near_classes(spoken).collect()}
    assert sorted(r.doc_id for r in unique.collect()) == sorted(classes)


def test_secrets_and_mix(steps):
    unique, clean, mix = steps[2:5]
    find, texts = make_finder(), {r.doc_id: r.text for r in unique.collect()}
    cleaned = {r.doc_id: r.text for r in clean.collect()}
    assert cleaned.keys() == texts.keys() and not any(find(t) for t in cleaned.values())
    assert all(cleaned[d] == t for d, t in texts.items() if not find(t)) and any(find(t) for t in texts.values())
    want = {r.doc_id: r.taken for r in word_takes(clean).collect() if r.taken}
    got = {}
    for r in mix.collect():
        got[r.doc_id] = got.get(r.doc_id, 0) + len(r.text.split())
        assert cleaned[r.doc_id].startswith(r.text)
    assert got == want


def test_tokens_equal_the_library(steps):
    mix, ids = steps[4:]
    from modelyard.llm.bpe import default_tokenizer

    library, bpe = tokenizers.Tokenizer.from_file(default_tokenizer()), codec(_spec(None))
    texts = sorted((r.doc_id, tuple(library.encode(r.text, add_special_tokens=False).ids)) for r in mix.collect())
    rows = ids.collect()
    assert sorted((r.doc_id, tuple(r.ids)) for r in rows) == texts and all(r.n_tokens == len(r.ids) for r in rows)
    assert bpe is codec(_spec(None))


def test_run_gives_all_rows(spark, steps):
    assert run(spark, "/root/testdata/sf0.001").count() == steps[-1].count()


def test_every_operator_has_its_query():
    assert [name.split("_")[0] for name in QUERIES] == [f"op{n}" for n in range(1, 14)] and set(SQL) <= set(QUERIES)

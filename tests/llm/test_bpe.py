import hashlib
import os
import random

import numpy as np
import pytest

from modelyard.llm.bpe import _spec, codec, decoded, default_tokenizer, encoded, op2_bpe_round_trip

os.environ["TOKENIZERS_PARALLELISM"] = "false"
tokenizers = pytest.importorskip("tokenizers")
PARTS = ["a", "b", "  ", "\n", "\t", " ", "'s", "'", "''", "1", "23", "é", "ß", "😀", "中文", "<|endoftext|>", "<|endof", "!!", "..."]
PARTS += ["the", "ing", "hello world", "​", "\xa0", "　", "x" * 50, "ab" * 40, "\x1c", "\x85"]


@pytest.fixture(scope="module")
def library():
    return tokenizers.Tokenizer.from_file(default_tokenizer())


def test_equals_library_on_random_texts(library):
    pick, bpe = random.Random(5), codec(_spec(None))
    for _ in range(2500):
        text = "".join(pick.choice(PARTS) for _ in range(pick.randint(0, 16)))
        ids, written = bpe.encode(text)
        want = library.encode(text, add_special_tokens=False).ids
        assert ids.tolist() == want and written == ",".join(map(str, want)), text
        assert bpe.decode(ids) == library.decode(want, skip_special_tokens=False) == text


def test_broken_characters_decode_as_in_the_library(library):
    pick, bpe = random.Random(6), codec(_spec(None))
    for _ in range(500):
        ids = [pick.randrange(50257) for _ in range(pick.randint(0, 12))]
        assert bpe.decode(np.array(ids, dtype=np.int64)) == library.decode(ids, skip_special_tokens=False)


def test_no_token_crosses_a_cut():
    bpe = codec(_spec(None))
    assert 0 < sum(bpe.inside) < 1 << 15
    assert b"".join(bpe.fragments(b"q\xffz")) == b"q\xffz" and len(bpe.fragments(b"q\xffz")) == 3


def test_edges(spark, library):
    long = "word " * 40000 + "a" * 30000
    rows = [(1, None, 0), (2, "", 0), (None, "hi", 0), (3, "hi", 0), (3, "hi", 0), (4, long, 0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids long")
    found = encoded(docs)
    assert sorted((r.doc_id or 0, len(r.ids)) for r in found.collect())[:5] == [(0, 1), (1, 0), (2, 0), (3, 1), (3, 1)]
    back = {r.doc_id: r.text for r in decoded(found).collect()}
    assert back == {1: "", 2: "", None: "hi", 3: "hi", 4: long}
    assert encoded(docs.limit(0)).count() == 0


def test_query_equals_library(spark, folder, library):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    rows = op2_bpe_round_trip(spark, folder).collect()
    assert len(rows) == len(texts)
    for r in rows:
        ids = library.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        back = library.decode(ids, skip_special_tokens=False)
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(back.encode()).hexdigest()

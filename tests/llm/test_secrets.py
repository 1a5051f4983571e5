import hashlib
import random
import re

from modelyard.llm.secrets import BASE, KINDS, make_finder, op10_secret_spans, redacted, secret_spans

ASSIGN = re.compile(
    r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
)


def brute(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found)


def base(spans):
    return [x for x in spans if x[1] < len(BASE)]


def test_equals_regular_expressions_on_random_texts():
    pick = random.Random(7)
    parts = ["password", "Token", "api_key", "apikey", "secret", "passwd", "=", ":", " ", "'", '"', "abc", "AKIA", "\n", "é"]
    parts += ["ABCDEF0123", "deadbeef", "0123456789abcdef", "-", "_", ".", "ghp_", "x" * 20, "eyJab.eyJcd", "😀"]
    find = make_finder()
    for _ in range(8000):
        text = "".join(pick.choice(parts) for _ in range(pick.randint(0, 14)))
        assert base(find(text)) == brute(text), text


def test_own_kinds_add_spans():
    text = "a ghp_" + "A1b2" * 9 + " xoxb-1234567890-ab eyJhb.eyJzd -----BEGIN RSA PRIVATE KEY-----"
    assert [KINDS[k] for _, k, _ in make_finder()(text)] == ["github", "chat", "web_token", "private_key"]


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, "token=abcdefghijkl", "x"), (3, "é token=abcdefghijkl", "x"), (3, "é token=abcdefghijkl", "x")]
    rows.append((4, "word " * 60000 + "AKIA" + "Z" * 14, "x"))
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string")
    found = {(r.doc_id, tuple((s.kind, s.start, s.end) for s in r.spans)) for r in secret_spans(docs).collect()}
    assert secret_spans(docs).count() == len(rows)
    assert found == {
        (1, ()), (2, ()), (None, (("assign", 0, 18),)), (3, (("assign", 2, 20),)), (4, (("access", 300000, 300018),)),
    }
    assert secret_spans(docs.limit(0)).count() == 0
    cleaned = {r.doc_id: r.text for r in redacted(docs).collect()}
    assert cleaned[1] is None and cleaned[None] == "<assign>" and cleaned[3] == "é <assign>"
    assert redacted(docs).columns == docs.columns


def test_query_equals_brute_force(spark, folder, tmp_path):
    """The documents of the smallest scale, and planted ones so that every kind occurs."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    planted = ["key AKIA" + "Q7" * 8 + " here", 'Password: "hunter2hunter2"', "api_key=abcdef0123456789abcdef", "deadbeef" * 3, "AKIA short", "token = x"]
    extra = spark.createDataFrame([(10**9 + i, text) for i, text in enumerate(planted)], "doc_id long, text string")
    docs.unionByName(extra, allowMissingColumns=True).write.parquet(f"file://{tmp_path}/documents.parquet")
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"file://{tmp_path}/documents.parquet").collect()}
    rows = op10_secret_spans(spark, f"file://{tmp_path}").collect()
    assert len(rows) == len(texts) and all(any(r[n] for r in rows) for n in ("n_assign", "n_access", "n_hex"))
    for r in rows:
        want = brute(texts[r.doc_id] or "")
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(sum(k == i for _, k, _ in want) for i in range(3))
        listed = ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in want)
        assert r.base_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        assert set(listed.split(",")) - {""} <= set(r.spans.split(","))

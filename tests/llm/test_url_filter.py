"""Rules against a plain reading of urls, splits against all splits, and the model against plain sums."""

from itertools import combinations
from math import exp, log

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import url_filter as f
from modelyard.llm.common import table

PAGES = "page_id long, url string"


def plain_parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    return host, path[: min([path.find(c) for c in "?#" if c in path], default=len(path))]


def plain_rule(host, path):
    fits = [(s + p, v) for v, s, p in f.RULES if (host == s or host.endswith("." + s)) and path.startswith(p)]
    return max(fits, key=lambda r: len(r[0]), default=(None, None))


URLS = [
    "http://Example.com/en/1", "https://www.example.com/en/1", "https://a.www.example.com/en/", "http://notexample.com/en/x",
    "http://x.net/es/1", "http://x.net/de/1", "http://net/fr/", "http://net/fr", "http://example.com", "http://com/", "http://a.com?x=/en/",
    "http://a.com#/", "no scheme", "://", "", None, "http://h/a?b#c", "http://h/a#b?c", "x://y://z/q", "http://ÄB.com/Ä", "http://a.b.org/é\n/x",
    "http://" + "q" * 5000 + ".org/" + "p/" * 5000, "http://m.adult-x.example.org/de/3", "http://cheappills.example.org/de/3", "http://123.45/6",
]


def test_parts_and_rules(spark):
    words = spark.createDataFrame([("cheap", 5), ("example", 9), ("a", 3)], "word string, n long")
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)] + [(None, URLS[0]), (3, URLS[3])], PAGES)
    rows = f.judged(pages.withColumn("host", F.lit("clash")), words).collect()
    assert len(rows) == len(URLS) + 2
    for row in rows:
        url = URLS[0] if row.page_id is None else URLS[row.page_id]
        assert (row.host, row.path) == plain_parts(url)
        rule, verdict = plain_rule(row.host, row.path)
        assert row.rule == rule and row.verdict in (("allow", "block") if rule is None else (verdict,))
    by_url = {URLS[r.page_id]: r for r in rows if r.page_id is not None}
    assert by_url["http://m.adult-x.example.org/de/3"].verdict == "block"
    split = by_url["http://cheappills.example.org/de/3"]
    assert split.host_words.split()[:2] == ["cheap", "pills"] and split.verdict == "block"
    assert by_url["http://123.45/6"].verdict == by_url[None].verdict == "allow" and by_url[None].block_share == 0.5


def test_splits_are_the_likeliest(spark):
    counts = {"the": 50, "a": 30, "then": 9, "nice": 12, "ice": 20, "n": 2, "cat": 7, "at": 40, "thenice": 1}
    total = sum(counts.values())
    names = ["thenicecat", "atatat", "zqx", "then", "thenzicecat", "a"]

    def chance(parts):
        return sum(log(counts[p]) - log(total) if p in counts else log(10) * (1 - len(p)) - log(total) for p in parts)

    words = spark.createDataFrame(list(counts.items()), "word string, n long")
    asked = spark.createDataFrame([(n,) for n in [*names, "12345", "b" * 64]], "name string")
    found = {r.name: r.words for r in f.segmented(asked, words).collect()}
    for name in names:
        cuts = [c for k in range(len(name)) for c in combinations(range(1, len(name)), k)]
        options = [[name[i:j] for i, j in zip((0, *c), (*c, len(name)))] for c in cuts]
        assert "".join(found[name]) == name
        assert abs(chance(found[name]) - max(map(chance, options))) < 1e-9
    assert found["12345"] == ["#5"] and found["b" * 64] == ["b" * 64] and len(found) == len(names) + 2


def test_odds_are_naive_bayes():
    counts = np.array([[3.0, 0.0, 1.0, 0.0], [1.0, 2.0, 0.0, 0.0]])
    odds = f.log_odds(counts)
    assert odds[3] == 0
    assert odds[0] == pytest.approx(log((4 / 7) / (2 / 6)))
    assert f.log_odds(np.zeros((2, 4))).tolist() == [0, 0, 0, 0]


def test_query_equals_brute_force(spark, folder):
    """All parts of the query again in plain Python: words, splits, examples, odds."""
    rows = f.op11_host_words(spark, folder).collect()
    pages = table(spark, folder, "pages").select("page_id", "url").collect()
    assert sorted(r.page_id for r in rows) == sorted(p.page_id for p in pages)
    words = {r.word: r.n for r in f.word_counts(table(spark, folder, "documents")).collect()}
    total = sum(words.values())
    words = {**words, **{w: max(words.get(w, 0), 1, round(total * f.SEED_SHARE)) for w in (*f.BLOCK_WORDS, *f.ALLOW_WORDS)}}
    total = sum(words.values())

    def split(name):
        if name.isdigit():
            return [f"#{len(name)}"]
        pieces = {(i, k): words[name[i : i + k]] for i in range(len(name)) for k in range(1, 21) if name[i : i + k] in words}
        return f.split_name(name, pieces, total)

    import re

    runs = re.compile(r"[^\W\d_]+|[0-9]+").findall
    shape = lambda t: f"#{len(t)}" if t.isdigit() else t
    counts = {"block": {}, "allow": {}}
    for verdict, listed in (("block", f.BLOCK_WORDS), ("allow", f.ALLOW_WORDS)):
        for word in listed:
            for token in (f"host:{word}", f"path:{word}"):
                counts[verdict][token] = f.SEEDS / len(listed) / 2
    read = {}
    for page in pages:
        host, path = plain_parts(page.url)
        names, (rule, verdict) = [split(n) for n in runs(host.lower())], plain_rule(host, path)
        read[page.page_id] = names, path
        if rule:
            site, start = next((s, p) for _, s, p in f.RULES if s + p == rule)
            tokens = [f"host:{w}" for n in names[: len(names) - len(runs(site))] for w in n]
            tokens += [f"path:{shape(t)}" for t in runs(path[len(start) :].lower())]
            for token in tokens:
                counts[verdict][token] = counts[verdict].get(token, 0) + 1
    seen = set(counts["block"]) | set(counts["allow"])
    sums = {v: sum(c.values()) for v, c in counts.items()}
    for row in rows:
        names, path = read[row.page_id]
        tokens = [f"host:{w}" for n in names for w in n] + [f"path:{shape(t)}" for t in runs(path.lower())]
        assert row.host_words == " ".join(w for n in names for w in n)
        score = sum(
            log((counts["block"].get(t, 0) + 1) / (sums["block"] + len(seen))) - log((counts["allow"].get(t, 0) + 1) / (sums["allow"] + len(seen)))
            for t in tokens if t in seen
        )
        assert row.block_share == pytest.approx(1 / (1 + exp(-score)), abs=1e-6)
        assert row.rule or row.verdict == ("block" if row.block_share >= f.LEAST_BLOCK else "allow")


def test_hot_host_and_empty_tables(spark):
    words = spark.createDataFrame([("hot", 5)], "word string, n long")
    urls = F.when(F.col("id") < 2000, F.lit("http://hot.example.org/x")).otherwise(F.concat(F.lit("http://h"), F.col("id"), F.lit(".org/")))
    pages = spark.range(3000).select(F.col("id").alias("page_id"), urls.alias("url"))
    assert f.judged(pages, words).groupBy("host").count().agg(F.max("count"), F.count("*")).first()[:] == (2000, 1001)
    assert f.judged(pages.limit(0), words).count() == 0
    assert f.judged(pages.limit(3), words.limit(0)).count() == 3

"""URL filters: rules on host and path, and naive Bayes on words for the urls that no rule decides.

Names in hosts are words run together. A unigram model of the corpus splits them
by Viterbi's search; a multinomial naive Bayes model then weighs the words of the
host and the tokens of the path. Its examples are the urls that a rule decides,
without the parts that the rule itself names, and a list of words for each verdict.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from math import log

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.align import keyed_join
from .common import table
from .mixing import stored

# verdict, host, path; fixed values.
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)
MOST_RULES = 1000
# Words that speak for a verdict. Both lists count as SEEDS tokens, evenly; the segmenter knows them with SEED_SHARE of all words.
BLOCK_WORDS = (
    "adult", "bet", "casino", "cheap", "cialis", "crack", "escort", "gambling", "hentai", "keygen", "loan", "malware",
    "nude", "payday", "phishing", "pills", "poker", "porn", "replica", "sex", "slots", "spam", "torrent", "viagra",
    "warez", "xxx",
)
ALLOW_WORDS = (
    "academy", "archive", "atlas", "dictionary", "docs", "education", "encyclopedia", "government", "history", "hospital",
    "journal", "library", "manual", "museum", "news", "parliament", "recipes", "research", "school", "science",
    "standards", "statistics", "tutorial", "university", "weather", "wiki",
)
SEEDS, SEED_SHARE = 2600, 1e-5
# Letters of the longest word, and of the longest name that is split: no label of a host name is longer.
LONGEST_WORD, LONGEST_NAME = 20, 63
# Tokens are told apart by their hash to so many slots.
SLOTS = 1 << 16
ALPHA = 1.0
# Share of blocking, as the model sees it, from which an undecided url is blocked.
LEAST_BLOCK = 0.9

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path; both empty where the url is null or has no ``://``."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url)))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """rule, verdict, host and path of the longest rule that fits, as a struct, or null.

    A rule fits its host and everything below it, if the path starts with the
    rule's. Of equally long rules the first one wins. At most MOST_RULES rules.
    """
    if len(rules) > MOST_RULES:
        raise ValueError(f"{len(rules)} rules are more than {MOST_RULES}")
    found = F.lit(None)
    for verdict, site, start in sorted(rules, key=lambda r: -len(r[1] + r[2]))[::-1]:
        fits = ((host == site) | host.endswith(f".{site}")) & path.startswith(start)
        names = {"rule": site + start, "verdict": verdict, "host": site, "path": start}
        found = F.when(fits, F.struct(*[F.lit(v).alias(k) for k, v in names.items()])).otherwise(found)
    return found


def name_list(host: Column) -> Column:
    """The runs of letters, and of digits, of a host in order."""
    return F.regexp_extract_all(F.lower(host), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n of all words (runs of letters, lower case) of at most LONGEST_WORD letters in all whole texts."""
    words = docs.select(F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"\p{L}+"), F.lit(0))).alias("word"))
    return words.filter(F.length("word") <= LONGEST_WORD).groupBy("word").agg(F.count(F.lit(1)).alias("n"))


def split_name(name: str, pieces: dict[tuple[int, int], float], total: float) -> list[str]:
    """The likeliest words of a name: ``pieces`` has the counts of the words found by (start, length).

    Any other piece of k letters counts as 10 / 10^k words. Equally likely splits:
    the one with the shorter last piece.
    """
    best, last = [0.0], [0]
    for end in range(1, len(name) + 1):
        options = []
        for size in range(1, min(end, LONGEST_WORD) + 1):
            count = pieces.get((end - size, size))
            rate = log(count) if count else log(10) * (1 - size)
            options.append((best[end - size] + rate - log(total), -size))
        chance, size = max(options)
        best.append(chance)
        last.append(-size)
    words, end = [], len(name)
    while end:
        words.append(name[end - last[end] : end])
        end -= last[end]
    return words[::-1]


def segmented(names: DataFrame, words: DataFrame) -> DataFrame:
    """name, words (array) of each distinct ``name``.

    All pieces of a name meet the word counts in a join, and a name's few pieces
    come together again. Digits are one word that tells their number; names of
    more than LONGEST_NAME letters are one word. Empty names have none.
    """
    total = float(words.agg(F.sum("n")).first()[0] or 1)
    letters = names.filter(F.length("name").between(1, LONGEST_NAME) & ~F.col("name").rlike("^[0-9]"))
    starts = letters.select("name", F.explode(F.sequence(F.lit(1), F.length("name"))).alias("start"))
    sizes = F.sequence(F.lit(1), F.least(F.lit(LONGEST_WORD), F.length("name") - F.col("start") + 1))
    pieces = starts.select("name", "start", F.explode(sizes).alias("size"))
    pieces = pieces.select("name", "start", "size", F.col("name").substr(F.col("start"), F.col("size")).alias("word"))
    met = keyed_join(pieces, words, "word").groupBy("name").agg(F.collect_list(F.struct("start", "size", "n")).alias("pieces"))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [
                split_name(name, {(p["start"] - 1, p["size"]): p["n"] for p in (() if pieces is None else pieces)}, total)
                for name, pieces in zip(batch["name"], batch["pieces"])
            ]
            yield pd.DataFrame({"name": batch["name"], "words": found})

    cut = letters.join(met, "name", "left").mapInPandas(split, "name string, words array<string>")
    whole = F.when(F.col("name").rlike("^[0-9]"), F.concat(F.lit("#"), F.length("name"))).otherwise(F.col("name"))
    rest = names.filter((F.length("name") > LONGEST_NAME) | F.col("name").rlike("^[0-9]"))
    return cut.union(rest.select("name", F.array(whole)))


def host_words(hosts: DataFrame, words: DataFrame) -> DataFrame:
    """host_key, names: for each distinct ``host`` the words of each of its names, in order (null without names)."""
    keyed = hosts.select(F.md5("host").alias("host_key"), "host")
    names = keyed.select("host_key", F.posexplode(name_list(F.col("host"))).alias("at", "name"))
    known = stored(segmented(names.select("name").distinct(), words), "names")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("at", "words"))), lambda x: x["words"])
    return keyed_join(names, known, "name").groupBy("host_key").agg(ordered.alias("names"))


def path_tokens(path: Column) -> Column:
    """Runs of letters of a path in lower case; runs of digits as their number of digits."""
    runs = F.regexp_extract_all(F.lower(path), F.lit(r"\p{L}+|[0-9]+"), F.lit(0))
    return F.transform(runs, lambda t: F.when(t.rlike("^[0-9]"), F.concat(F.lit("#"), F.length(t))).otherwise(t))


def slots(names: Column, path: Column) -> Column:
    """Slots of the host's words and of the path's tokens, which are kept apart."""
    host = F.transform(F.flatten(F.coalesce(names, F.array().cast("array<array<string>>"))), lambda t: F.concat(F.lit("host:"), t))
    tokens = F.concat(host, F.transform(path_tokens(path), lambda t: F.concat(F.lit("path:"), t)))
    return F.transform(tokens, lambda t: F.pmod(F.xxhash64(t), F.lit(SLOTS)).cast("int"))


def log_odds(counts: np.ndarray) -> np.ndarray:
    """Log of blocking against allowing for each slot, from ``counts`` (blocked, allowed) by slot; 0 where both are 0."""
    seen = counts.sum(axis=0) > 0
    chance = (counts + ALPHA) / (counts.sum(axis=1, keepdims=True) + ALPHA * max(int(seen.sum()), 1))
    return np.where(seen, np.log(chance[0]) - np.log(chance[1]), 0.0)


def learned(known: DataFrame, block_words: Sequence[str] = BLOCK_WORDS, allow_words: Sequence[str] = ALLOW_WORDS) -> np.ndarray:
    """Log odds of each slot from rows with verdict and slots, and from the two lists of words.

    Sums merge in the tasks; the driver gets at most two numbers for each slot.
    """
    summed = known.select("verdict", F.explode("slots").alias("slot")).groupBy("verdict", "slot").agg(F.count(F.lit(1)).alias("n"))
    counts = np.zeros((2, SLOTS))
    for row in summed.collect():
        counts[int(row.verdict != "block"), row.slot] = row.n
    for at, words in enumerate((block_words, allow_words)):
        if words:
            named = known.sparkSession.createDataFrame([(w,) for w in words], "word string")
            for row in named.select(F.explode(slots(F.array(F.array("word")), F.col("word"))).alias("slot")).collect():
                counts[at, row.slot] += SEEDS / len(words) / 2
    return log_odds(counts)


def judged(
    pages: DataFrame, words: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
    block_words: Sequence[str] = BLOCK_WORDS, allow_words: Sequence[str] = ALLOW_WORDS, key: str = "page_id",
) -> DataFrame:
    """``key``, host, path, rule, verdict, block_share, host_words of every url.

    The longest rule that fits decides; where none does, ``block_share`` does: the
    model's probability of blocking, both verdicts equally likely beforehand (the
    rules' own shares say nothing about the urls that they leave). A null url, or
    one without ``://``, has an empty host and path and is allowed like any url of
    which the model knows no token. Keys may be null or repeated; every row comes
    out; an empty table gives no rows; other columns are not read. A host may have
    any share of the rows.
    """
    host, path = url_parts(F.col("url"))
    parts = pages.select(F.col(key).alias("id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("host_key", F.md5("host"))
    total = words.agg(F.sum("n")).first()[0] or 1
    named = pages.sparkSession.createDataFrame([(w,) for w in (*block_words, *allow_words)], "word string")
    extra = named.select("word", F.lit(max(1, round(total * SEED_SHARE))).cast("long").alias("n"))
    known_words = stored(words.union(extra).groupBy("word").agg(F.max("n").alias("n")), "words")
    hosts = host_words(stored(parts.select("host").distinct(), "hosts"), known_words)
    rows = keyed_join(parts, stored(hosts, "host-words"), "host_key", "left", spread=F.monotonically_increasing_id())
    rows = stored(rows.withColumn("found", rule_of(F.col("host"), F.col("path"), rules)), "ruled")

    own = F.size("names") - F.size(name_list(F.col("found.host")))
    unnamed = F.when(own > 0, F.slice("names", F.lit(1), F.greatest(own, F.lit(0))))
    rest = F.col("path").substr(F.length("found.path") + 1, F.length("path"))
    examples = rows.filter("found IS NOT NULL").select(F.col("found.verdict").alias("verdict"), slots(unnamed, rest).alias("slots"))
    odds = learned(examples, block_words, allow_words)

    @F.pandas_udf("double")
    def block_share(column: pd.Series) -> pd.Series:
        sums = np.array([odds[np.asarray(s, dtype=np.int64)].sum() for s in column])
        return pd.Series(1 / (1 + np.exp(-np.clip(sums, -700, 700))))

    scored = rows.withColumn("block_share", block_share(slots(F.col("names"), F.col("path"))))
    verdict = F.when(F.col("block_share") >= LEAST_BLOCK, "block").otherwise("allow")
    return scored.select(
        F.col("id").alias(key), "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce("found.verdict", verdict).alias("verdict"), "block_share",
        F.array_join(F.flatten("names"), " ").alias("host_words"),
    )


def op11_host_words(spark: SparkSession, folder: str) -> DataFrame:
    """Verdict on every url of pages; names are split by the words of all documents."""
    words = stored(word_counts(table(spark, folder, "documents")), "word-counts")
    return judged(table(spark, folder, "pages"), words)

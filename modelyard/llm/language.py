"""Language identification by Bayesian fusion of evidence.

The text gives a likelihood per language (letter triples). The declared language
and the address suffix have likelihoods of their own, and the host a prior
smoothed along its address: all sites, domain, sub-domain, host. These come from
grouped sums of what the texts alone say; a page's own part is taken out again.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .mixing import stored
from .toxicity import Memory

# Bounds, for each label, of the rows that the triples are counted in (those with the lowest digests), and of its triples.
FIT_ROWS = 5000
MAX_GRAMS = 30_000
# Neighbouring triples are not independent: their log likelihoods count half.
TEMPER = 0.5
# Share of the even split in a language's estimate of a triple; the class below gives any triple ten times that.
UNSEEN = 0.01
# The class of texts that all triples fit equally badly, and how often it is expected.
NONE, NONE_SHARE = "und", 1e-6
# Weight of the next wider level against a level's own pages, and of an even split against all counts.
STRENGTH, SMOOTH = 5.0, 0.5
LEVELS = ("domain", "site", "host")
# A text is rejected if no language reaches this probability.
LEAST_POSTERIOR = 0.5
SEED = 23

letters = re.compile(r"[^\W\d_]+").findall
_hidden = re.compile(r"(?is)<!--.*?-->|<(script|style|nav|noscript|template)\b.*?</\1\s*>")
_tags = re.compile(r"(?s)<[^>]*>")


def visible_text(page: str) -> str:
    """Text of a page without scripts, styles, navigation, comments and tags."""
    return html.unescape(_tags.sub(" ", _hidden.sub(" ", page)))


def grams(word: str) -> list[str]:
    padded = f" {word} "
    return [padded[i : i + 3] for i in range(len(padded) - 2)]


class TextModel:
    """Log likelihoods of texts in each language, the class NONE last."""

    def __init__(self, languages: list[str], counts: dict[str, list[int]]) -> None:
        self.languages = [*languages, NONE]
        self.counts = {g: np.array(n, dtype=float) for g, n in counts.items()}
        totals = np.maximum(sum(self.counts.values(), np.zeros(len(languages))), 1)
        size = len(counts) + 1
        none = -np.log(10 * size)
        self.rest = np.append(np.full(len(languages), np.log(UNSEEN / size)), none)
        self.rows = {g: np.append(np.log((1 - UNSEEN) * n / totals + UNSEEN / size), none) for g, n in self.counts.items()}

    def scorer(self):
        memory = Memory(lambda word: sum((self.rows.get(g, self.rest) for g in grams(word)), np.zeros(len(self.languages))))

        def score(text: str) -> np.ndarray:
            total = np.zeros(len(self.languages))
            for word, times in Counter(letters(text.lower())).items():
                total += times * memory[word]
            return TEMPER * total

        return score


def text_model(docs: DataFrame, label: str = "lang") -> TextModel:
    """Triple counts of at most FIT_ROWS rows of each label, and the MAX_GRAMS most frequent triples of each.

    Rows with a null text, label or id are left out. A label with many rows is
    first thinned by a hash of the ids to about twice the bound, so no task ranks
    all of its rows. Tasks count; the driver gets the table, bounded for each label.
    """
    known = docs.filter(F.col("text").isNotNull() & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
    known = known.select("doc_id", "text", F.col(label).alias("label"))
    digest = F.md5(F.concat_ws(":", F.lit(str(SEED)), F.col("doc_id").cast("string")))
    sizes = known.groupBy("label").agg(F.count(F.lit(1)).alias("size"))
    parts = 1 << 30
    thin = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc_id")), F.lit(parts)) * F.col("size") < F.lit(2 * FIT_ROWS * parts)
    few = known.select("doc_id", "label").join(F.broadcast(sizes), "label").filter(thin).select("doc_id", "label").distinct()
    place = F.row_number().over(Window.partitionBy("label").orderBy(digest, "doc_id"))
    chosen = few.withColumn("place", place).filter(F.col("place") <= FIT_ROWS).select("doc_id", "label")
    rows = known.join(F.broadcast(chosen), ["doc_id", "label"])

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found: Counter = Counter()
            for text, language in zip(batch["text"], batch["label"]):
                for word, times in Counter(letters(text.lower())).items():
                    for gram in grams(word):
                        found[language, gram] += times
            yield pd.DataFrame([(k, g, n) for (k, g), n in found.items()], columns=["label", "gram", "n"])

    counted = rows.select("text", "label").mapInPandas(count, "label string, gram string, n long")
    summed = counted.groupBy("label", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("label").orderBy(F.desc("n"), "gram"))
    kept = summed.withColumn("rank", rank).filter(F.col("rank") <= MAX_GRAMS).select("gram").distinct()
    found = summed.join(F.broadcast(kept), "gram").collect()
    languages = sorted({r.label for r in found})
    table_ = {r.gram: [0] * len(languages) for r in found}
    for r in found:
        table_[r.gram][languages.index(r.label)] = r.n
    return TextModel(languages, table_)


def address(url: Column) -> dict[str, Column]:
    """host, its last three and two labels, and its last label (null where there is none)."""
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    host = F.when(F.length(host) > 0, host)
    return {
        "host": host,
        "site": F.substring_index(host, ".", -3),
        "domain": F.substring_index(host, ".", -2),
        "suffix": F.when(F.locate(".", host) > 0, F.substring_index(host, ".", -1)),
    }


def declared_language(page: Column) -> Column:
    """Primary language of the lang attribute of the html element, in lower case, or null."""
    found = F.lower(F.regexp_extract(page, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})", 1))
    return F.when(F.length(found) > 0, found)


def _softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def identified(rows: DataFrame, model: TextModel, markup: bool = False) -> DataFrame:
    """id, language, posterior, text_language and the columns of evidence of every row.

    ``rows`` has id, text, declared, suffix, domain, site, host; any may be null,
    which is no evidence. ``markup`` says that texts are web pages. language is
    NONE where no language reaches LEAST_POSTERIOR. A text without letters says
    nothing, so its other evidence decides. Repeated rows are rows of their own,
    an empty table gives no rows, other columns are not read. Joins are on the
    evidence's values; sums merge before they are shuffled, so a host may have
    any share of the rows.
    """
    names = model.languages
    size = len(names)

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        memory = Memory(lambda _: model.scorer())
        for batch in batches:
            score = memory["scorer"]
            texts = [visible_text(t) if markup else t for t in batch["text"]]
            scores = np.array([score(t) for t in texts]).reshape(-1, size)
            priors = np.full(size, (1 - NONE_SHARE) / max(size - 1, 1))
            priors[-1] = NONE_SHARE
            batch["scores"] = list(scores)
            batch["alone"] = list(_softmax(scores + np.log(priors)))
            yield batch.drop(columns="text")

    evidence = ("declared", "suffix", *LEVELS)
    plain = rows.select("id", F.coalesce("text", F.lit("")).alias("text"), *evidence)
    schema = ", ".join(f"{c} {t}" for c, t in plain.dtypes if c != "text")
    base = stored(plain.mapInPandas(read, f"{schema}, scores array<double>, alone array<double>"), "texts-alone")

    def sums(*keys: str) -> DataFrame:
        columns = [F.sum(F.col("alone")[i]) for i in range(size)]
        return base.groupBy(*keys).agg(F.array(*columns).alias("sums"))

    all_rows = sums().first().sums
    overall = np.array([x or 0.0 for x in all_rows])
    joined = base
    for key in evidence:
        side = sums(key).filter(F.col(key).isNotNull()).select(F.col(key).alias(f"{key}_key"), F.col("sums").alias(f"{key}_sums"))
        joined = joined.join(side, F.col(key) == F.col(f"{key}_key"), "left").drop(f"{key}_key")
    kinds = {key: base.agg(F.count_distinct(key)).first()[0] for key in ("declared", "suffix")}

    def fuse(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if not len(batch):
                continue
            own = np.stack(batch["alone"])
            total = np.stack(batch["scores"])
            rest = np.maximum(overall - own, 0)
            prior = (rest + SMOOTH) / (rest + SMOOTH).sum(axis=1, keepdims=True)
            there = {key: batch[f"{key}_sums"].notna().to_numpy() for key in evidence}
            counts = {key: np.zeros_like(own) for key in evidence}
            for key in evidence:
                if there[key].any():
                    counts[key][there[key]] = np.maximum(np.stack(batch.loc[there[key], f"{key}_sums"]) - own[there[key]], 0)
            for key in LEVELS:  # a level without pages of its own passes the wider one on
                prior = (counts[key] + STRENGTH * prior) / (counts[key].sum(axis=1, keepdims=True) + STRENGTH)
            total = total + np.log(prior)
            for key, n in kinds.items():
                likely = np.log((counts[key] + SMOOTH) / (rest + SMOOTH * max(n, 1)))
                total = total + np.where(there[key][:, None], likely, 0)
            posterior = _softmax(total)
            best = posterior.argmax(axis=1)
            sure = posterior[np.arange(len(best)), best]
            alone = own.argmax(axis=1)
            batch["language"] = [names[i] if p >= LEAST_POSTERIOR else NONE for i, p in zip(best, sure)]
            batch["posterior"] = sure
            batch["text_language"] = [names[i] for i in alone]
            yield batch[["id", "language", "posterior", "text_language", *evidence]]

    out = f"id {dict(rows.dtypes)['id']}, language string, posterior double, text_language string, " + ", ".join(f"{c} string" for c in evidence)
    return joined.mapInPandas(fuse, out)


def identified_documents(docs: DataFrame) -> DataFrame:
    """doc_id, language, posterior, text_language of documents: lang counts as declared, source as the host."""
    none = F.lit(None).cast("string")
    rows = docs.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), none.alias("suffix"), none.alias("domain"),
        none.alias("site"), F.col("source").alias("host"),
    )
    found = identified(rows, text_model(docs))
    return found.select(F.col("id").alias("doc_id"), "language", "posterior", "text_language")


def in_some_language(docs: DataFrame) -> DataFrame:
    """The rows that are in some language, in the columns of ``docs``; see ``identified``.

    Rows are numbered by what they hold, so repeated rows share a verdict.
    """
    key = F.md5(F.to_json(F.struct("doc_id", "text", "lang", "source"), {"ignoreNullFields": "false"}))
    rows = docs.select(F.struct(*docs.columns).alias("row"), key.alias("row_key"), "doc_id", "text", "lang", "source")
    model_rows = rows.select(F.col("row_key").alias("doc_id"), "text", "lang", "source")
    none = F.lit(None).cast("string")
    asked = model_rows.select(
        F.col("doc_id").alias("id"), "text", F.col("lang").alias("declared"), none.alias("suffix"), none.alias("domain"),
        none.alias("site"), F.col("source").alias("host"),
    )
    verdicts = identified(asked, text_model(docs)).filter(F.col("language") == NONE).select(F.col("id").alias("row_key"))
    kept = rows.join(verdicts, "row_key", "left_anti")
    return kept.select(*[F.col("row").getField(c).alias(c) for c in docs.columns])


def op4_language_evidence(spark: SparkSession, folder: str) -> DataFrame:
    """Language of every web page from its text, declared language, address suffix and host."""
    pages = table(spark, folder, "pages")
    model = text_model(table(spark, folder, "documents"))
    rows = pages.select(F.col("page_id").alias("id"), F.col("html").alias("text"), declared_language(F.col("html")).alias("declared"), *[c.alias(n) for n, c in address(F.col("url")).items()])
    return identified(rows, model, markup=True).withColumnRenamed("id", "page_id").withColumn("kept", F.col("language") != NONE)

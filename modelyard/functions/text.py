"""Text measures computed inside the row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from modelyard.functions.scalars import bind

# Token pattern, blanks, readability weights, words a sentence needs.
TOKEN = "[a-z0-9]+"
TERM = r"[\p{L}\p{N}_]{2,}"
BLANKS = " \t\r\n"
ARI_CHARS_PER_WORD = 4.71
ARI_WORDS_PER_SENTENCE = 0.5
ARI_BASE = 21.43
SENTENCE_WORDS = 3

LETTER = r"\p{L}\p{N}"
# A run of non-blanks from its first letter or digit on.
WORD = rf"[{LETTER}][^{BLANKS}]*+"
# From a sentence ender or the start of the text, as many words before the next ender.
SENTENCE = rf"(?<![^.!?])(?:[^.!?{LETTER}]*+[{LETTER}][^.!?{BLANKS}]*+){{{SENTENCE_WORDS}}}"


def tokens(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def terms(text: Column) -> Column:
    """Runs of two or more letters, digits or underscores, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(TERM), F.lit(0))


def bigrams(text: Column) -> Column:
    return bind(
        tokens(text),
        lambda t: F.when(
            F.size(t) > 1,
            F.zip_with(
                F.slice(t, F.lit(1), F.size(t) - 1),
                F.slice(t, F.lit(2), F.size(t) - 1),
                lambda a, b: F.concat_ws(" ", a, b),
            ),
        ).otherwise(F.array().cast("array<string>")),
    )


def numbered(items: Column) -> Column:
    """Each element with its occurrence number, so that a set operation on the
    results acts on multisets. Sorting puts equal elements side by side; an
    element's number is its distance from where its run starts."""

    def by_runs(s: Column, starts: Column) -> Column:
        runs = F.zip_with(
            starts,
            F.concat(F.slice(starts, F.lit(2), F.size(starts)), F.array(F.size(s))),
            lambda a, b: F.struct(a.alias("at"), (b - a).alias("n")),
        )
        return F.flatten(
            F.transform(
                runs,
                lambda r: F.transform(
                    F.sequence(F.lit(1), r["n"]),
                    lambda k: F.concat_ws("#", F.get(s, r["at"]), k.cast("string")),
                ),
            )
        )

    def from_sorted(s: Column) -> Column:
        starts = F.filter(
            F.transform(s, lambda x, i: F.when((i == 0) | (F.get(s, i - 1) != x), i)), lambda i: i.isNotNull()
        )
        return bind(starts, lambda found: by_runs(s, found))

    return bind(
        F.array_sort(items),
        lambda s: F.when(F.size(s) > 0, from_sorted(s)).otherwise(F.array().cast("array<string>")),
    )


def rouge2(response: Column, target: Column) -> Column:
    """F1 of the bigram multiset overlap; 0 when either side has no bigram."""

    def score(pair: Column) -> Column:
        hits = F.size(F.array_intersect(numbered(pair["r"]), numbered(pair["t"])))
        total = F.size(pair["r"]) + F.size(pair["t"])
        return F.when(total > 0, 2.0 * hits / total).otherwise(F.lit(0.0))

    return bind(F.struct(bigrams(response).alias("r"), bigrams(target).alias("t")), score)


def word_count(text: Column) -> Column:
    """Blank-separated pieces holding at least one letter or digit."""
    return F.regexp_count(text, F.lit(WORD))


def sentence_count(text: Column) -> Column:
    """Pieces between sentence enders with three words or more; at least 1."""
    return F.greatest(F.regexp_count(text, F.lit(SENTENCE)), F.lit(1))


def character_count(text: Column) -> Column:
    """Characters other than blanks; plain replacement is the cheapest way to drop them."""
    for blank in BLANKS:
        text = F.replace(text, F.lit(blank), F.lit(""))
    return F.length(text)


def ari_grade(text: Column) -> Column:
    """Automated readability index from non-blank characters, words and sentences."""
    counts = F.struct(
        character_count(text).alias("chars"), word_count(text).alias("words"), sentence_count(text).alias("sentences")
    )
    return bind(
        counts,
        lambda c: F.when(
            c["words"] > 0,
            ARI_CHARS_PER_WORD * c["chars"] / c["words"]
            + ARI_WORDS_PER_SENTENCE * c["words"] / c["sentences"]
            - ARI_BASE,
        ),
    )

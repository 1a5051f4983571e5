"""Quality rules, line by line first: lines that fail go, then documents that lost too much."""

from __future__ import annotations

import re
from collections import Counter

from pyspark.sql import DataFrame, SparkSession

from .common import WORD, per_text, table

MIN_WORDS = 50
# Percent of the words that may stand in repeated windows, and that the line rules may remove.
MAX_REPEATED = 50
MAX_LOST = 50
WINDOW = 3
# A line is navigation if a fifth of its words are separators, noise if a tenth of its word
# characters are symbols, stutter if a third of its words equal the word before.
SEPARATOR_SHARE, SYMBOL_SHARE, STUTTER_SHARE = 5, 10, 3
SEPARATORS = ("|", "»", "›", "•", "·", "/", ">", "::", "-")
SYMBOLS = "#*$%&|<>"
END_MARK = r"""[.!?…:;。！？]["'”’»)\]]*$"""
# Phrases of page furniture, looked for in lower case.
FURNITURE = (
    r"(all rights reserved|terms of (use|service)|privacy policy|cookie policy|accept (all )?cookies|enable javascript"
    r"|click here|read more|sign (in|up)|log ?in|subscribe (now|to)|share this|back to top|lorem ipsum|skip to content)"
)
# Longer lines are prose, also if they name such a phrase or break off without an end mark.
SHORT_LINE = 30

words_of = re.compile(WORD).findall
ends_well = re.compile(END_MARK).search
is_furniture = re.compile(FURNITURE).search


def line_failure(line: str, words: list[str]) -> str | None:
    """The rule that a line with words fails, or None."""
    n = len(words)
    if SEPARATOR_SHARE * sum(words.count(s) for s in SEPARATORS) >= n:
        return "navigation"
    if n <= SHORT_LINE and is_furniture(line.lower()):
        return "boilerplate"
    if n > 1 and STUTTER_SHARE * sum(a == b for a, b in zip(words, words[1:])) >= n:
        return "boilerplate"
    if SYMBOL_SHARE * sum(line.count(s) for s in SYMBOLS) >= sum(map(len, words)):
        return "punctuation"
    if n <= SHORT_LINE and not ends_well(words[-1]):
        return "punctuation"
    return None


def measure(text: str) -> tuple:
    """Counts, verdict and cleaned text of one document."""
    words = words_of(text)
    n = len(words)
    windows = list(zip(*(words[i:] for i in range(WINDOW))))
    repeated = 0
    if len(set(windows)) < len(windows):
        times, reach = Counter(windows), 0
        for at, window in enumerate(windows):
            if times[window] > 1:
                repeated += at + WINDOW - max(at, reach)
                reach = at + WINDOW
    lines = [(line, found) for line in text.split("\n") if (found := words_of(line))]
    failures = [line_failure(line, found) for line, found in lines]
    lost = sum(len(found) for (_, found), failure in zip(lines, failures) if failure)
    base_failed = n < MIN_WORDS or 100 * repeated > MAX_REPEATED * n
    kept = not base_failed and 100 * lost <= MAX_LOST * n
    return (
        n,
        sum(map(len, words)),
        sum(text.count(s) for s in SYMBOLS),
        len(lines) - len({line for line, _ in lines}),
        repeated,
        base_failed,
        kept,
        lost,
        *(failures.count(rule) for rule in ("navigation", "boilerplate", "punctuation")),
        "\n".join(line for (line, _), failure in zip(lines, failures) if not failure),
    )


COUNTS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, kept boolean, "
    "lost_words long, n_navigation long, n_boilerplate long, n_punctuation long"
)


def line_cleaned(docs: DataFrame) -> DataFrame:
    """doc_id, the counts, the verdict and ``clean_text``, the lines that pass, of every row.

    A line without a word counts nowhere and goes. A null text reads as empty: no
    words, base_failed. Repeated rows and null doc_ids come out as they are, an
    empty table gives no rows, other columns are not read. No shuffle.
    """
    return per_text(docs, measure, f"{COUNTS}, clean_text string")


def op5_line_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Counts and verdicts of all documents."""
    return line_cleaned(table(spark, folder, "documents")).drop("clean_text")


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_WORDS = _quoted(r"[^\x20\x09-\x0D]+")
_SYMBOL_COUNT = "len(regexp_replace({0}, '[^#*$%&|<>]', '', 'g'))"
OP5_SQL = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), {_WORDS}) AS words
  FROM documents
), u AS (
  SELECT r, unnest(words) AS word, generate_subscripts(words, 1) AS p FROM d
), w AS (
  SELECT r, p, list_value(word, {", ".join(f"lead(word, {i}) OVER q" for i in range(1, WINDOW))}) AS win,
    lead(word, {WINDOW - 1}) OVER q IS NOT NULL AS whole
  FROM u WINDOW q AS (PARTITION BY r ORDER BY p)
), t AS (
  SELECT r, p, count(*) OVER (PARTITION BY r, win) AS n FROM w WHERE whole
), rep AS (
  SELECT r, count(DISTINCT p + i) AS n_repeat_words FROM t, range({WINDOW}) AS s(i) WHERE n > 1 GROUP BY r
), l AS (
  SELECT r, line, regexp_extract_all(line, {_WORDS}) AS lw FROM (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d)
), v AS (
  SELECT r, line, len(lw) AS n,
    {SEPARATOR_SHARE} * len([x FOR x IN lw IF x IN ({", ".join(map(_quoted, SEPARATORS))})]) >= len(lw) AS nav,
    (len(lw) <= {SHORT_LINE} AND regexp_matches(lower(line), {_quoted(FURNITURE)}))
      OR (len(lw) > 1 AND {STUTTER_SHARE} * len([i FOR i IN range(2, len(lw) + 1) IF lw[i] = lw[i - 1]]) >= len(lw)) AS boiler,
    {SYMBOL_SHARE} * {_SYMBOL_COUNT.format("line")} >= len(array_to_string(lw, ''))
      OR (len(lw) <= {SHORT_LINE} AND NOT regexp_matches(lw[-1], {_quoted(END_MARK)})) AS punct
  FROM l WHERE len(lw) > 0
), s AS (
  SELECT r, count(*) - count(DISTINCT line) AS n_dup_lines, coalesce(sum(n) FILTER (nav OR boiler OR punct), 0) AS lost_words,
    count(*) FILTER (nav) AS n_navigation, count(*) FILTER (boiler AND NOT nav) AS n_boilerplate,
    count(*) FILTER (punct AND NOT boiler AND NOT nav) AS n_punctuation
  FROM v GROUP BY r
), x AS (
  SELECT doc_id, len(words) AS n_words, len(array_to_string(words, '')) AS word_chars, {_SYMBOL_COUNT.format("text")} AS n_symbols,
    coalesce(n_dup_lines, 0) AS n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words,
    coalesce(lost_words, 0) AS lost_words, coalesce(n_navigation, 0) AS n_navigation,
    coalesce(n_boilerplate, 0) AS n_boilerplate, coalesce(n_punctuation, 0) AS n_punctuation
  FROM d LEFT JOIN rep USING (r) LEFT JOIN s USING (r)
)
SELECT doc_id, n_words::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
  n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words,
  n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words AS base_failed,
  NOT (n_words < {MIN_WORDS} OR 100 * n_repeat_words > {MAX_REPEATED} * n_words) AND 100 * lost_words <= {MAX_LOST} * n_words AS kept,
  lost_words::BIGINT AS lost_words, n_navigation::BIGINT AS n_navigation, n_boilerplate::BIGINT AS n_boilerplate,
  n_punctuation::BIGINT AS n_punctuation
FROM x
"""

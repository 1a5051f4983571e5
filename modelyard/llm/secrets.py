"""Secret scans: one minimal automaton of all rules reads each text once."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .automaton import scanner
from .common import per_text, table

# Kinds in order, each with its expression. Least lengths are checked on the spans, where that is
# the same: counted in the automaton they would multiply its states. Only "hex" counts there, as
# nearly every word holds a shorter run.
RULES = {
    "assign": r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?[A-Za-z0-9+/_.=-]+""",
    "access": r"AKIA[A-Z0-9]+",
    "hex": r"[0-9a-f]{16,}",
    "github": r"gh[oprsu]_[A-Za-z0-9]+",
    "chat": r"xox[abprs]-[0-9A-Za-z-]+",
    "web_token": r"eyJ[A-Za-z0-9_-]+\.eyJ[A-Za-z0-9_-]+",
    "private_key": r"-----BEGIN (RSA |EC |DSA |OPENSSH )?PRIVATE KEY-----",
}
LEAST = {"access": 18, "github": 24, "chat": 15}
BASE = ("assign", "access", "hex")
KINDS = tuple(RULES)
LEAST_VALUE = 12


def _long_value(data: bytes, start: int, end: int) -> bool:
    """Whether the value of an assignment has LEAST_VALUE characters.

    A separator "=" is also a character of values, so the value starts behind
    the first separator, blanks and quote, not at the start of the last run.
    """
    at = start
    while data[at] not in b":=":
        at += 1
    at += 1
    while data[at] == 0x20:
        at += 1
    if data[at] in b"\"'":
        at += 1
    return end - at >= LEAST_VALUE


@lru_cache(1)
def make_finder():
    """Function from a text to its spans (start, kind, end) in code points, by start, then kind."""
    scan = scanner(list(RULES.values()))
    least = [LEAST.get(kind, 0) for kind in KINDS]

    def find(text: str) -> list[tuple[int, int, int]]:
        data = text.encode("utf-8", "surrogatepass")
        spans = [(s, k, e) for k, s, e in scan(data) if e - s >= least[k] and (k or _long_value(data, s, e))]
        if spans and len(data) != len(text):
            spans = [(s, k, e) for s, k, e in zip(*_points(data, spans))]
        return sorted(spans)

    return find


def _points(data: bytes, spans):
    """Byte places to code points: each place counts the bytes before it that start a character."""
    places = sorted({p for s, _, e in spans for p in (s, e)})
    point, count, last = {}, 0, 0
    for place in places:
        count += sum(byte & 0xC0 != 0x80 for byte in data[last:place])
        point[place], last = count, place
    return [point[s] for s, _, _ in spans], [k for _, k, _ in spans], [point[e] for _, _, e in spans]


def _joined(spans) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


def secret_spans(docs: DataFrame) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> of every row, by start, then kind.

    Spans are code points, end exclusive, leftmost and longest, and do not
    overlap within a kind. A null or empty text has no spans; repeated rows and
    rows with a null id come out once each; an empty table gives no rows. Other
    columns are not read. No shuffle; a task holds one batch of texts.
    """

    find = make_finder()  # compiled here once; its tables go to the tasks
    return per_text(
        docs,
        lambda text: ([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in find(text)],),
        "spans array<struct<kind:string,start:bigint,end:bigint>>",
    )


def redacted(docs: DataFrame) -> DataFrame:
    """The same rows and columns with each secret replaced by its kind in angle brackets.

    Overlapping spans become one, named by the first. A null text stays null,
    n_chars (where there is such a column) follows the new text.
    """
    columns, find = docs.columns, make_finder()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            batch["text"] = [None if text is None else clean(text, find(text)) for text in batch["text"]]
            yield batch

    def clean(text: str, spans) -> str:
        parts, last = [], 0
        for start, kind, end in spans:
            if start >= last:
                parts += [text[last:start], f"<{KINDS[kind]}>"]
            last = max(last, end)
        return "".join(parts) + text[last:] if parts else text

    out = docs.mapInPandas(run, docs.schema)
    if "n_chars" in columns:
        counted = F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text"))
        out = out.withColumn("n_chars", counted.cast(docs.schema["n_chars"].dataType))
    return out


def op10_secret_spans(spark: SparkSession, folder: str) -> DataFrame:
    """Secrets of all documents: counts by kind, a digest of the base spans, all spans."""

    find = make_finder()

    def digest(text: str):
        spans = find(text)
        counts = [sum(k == b for _, k, _ in spans) for b in range(len(BASE))]
        base = _joined([x for x in spans if x[1] < len(BASE)])
        return (*counts, hashlib.sha256(base.encode()).hexdigest(), _joined(spans))

    schema = "n_assign long, n_access long, n_hex long, base_sha256 string, spans string"
    return per_text(table(spark, folder, "documents"), digest, schema)

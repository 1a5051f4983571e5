"""Language-model scores by deleted interpolation.

The probability of a word behind another mixes the bigram and the unigram
maximum-likelihood estimates with a uniform one. The weights depend on how often
the context was seen (buckets of powers of two) and are learned by
expectation-maximisation on a part of the training texts that the counts of that
step leave out.

Documents are dealt into blocks of a few MB. A block asks for the counts of its
distinct n-grams, packed by ranges of their hashes; each range adds up what the
blocks bring and answers every block; blocks then score their texts. A frequent
n-gram takes one entry per block, whatever its count.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import id_remainder, table
from .mixing import n_words, stored
from .near import G, U, WordNumbers, mixed_bits

BLOCK_CHARS = 4_000_000
# Ranges of hashes for each block of texts; a range adds up about a million entries.
RANGES_PER_BLOCK = 2
# Of the training texts, every so many'th teaches the weights.
FOLD = 20
ROUNDS = 15
# Each weight starts its sum with this many observations, so that none becomes 0.
PRIOR = 0.5
MAX_BUCKETS = 64
END = xxhash.xxh64_intdigest(b"\n")  # no word holds a line break
HELD_OUT, REST, LEARN = 0, 1, 2

REQUEST = "bucket long, block long, size int, keys binary, rest binary, whole binary"
ANSWER = "block long, bucket long, size int, rest binary, whole binary, types long, tokens long"


def packed(numbers: np.ndarray) -> bytes:
    """64-bit numbers by byte planes: high bytes of small numbers make long runs of zeros."""
    return np.ascontiguousarray(numbers.astype("<u8").view(np.uint8).reshape(-1, 8).T).tobytes()


def unpacked(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, dtype=np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def range_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """The range of each key, by its upper half; fewer than 2^32 ranges of about equal width."""
    return ((keys >> U(32)) * U(buckets) >> U(32)).astype(np.int64)


class NGrams:
    """The tokens of several texts: words in lower case (A-Z), and an end behind each text."""

    def __init__(self, texts: list[str]) -> None:
        numbers, flat, self.lengths = WordNumbers(), [], np.empty(len(texts), dtype=np.int64)
        lookup = numbers.__getitem__
        for i, text in enumerate(texts):
            # bytes.lower changes A-Z alone, bytes.split cuts at ASCII white space alone.
            words = text.encode("utf-8", "surrogatepass").lower().split()
            self.lengths[i] = len(words) + 1
            flat += map(lookup, words)
            flat.append(END)
        tokens = np.array(flat, dtype=U)
        self.owner = np.repeat(np.arange(len(texts)), self.lengths)
        before = np.concatenate([np.array([END], dtype=U), tokens[:-1]])  # texts end as they begin: with an end
        self.keys, self.place = {}, {}
        for size, values in ((1, tokens), (2, mixed_bits(before * G + tokens))):
            codes, keys = pd.factorize(values)
            order = np.argsort(keys)
            rank = np.empty(len(keys), dtype=np.int64)
            rank[order] = np.arange(len(keys))
            self.keys[size], self.place[size] = keys[order], rank[codes]
        end = np.searchsorted(self.keys[1], U(END)) if len(tokens) else 0
        self.context = np.concatenate([[end], self.place[1][:-1]]).astype(np.int64)[: len(tokens)]


def _requests(buckets: int):
    def run(frame: pd.DataFrame) -> pd.DataFrame:
        grams = NGrams(frame["text"].tolist())
        part = frame["part"].to_numpy()[grams.owner]
        out = []
        for size in (1, 2):
            keys, place = grams.keys[size], grams.place[size]
            rest = np.bincount(place[part == REST], minlength=len(keys))
            whole = rest + np.bincount(place[part == LEARN], minlength=len(keys))
            of = range_of(keys, buckets)
            starts = np.flatnonzero(np.diff(of, prepend=-1))
            for start, end in zip(starts, np.append(starts[1:], len(keys))):
                bucket, cut = of[start], slice(start, end)
                steps = np.diff(keys[cut], prepend=U(0))
                out.append((bucket, frame["block"].iloc[0], size, packed(steps), packed(rest[cut]), packed(whole[cut])))
        return pd.DataFrame(out, columns=["bucket", "block", "size", "keys", "rest", "whole"])

    return run


def _answers(frame: pd.DataFrame) -> pd.DataFrame:
    out = []
    for size, rows in frame.groupby("size"):
        keys = [np.cumsum(unpacked(x), dtype=U) for x in rows["keys"]]
        codes, distinct = pd.factorize(np.concatenate(keys))
        sums = {}
        for name in ("rest", "whole"):
            counts = np.concatenate([unpacked(x) for x in rows[name]]).astype(float)
            sums[name] = np.bincount(codes, counts, minlength=len(distinct)).astype(np.int64)
        types, tokens = int((sums["whole"] > 0).sum()), int(sums["whole"].sum())
        at = 0
        for block, bucket, own in zip(rows["block"], rows["bucket"], keys):
            mine = codes[at : at + len(own)]
            out.append((block, bucket, size, packed(sums["rest"][mine]), packed(sums["whole"][mine]), types, tokens))
            at += len(own)
            types = tokens = 0  # once for each range
    return pd.DataFrame(out, columns=["block", "bucket", "size", "rest", "whole", "types", "tokens"])


def _counts(grams: NGrams, answers: pd.DataFrame, name: str):
    """Counts of each token, its context and both together, from a block's answers."""
    answers = answers.sort_values("bucket")
    found = {size: np.concatenate([unpacked(x) for x in answers.loc[answers["size"] == size, name]]).astype(float) for size in (1, 2)}
    return found[1][grams.place[1]], found[1][grams.context], found[2][grams.place[2]]


def context_bucket(count: np.ndarray) -> np.ndarray:
    """0 for contexts never seen, else 1 + the whole part of the binary logarithm."""
    return np.where(count > 0, np.frexp(count)[1], 0).astype(np.int64)


def estimates(word: np.ndarray, context: np.ndarray, both: np.ndarray, tokens: int, types: int):
    """Bigram, unigram and uniform estimates; an unseen context has no bigram estimate, no text at all no unigram one."""
    uniform = 1.0 / (types + 1)
    one = word / tokens if tokens else np.full(len(word), uniform)
    return np.where(context > 0, both / np.maximum(context, 1), 0.0), one, np.full(len(word), uniform)


def learned_weights(events: DataFrame) -> np.ndarray:
    """Weights by bucket from (bucket, p2, p1, p0, n): ROUNDS of expectation-maximisation.

    A round is one pass over the events and brings three sums for each bucket to
    the driver. Buckets without events keep equal weights.
    """
    start = np.full((MAX_BUCKETS, 3), 1 / 3)
    start[0] = 0, 0.5, 0.5
    weights, prior = start, np.where(start > 0, PRIOR, 0)
    for _ in range(ROUNDS):
        shares = []
        for k in range(3):
            weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights[:, k]]), F.col("bucket") + 1)
            shares.append(weight * F.col(f"p{2 - k}"))
        total = shares[0] + shares[1] + shares[2]
        sums = events.groupBy("bucket").agg(*[F.sum(F.col("n") * s / total).alias(f"s{k}") for k, s in enumerate(shares)]).collect()
        got = prior.copy()
        for r in sums:
            got[r.bucket] += [r.s0, r.s1, r.s2]
        weights = got / got.sum(axis=1, keepdims=True)
    return weights


def interpolated_scores(docs: DataFrame, training, salt: str = "doc_id") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row.

    ``training`` is a condition: the rows that the model learns from. Texts are
    whole, a null text reads as empty (one token, the end). Repeated rows are rows
    of their own, in learning too; null doc_ids come out as they are; an empty
    table gives no rows; other columns are not read.
    """
    fold = F.floor(id_remainder(7 * FOLD, salt) / 7) == 0
    part = F.when(training, F.when(fold, F.lit(LEARN)).otherwise(F.lit(REST))).otherwise(F.lit(HELD_OUT))
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), part.alias("part"))
    chars = rows.agg(F.sum(F.length("text") + 1)).first()[0] or 0
    blocks = int(chars // BLOCK_CHARS) + 1
    # Texts that teach the weights have blocks of their own, so that those are all that the learning reads again.
    learning = -(-blocks // FOLD)
    spread = F.xxhash64("doc_id", "text")
    block = F.when(F.col("part") == LEARN, -1 - F.pmod(spread, F.lit(learning))).otherwise(F.pmod(spread, F.lit(blocks)))
    rows = rows.withColumn("block", block)
    buckets = RANGES_PER_BLOCK * blocks
    requests = rows.groupBy("block").applyInPandas(_requests(buckets), REQUEST)
    answers = stored(requests.groupBy("bucket").applyInPandas(_answers, ANSWER), "ngram-counts")
    total = answers.filter("size = 1").agg(F.sum("types"), F.sum("tokens")).first()
    types, tokens = int(total[0] or 0), int(total[1] or 0)

    def events(texts: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        grams = NGrams(texts["text"].tolist())
        word, context, both = _counts(grams, given, "rest")
        frame = pd.DataFrame({"word": word, "context": context, "both": both})
        frame = frame.groupby(["word", "context", "both"], as_index=False).size()
        p2, p1, p0 = estimates(*(frame[c].to_numpy() for c in ("word", "context", "both")), rest_tokens, types)
        return pd.DataFrame({"bucket": context_bucket(frame["context"].to_numpy()), "p2": p2, "p1": p1, "p0": p0, "n": frame["size"]})

    kept = answers.select("block", "bucket", "size", "rest", "whole")
    learn_rows = rows.filter(F.col("part") == LEARN)
    rest_tokens = tokens - int(learn_rows.select(F.sum(n_words(F.col("text")) + 1)).first()[0] or 0)
    learn_answers = kept.filter("block < 0").drop("whole")
    found = learn_rows.groupBy("block").cogroup(learn_answers.groupBy("block"))
    weights = learned_weights(stored(found.applyInPandas(events, "bucket int, p2 double, p1 double, p0 double, n long"), "events"))

    def score(texts: pd.DataFrame, given: pd.DataFrame) -> pd.DataFrame:
        grams = NGrams(texts["text"].tolist())
        word, context, both = _counts(grams, given, "whole")
        mix = weights[context_bucket(context)]
        mixed = sum(mix[:, k] * p for k, p in enumerate(estimates(word, context, both, tokens, types)))
        n = len(texts)
        return pd.DataFrame(
            {
                "doc_id": texts["doc_id"],
                "held_out": texts["part"] == HELD_OUT,
                "n_tokens": grams.lengths,
                "n_known": np.bincount(grams.owner, word > 0, minlength=n).astype(np.int64),
                "train_tokens": tokens,
                "base_score": np.bincount(grams.owner, np.log10((word + 1) / (tokens + types + 1)), minlength=n),
                "score": np.bincount(grams.owner, np.log10(mixed), minlength=n),
            }
        )

    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"
    return rows.groupBy("block").cogroup(kept.drop("rest").groupBy("block")).applyInPandas(score, schema)


def op1_deleted_interpolation(spark: SparkSession, folder: str) -> DataFrame:
    """Scores of all documents; those whose id leaves remainder 2 modulo 7 teach nothing."""
    return interpolated_scores(table(spark, folder, "documents"), id_remainder(7) != 2)

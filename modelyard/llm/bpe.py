"""Byte-pair encoding with forced boundaries, and decoding.

A pair of neighbouring bytes that stands inside no vocabulary token can never
be inside a token of an encoding, so the text may be cut there: the fragments
are merged on their own and their ids joined. Cuts come on top of those the
vocabulary's own text pattern makes.
"""

from __future__ import annotations

import hashlib
import heapq
import json
from array import array
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StructField, StructType

from .common import all_texts, table

# How vocabularies of this kind split a text first. A fixed value.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Pieces whose ids a task remembers; the half that was not used lately goes first.
REMEMBERED = 200_000
# Where token ids go out as arrays, a task remembers fewer and hands over so many rows at a time.
REMEMBERED_WITH_IDS, ROWS_AT_ONCE = 50_000, 250
# Letters of texts that are cut into pieces at once.
LETTERS_AT_ONCE = 1 << 20
# Letters of a piece that is remembered, and symbols up to which fragments are merged side by side.
SHORT, SIDE_BY_SIDE = 32, 128
# Fragments that are merged side by side at once.
FRAGMENTS_AT_ONCE = 1 << 15


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def _byte_letters() -> dict[str, int]:
    """The letter that stands for each byte in vocabulary files: itself if printable, else from 256 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """Encoder and decoder for a byte-level vocabulary file."""

    def __init__(self, spec: str, remembered: int = REMEMBERED) -> None:
        self.remembered = remembered
        data = json.loads(spec)
        model, letters = data["model"], _byte_letters()
        vocabulary = model["vocab"]
        self.special = {x["content"]: x["id"] for x in data["added_tokens"]}
        raw = {i: bytes(letters[c] for c in token) for token, i in vocabulary.items() if token not in self.special}
        raw |= {i: token.encode() for token, i in self.special.items()}
        self.byte_ids = {raw[i][0]: i for t, i in vocabulary.items() if t not in self.special and len(raw[i]) == 1}
        pairs = (m.split(" ") if isinstance(m, str) else m for m in model["merges"])
        rules = [(vocabulary[a], vocabulary[b], vocabulary[a + b]) for a, b in pairs]
        self.ranks = {(a, b): rank for rank, (a, b, _) in enumerate(rules)}
        self.joined = [new for _, _, new in rules]
        self.none = len(rules)
        size = max(vocabulary.values()) + 1
        keys = np.array([a * size + b for a, b, _ in rules], dtype=np.int64).reshape(-1)
        self.order = np.argsort(keys).astype(np.int32)
        self.pair_keys, self.radix = np.append(keys[self.order], np.iinfo(np.int64).max), size
        self.order = np.append(self.order, np.int32(self.none))
        self.joined_ids = np.append(np.array(self.joined, dtype=np.int32), np.int32(-1))
        self.byte_id = np.array([self.byte_ids[b] for b in range(256)], dtype=np.int32)
        # Byte pairs inside some token; all others are cuts.
        self.inside = np.zeros(1 << 16, dtype=bool)
        for token in raw.values():
            for a, b in zip(token, token[1:]):
                self.inside[a << 8 | b] = True
        size = max(raw) + 1
        self.lengths = np.array([len(raw.get(i, b"")) for i in range(size)])
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.letters = np.frombuffer(b"".join(raw.get(i, b"") for i in range(size)), dtype=np.uint8)
        self.pieces = regex.compile(PATTERN).findall
        names = sorted(self.special, key=len, reverse=True)
        self.cut_special = regex.compile("(" + "|".join(map(regex.escape, names)) + ")").split if names else None
        # Packed ids, and ids as text, of pieces; in two halves by age.
        self.ids: dict[str, bytes] = {}
        self.numbers: dict[str, str] = {}
        self.older: tuple[dict[str, bytes], dict[str, str]] = {}, {}

    def cuts(self, data: np.ndarray) -> np.ndarray:
        """Whether a token can never reach from each byte to the next one."""
        return ~self.inside[data[:-1].astype(np.int32) << 8 | data[1:]]

    def fragments(self, piece: bytes) -> list[bytes]:
        ends = [0, *(np.flatnonzero(self.cuts(np.frombuffer(piece, dtype=np.uint8))) + 1).tolist(), len(piece)]
        return [piece[a:b] for a, b in zip(ends, ends[1:])]

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of the rule that joins each pair of ids, ``none`` where there is none; -1 is no id."""
        keys = left.astype(np.int64) * self.radix + right
        at = np.searchsorted(self.pair_keys, keys)
        return np.where((self.pair_keys[at] == keys) & (left >= 0) & (right >= 0), self.order[at], self.none)

    def merged_rows(self, ids: np.ndarray) -> np.ndarray:
        """Rows of ids, filled up with -1, after all merges: each turn joins the pair of lowest rank, the leftmost first, of every row."""
        out, rows = ids.copy(), np.arange(len(ids))
        ranks, columns = self.ranks_of(ids[:, :-1], ids[:, 1:]), np.arange(ids.shape[1])
        while len(rows):
            at = ranks.argmin(axis=1)
            lowest = ranks[np.arange(len(rows)), at]
            live = lowest < self.none
            if not live.all():
                out[rows[~live]] = ids[~live]
                rows, ids, ranks, at, lowest = rows[live], ids[live], ranks[live], at[live], lowest[live]
                if not len(rows):
                    break
            line = np.arange(len(rows))
            shift = np.minimum(columns + (columns > at[:, None]), ids.shape[1] - 1)
            full = ids[:, -1] >= 0
            ids = np.take_along_axis(ids, shift, axis=1)
            ids[line, at] = self.joined_ids[lowest]
            ids[full, -1] = -1
            # The rank of the pair (c, c + 1) stands in column c.
            last = ranks[:, -1].copy()
            ranks = np.take_along_axis(ranks, np.minimum(shift[:, :-1], ranks.shape[1] - 1), axis=1)
            ranks[:, -1] = np.where(at == ranks.shape[1], last, self.none)
            here, after = ids[line, at], ids[line, np.minimum(at + 1, ids.shape[1] - 1)]
            ranks[line, at] = np.where(at + 1 < ids.shape[1], self.ranks_of(here, after), self.none)
            inner = at > 0
            ranks[line[inner], at[inner] - 1] = self.ranks_of(ids[line[inner], at[inner] - 1], here[inner])
        return out

    def merged_all(self, data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all fragments of ``data`` one behind the other, and their number for each fragment, which stops before its ``ends``."""
        starts = np.concatenate([[0], ends[:-1]])
        lengths, ids, keep = ends - starts, self.byte_id[data], np.ones(len(data), dtype=bool)
        least, width = 1, 2
        while width <= SIDE_BY_SIDE:
            group = np.flatnonzero((lengths > least) & (lengths <= width))
            for part in (group[i : i + FRAGMENTS_AT_ONCE] for i in range(0, len(group), FRAGMENTS_AT_ONCE)):
                places = starts[part, None] + np.arange(width)
                there = np.arange(width) < lengths[part, None]
                rows = np.where(there, ids[np.minimum(places, len(ids) - 1)], -1).astype(np.int32)
                found = self.merged_rows(rows)
                ids[places[there]], keep[places[there]] = found[there], (found >= 0)[there]
            least, width = width, width * 2
        for i in np.flatnonzero(lengths > SIDE_BY_SIDE):
            found = self._merged_long(ids[starts[i] : ends[i]].tolist())
            ids[starts[i] : starts[i] + len(found)] = found
            keep[starts[i] + len(found) : ends[i]] = False
        return ids[keep], np.add.reduceat(keep, starts) if len(starts) else np.zeros(0, dtype=int)

    def merged(self, fragment: bytes) -> list[int]:
        """Ids of a fragment: the pair of lowest rank, leftmost first, is joined until none is left."""
        return self.merged_all(np.frombuffer(fragment, dtype=np.uint8), np.array([len(fragment)]))[0].tolist()

    def _merged_long(self, ids: list[int]) -> list[int]:
        n = len(ids)
        after, before = [*range(1, n), -1], [*range(-1, n - 1)]
        heap = []

        def offer(at: int) -> None:
            if at >= 0 and after[at] >= 0 and (rank := self.ranks.get((ids[at], ids[after[at]]))) is not None:
                heapq.heappush(heap, (rank, at, ids[at], ids[after[at]]))

        for at in range(n - 1):
            offer(at)
        while heap:
            rank, at, left, right = heapq.heappop(heap)
            other = after[at]
            if ids[at] != left or other < 0 or ids[other] != right:
                continue
            ids[at], ids[other] = self.joined[rank], -1
            after[at] = after[other]
            if after[other] >= 0:
                before[after[other]] = at
            after[other] = -1
            offer(at)
            offer(before[at])
        return [i for i in ids if i >= 0]

    def learn(self, pieces: list[str]) -> None:
        """Adds pieces to the memory: cut where no token can be, all fragments merged on their own, ids joined again."""
        raw = [p.encode("utf-8", "replace") for p in pieces]
        data = np.frombuffer(b"".join(raw), dtype=np.uint8)
        piece_ends = np.cumsum(list(map(len, raw)))
        cut = np.append(self.cuts(data), True)
        cut[piece_ends - 1] = True
        ends = np.flatnonzero(cut) + 1
        ids, counts = self.merged_all(data, ends)
        upto = np.concatenate([[0], np.cumsum(counts)])[np.searchsorted(ends, piece_ends) + 1].tolist()
        packed, numbers = ids.astype(np.int32).tobytes(), list(map(str, ids.tolist()))
        spans = list(zip(pieces, [0, *upto], upto))
        self.ids.update((p, packed[4 * a : 4 * b]) for p, a, b in spans)
        self.numbers.update((p, ",".join(numbers[a:b])) for p, a, b in spans)

    def remember(self, pieces: set[str]) -> None:
        """Afterwards the memory has all of these pieces; what was not asked for since it was half full goes then."""
        if len(self.ids) >= self.remembered // 2:
            self.older, self.ids, self.numbers = (self.ids, self.numbers), {}, {}
        new = pieces.difference(self.ids)
        again = new.intersection(self.older[0])
        self.ids.update((p, self.older[0][p]) for p in again)
        self.numbers.update((p, self.older[1][p]) for p in again)
        if len(new) > len(again):
            self.learn(list(new - again))

    def encode_all(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        """For each text the ids, as an array and as decimal numbers joined by commas; texts are taken together up to LETTERS_AT_ONCE."""
        held, size = [], 0
        for text in texts:
            held.append(text)
            size += len(text)
            if size >= LETTERS_AT_ONCE:
                yield from self._encode_held(held)
                held, size = [], 0
        yield from self._encode_held(held)

    def _encode_held(self, texts: list[str]) -> Iterator[tuple[np.ndarray, str]]:
        spans = [self.cut_special(text) if self.cut_special else [text] for text in texts]
        pieces = [[span if i % 2 else self.pieces(span) for i, span in enumerate(parts)] for parts in spans]
        distinct = {p for parts in pieces for some in parts[::2] for p in some}
        self.remember(distinct)
        ids_of, numbers_of = self.ids.__getitem__, self.numbers.__getitem__
        try:
            for parts in pieces:
                packed, numbers = [], []
                for i, some in enumerate(parts):
                    if i % 2:
                        packed.append(array("i", [self.special[some]]).tobytes())
                        numbers.append(str(self.special[some]))
                    else:
                        packed += map(ids_of, some)
                        numbers += map(numbers_of, some)
                yield np.frombuffer(b"".join(packed), dtype=np.int32), ",".join(numbers)
        finally:
            for piece in distinct:
                if len(piece) > SHORT:
                    del self.ids[piece], self.numbers[piece]

    def encode(self, text: str) -> tuple[np.ndarray, str]:
        """The ids, as an array and as decimal numbers joined by commas."""
        return next(self.encode_all([text]))

    def decode(self, ids: np.ndarray) -> str:
        """The text of the ids; bytes that form no character give the replacement character."""
        lengths = self.lengths[ids]
        ends = np.cumsum(lengths)
        if not len(ends):
            return ""
        places = np.arange(ends[-1]) + np.repeat(self.starts[ids] - ends + lengths, lengths)
        return self.letters[places].tobytes().decode("utf-8", "replace")


@lru_cache(2)
def codec(spec: str, remembered: int = REMEMBERED) -> ByteBpe:
    """The tables of a vocabulary file's text, built once in each worker."""
    return ByteBpe(spec, remembered)


def _spec(path: str | None) -> str:
    with open(path or default_tokenizer(), encoding="utf-8") as file:
        return file.read()


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids array<int> of every whole text.

    The vocabulary file (a fixed few MB) is read on the driver and goes out with
    the tasks. A null or empty text has no ids; repeated rows and null doc_ids
    come out as they are; other columns are not read. No shuffle.
    """
    spec = _spec(path)
    return all_texts(docs, lambda texts: ((ids,) for ids, _ in codec(spec).encode_all(texts)), "ids array<int>")


def encoded_rows(docs: DataFrame, *keep: str, path: str | None = None) -> DataFrame:
    """``keep``, n_tokens, ids array<int> of every row of ``docs``; a null text has no ids."""
    spec = _spec(path)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bpe = codec(spec, REMEMBERED_WITH_IDS)
        for batch in batches:
            for at in range(0, len(batch), ROWS_AT_ONCE):
                part = batch.iloc[at : at + ROWS_AT_ONCE]
                ids = [ids for ids, _ in bpe.encode_all([text or "" for text in part["text"]])]
                yield part.drop(columns="text").assign(n_tokens=[len(x) for x in ids], ids=ids)

    kept = docs.select(*keep)
    schema = StructType([*kept.schema.fields, StructField("n_tokens", LongType()), StructField("ids", ArrayType(IntegerType()))])
    return docs.select(*keep, "text").mapInPandas(run, schema)


def decoded(rows: DataFrame, path: str | None = None, ids: str = "ids", into: str = "text") -> DataFrame:
    """All columns of ``rows`` and the text of ``ids`` in ``into``, which replaces a column of that name.

    Null ids give a null text, empty ids the empty text.
    """
    spec = _spec(path)

    @F.pandas_udf("string")
    def text_of(column: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for values in column:
            yield pd.Series([None if v is None else codec(spec).decode(np.asarray(v, dtype=np.int64)) for v in values], dtype=object)

    return rows.withColumn(into, text_of(ids))


def op2_bpe_round_trip(spark: SparkSession, folder: str) -> DataFrame:
    """Token counts, and digests of the ids and of the decoded text, of all documents."""
    spec = _spec(None)

    def digests(texts: list[str]) -> Iterator[tuple[int, str, str]]:
        bpe = codec(spec)
        for ids, written in bpe.encode_all(texts):
            back = bpe.decode(ids)
            yield len(ids), hashlib.sha256(written.encode()).hexdigest(), hashlib.sha256(back.encode()).hexdigest()

    return all_texts(table(spark, folder, "documents"), digests, "n_tokens long, ids_sha256 string, decoded_sha256 string")

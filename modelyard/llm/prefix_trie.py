"""Conversation prefix tries from ternary search trees over range shards.

A conversation is the sequence of its turns' digests. Sorted by sequence, the
conversations are cut into shards that a task can hold. A shard numbers its
turns, puts its sequences into a ternary search tree, the median first, and walks
the tree once. Nodes on a shard's first and last sequence may go on in the
neighbours: their parts are merged, all other nodes are final.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import table
from .mixing import stored

# Letters of a turn's digest.
DIGEST = 32
# Conversations, and turns, from which a shard is closed.
SHARD_ROWS, SHARD_TURNS = 20_000, 100_000
# Turns that a conversation may take from the one it starts from.
MOST_SHARED = 9
FAMILY = 5
NOTHING = hashlib.sha256(b"").hexdigest()
ROOT = "root"


def turns(rows: DataFrame) -> DataFrame:
    """conv_id, turns: the digests and last-text bytes of each conversation's turns in order.

    Ordered by turn, null first, equal turns by digest. Null role and text are
    empty. Rows without conv_id belong to no conversation and are left out.
    """
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    short = rows.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", digest.alias("digest"), F.octet_length(text).cast("long").alias("bytes")
    )
    ordered = F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "digest", "bytes")))
    return short.groupBy("conv_id").agg(F.transform(ordered, lambda t: F.struct(t["digest"].alias("digest"), t["bytes"].alias("bytes"))).alias("turns"))


def rebuilt(rows: DataFrame) -> DataFrame:
    """conv_id, path, bytes of each conversation after its start gave way to that of its family's first.

    Conversation c takes the first h turns of conversation c - c % FAMILY (none if
    there is none) in place of its own first h, h = crc32(c as text) % MOST_SHARED.
    Heads of at most MOST_SHARED turns meet at most a few conversations each.
    """
    own = stored(turns(rows), "turns")
    heads = own.filter(F.col("conv_id") % FAMILY == 0).select(
        F.col("conv_id").alias("first"), F.slice("turns", 1, MOST_SHARED).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST_SHARED).cast("int")
    marked = own.withColumns({"h": h, "first": F.col("conv_id") - F.col("conv_id") % FAMILY}).join(heads, "first", "left")
    taken = F.coalesce(F.slice("head", F.lit(1), F.col("h")), F.array().cast(own.schema["turns"].dataType))
    rest = F.slice("turns", F.col("h") + 1, F.size("turns"))
    both = F.concat(taken, rest)
    return marked.select(
        "conv_id", F.array_join(F.transform(both, lambda t: t["digest"]), "").alias("path"), F.transform(both, lambda t: t["bytes"]).alias("bytes")
    )


def tokens_of(path: str) -> list[str]:
    return [path[i : i + DIGEST] for i in range(0, len(path), DIGEST)]


def key_of(above: str, token: str) -> str:
    """Key of the prefix that goes on from the prefix ``above`` with a turn."""
    return hashlib.md5((above + token).encode()).hexdigest()


class TernaryTree:
    """Sequences of whole numbers, each with its members. Node 0 is the empty sequence.

    A level of the trie is a binary search tree of turns (less, more); below hangs
    the next level. Nothing recurs, so sequences may be of any length.
    """

    def __init__(self) -> None:
        self.token, self.parent, self.depth = [-1], [-1], [0]
        self.less, self.more, self.below = [-1], [-1], [-1]
        self.ends: list[int] = [-1]

    def _new(self, token: int, parent: int) -> int:
        for column, value in (
            (self.token, token), (self.parent, parent), (self.depth, self.depth[parent] + 1),
            (self.less, -1), (self.more, -1), (self.below, -1), (self.ends, -1),
        ):
            column.append(value)
        return len(self.token) - 1

    def insert(self, sequence: list[int], number: int) -> None:
        """Adds a sequence; ``number`` is kept at the node where it ends."""
        at = 0
        for token in sequence:
            node = self.below[at]
            if node < 0:
                node = self.below[at] = self._new(token, at)
            while self.token[node] != token:
                side = self.less if token < self.token[node] else self.more
                if side[node] < 0:
                    side[node] = self._new(token, at)
                node = side[node]
            at = node
        self.ends[at] = number

    @classmethod
    def of_sorted(cls, sequences: list[list[int]]) -> TernaryTree:
        """The tree of sorted different sequences: the median of each stretch goes in before its halves."""
        tree, todo = cls(), [(0, len(sequences))]
        while todo:
            low, high = todo.pop()
            if low < high:
                middle = (low + high) // 2
                tree.insert(sequences[middle], middle)
                todo += [(middle + 1, high), (low, middle)]
        return tree


class Shard:
    """The trie of one stretch of sorted conversations, with totals for each node."""

    def __init__(self, paths: list[str], sizes: list[list[int]], members: list[list[int]]) -> None:
        split = [tokens_of(p) for p in paths]
        # Equal-width digests: their order is that of the paths.
        numbers = {t: i for i, t in enumerate(sorted({t for s in split for t in s}))}
        names = list(numbers)
        sequences = [[numbers[t] for t in s] for s in split]
        tree = self.tree = TernaryTree.of_sorted(sequences)
        self.members, n = members, len(tree.token)
        self.bytes, self.keys = [0] + [-1] * (n - 1), [ROOT] * n
        self.count, self.least = [0] * n, [None] * n
        self.children, self.leaves, self.saved = [0] * n, [0] * n, [0] * n
        for node in range(1, n):  # a node comes after its parent
            self.keys[node] = key_of(self.keys[tree.parent[node]], names[tree.token[node]])
        for node in range(n):
            if tree.ends[node] >= 0:
                own = members[tree.ends[node]]
                self.count[node], self.least[node] = len(own), own[0]
                for size in reversed(sizes[tree.ends[node]]):
                    if self.bytes[node] >= 0:
                        break
                    self.bytes[node] = size
                    node = tree.parent[node]
        for node in range(n - 1, -1, -1):  # and before all that is below it
            self.leaves[node] += not self.children[node]
            self.saved[node] += (self.count[node] - 1) * self.bytes[node]
            above = tree.parent[node]
            if above >= 0:
                self.count[above] += self.count[node]
                self.children[above] += 1
                self.leaves[above] += self.leaves[node]
                self.saved[above] += self.saved[node]
                if self.least[above] is None or self.least[node] < self.least[above]:
                    self.least[above] = self.least[node]
        # The nodes on the first and the last sequence may be in other shards, too.
        self.edge = {0}
        for sequence in (0, len(paths) - 1):
            at = tree.ends.index(sequence)
            while at >= 0:
                self.edge.add(at)
                at = tree.parent[at]

    def own(self, node: int) -> list[int]:
        end = self.tree.ends[node]
        return self.members[end] if end >= 0 else []

    def digest(self, node: int) -> str:
        ids = self.own(node)
        return hashlib.sha256(_join(ids).encode()).hexdigest() if ids else NOTHING


def _join(ids: list[int]) -> str:
    return ",".join(map(str, ids))


NODE = "shard string, key string, above string, edge boolean, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, own string"
EDGES = "first_path string, first_bytes array<bigint>, last_path string, last_bytes array<bigint>, first_conv long"


def shard_rows(batches: Iterator[pd.DataFrame], most_rows: int, most_turns: int) -> Iterator[pd.DataFrame]:
    """Nodes of each shard of a sorted stream of conversations, and a row with the shard's ends.

    A shard is closed at ``most_rows`` conversations or ``most_turns`` turns. ``own``
    of an edge node has the ids that end there, of any other their digest.
    """
    paths, sizes, members, rows, held = [], [], [], 0, 0

    def close() -> pd.DataFrame:
        shard, name = Shard(paths, sizes, members), f"{members[0][0]}:{hashlib.md5(paths[0].encode()).hexdigest()}"
        tree, nodes = shard.tree, range(len(shard.tree.token))
        above = [tree.parent[node] for node in nodes]
        inner = [a >= 0 and a not in shard.edge for a in above]
        columns = {
            "shard": name,
            "key": shard.keys,
            "above": [shard.keys[a] if a >= 0 else None for a in above],
            "edge": [node in shard.edge for node in nodes],
            "conv_id": shard.least,
            "depth": tree.depth,
            "parent_conv_id": pd.array([shard.least[a] if known else None for a, known in zip(above, inner)], dtype="Int64"),
            "n_convs": shard.count,
            "n_children": shard.children,
            "n_leaves": shard.leaves,
            "saved_tokens": shard.saved,
            "own": [_join(shard.own(node)) if node in shard.edge else shard.digest(node) for node in nodes],
        }
        ends = {"first_path": paths[0], "first_bytes": sizes[0], "last_path": paths[-1], "last_bytes": sizes[-1]}
        columns |= {k: [v, *[None] * (len(nodes) - 1)] for k, v in ends.items()}
        columns["first_conv"] = pd.array([members[0][0], *[None] * (len(nodes) - 1)], dtype="Int64")
        return pd.DataFrame(columns)

    for batch in batches:
        for conv_id, path, size in zip(batch["conv_id"].tolist(), batch["path"], batch["bytes"]):
            if rows and (rows >= most_rows or held >= most_turns):
                yield close()
                paths, sizes, members, rows, held = [], [], [], 0, 0
            if not paths or paths[-1] != path:
                paths.append(path)
                sizes.append([int(b) for b in size])
                members.append([])
                held += len(sizes[-1])
            members[-1].append(conv_id)
            rows += 1
    if rows:
        yield close()


def crossings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """What merging must take back at each border of two shards, for each node that both have.

    Its turn in the path is a child of both; what it and the nodes below it on the
    common path would have cost once was left out twice; and the end of the common
    path is a leaf of the earlier shard only by the cut, if that shard ends there.
    """
    columns = ["key", "children", "leaves", "saved"]
    for batch in batches:
        out = []
        for last, last_bytes, first in zip(batch["last_path"], batch["last_bytes"], batch["next_path"]):
            mine, theirs = tokens_of(last), tokens_of(first)
            depth = 0
            while depth < min(len(mine), len(theirs)) and mine[depth] == theirs[depth]:
                depth += 1
            keys = [ROOT]
            for token in mine[:depth]:
                keys.append(key_of(keys[-1], token))
            leaf, saved = int(depth == len(mine)), 0
            for at in range(depth, -1, -1):
                saved += int(last_bytes[at - 1]) if at else 0
                out.append((keys[at], int(at < depth), leaf, saved))
        yield pd.DataFrame(out, columns=columns)


def ends_digests(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """key, ends_sha256 from rows sorted by key: the texts of a key are digested as one, joined by commas."""
    now, state, out = None, None, []
    for batch in batches:
        for key, text in zip(batch["key"], batch["own"]):
            if key != now:
                if state is not None:
                    out.append((now, state.hexdigest()))
                now, state = key, hashlib.sha256(text.encode())
            else:
                state.update(b"," + text.encode())
        yield pd.DataFrame(out, columns=["key", "ends_sha256"])
        out = []
    if state is not None:
        yield pd.DataFrame([(now, state.hexdigest())], columns=["key", "ends_sha256"])


def trie(paths: DataFrame, shard_rows_: int = SHARD_ROWS, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """The nodes of all prefixes of ``paths`` (conv_id, path, bytes); see ``prefix_nodes``."""
    order = ("path", "conv_id")
    ranged = paths.repartitionByRange(*order).sortWithinPartitions(*order)
    built = stored(ranged.mapInPandas(lambda batches: shard_rows(batches, shard_rows_, shard_turns), f"{NODE}, {EDGES}"), "shards")
    nodes = built.drop("first_path", "first_bytes", "last_path", "last_bytes", "first_conv")

    # One row for each shard: the window sees as many rows as there are shards.
    shards = built.filter("first_path IS NOT NULL").select("first_path", "first_conv", "last_path", "last_bytes")
    following = F.lead("first_path").over(Window.orderBy("first_path", "first_conv"))
    borders = shards.withColumn("next_path", following).filter("next_path IS NOT NULL").select("last_path", "last_bytes", "next_path")
    takes = borders.mapInPandas(crossings, "key string, children long, leaves long, saved long")
    zero = F.lit(0).cast("long")
    parts = nodes.filter("edge").select("key", "above", "depth", "conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens")
    none = F.lit(None).cast("string"), zero.alias("depth"), F.lit(None).cast("long"), zero
    parts = parts.union(takes.select("key", *none, -F.col("children"), -F.col("leaves"), F.col("saved")))
    sums = [F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    merged = stored(parts.groupBy("key").agg(F.max("above").alias("above"), F.max("depth").alias("depth"), F.min("conv_id").alias("conv_id"), *sums), "merged")

    # The ids of a node stand in shards in order; only the texts of edge nodes meet, and they pass as a stream.
    blocks = nodes.filter("edge AND own <> ''").select("key", F.substring_index("own", ",", 1).cast("long").alias("from"), "own")
    ends = blocks.repartition("key").sortWithinPartitions("key", "from").mapInPandas(ends_digests, "key string, ends_sha256 string")

    columns = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    least = merged.select(F.col("key").alias("above"), F.col("conv_id").alias("parent_conv_id"))
    on_edge = merged.join(ends, "key", "left").join(least, "above", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NOTHING)))
    inside = nodes.filter("NOT edge").withColumnRenamed("own", "ends_sha256")
    final = inside.filter("parent_conv_id IS NOT NULL").select(*columns)
    # Children of edge nodes meet their shard's copy of the parent: never more rows for a key than a shard has.
    at_shard = nodes.filter("edge").select("shard", F.col("key").alias("above")).join(least, "above")
    below = inside.filter("parent_conv_id IS NULL").drop("parent_conv_id").join(at_shard, ["shard", "above"])
    return on_edge.select(*columns).union(below.select(*columns)).union(final)


def prefix_nodes(rows: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of each node.

    A node is a distinct sequence of first turns (role, text) of the rebuilt
    conversations (see ``rebuilt``), the root that of none; conv_id is its smallest
    member, null as the root's parent. Rows without conv_id are left out, null role
    and text are empty, repeated rows are turns of their own, equal turn numbers go
    by digest, an empty table gives no rows, other columns are not read. A first
    turn, a prefix or a whole conversation may be shared by any share of the
    conversations. One conversation's digests must fit a row.
    """
    return trie(stored(rebuilt(rows), "paths"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    """The nodes of the prefix trie of conversations."""
    return prefix_nodes(table(spark, folder, "conversations"))


_CRC = "list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda s: ord(s)::BIGINT)), lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)), lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END))"

OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, list(struct_pack(r := coalesce(role, ''), x := coalesce(text, '')) ORDER BY turn NULLS FIRST) AS own
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), c AS (
  SELECT t.conv_id, xor({_CRC.replace("conv_id", "t.conv_id")}, 4294967295) % {MOST_SHARED} AS h, t.own, f.own AS head
  FROM t LEFT JOIN t f ON f.conv_id = t.conv_id - t.conv_id % {FAMILY}
), p AS (
  SELECT conv_id, list_concat(coalesce(head, [])[1:h], own[h + 1:]) AS path FROM c
), e AS (
  SELECT conv_id, len(path) AS size, unnest(range(len(path) + 1)) AS depth, path FROM p
), k AS (
  SELECT conv_id, size, depth, path[1:depth] AS prefix, CASE WHEN depth > 0 THEN path[1:depth - 1] END AS above,
    CASE WHEN depth > 0 THEN strlen(path[depth].x) ELSE 0 END AS bytes
  FROM e
), n AS (
  SELECT prefix, depth, any_value(above) AS above, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (size = depth) AS ends
  FROM k GROUP BY prefix, depth
), g AS (
  SELECT above, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY above
), m AS (
  SELECT n.*, coalesce(g.n_children, 0) AS n_children FROM n LEFT JOIN g ON g.above = n.prefix
), s AS (
  SELECT prefix[1:d] AS top, count(*) FILTER (n_children = 0) AS n_leaves, sum((n_convs - 1) * bytes) AS saved
  FROM (SELECT *, unnest(range(depth + 1)) AS d FROM m) GROUP BY top
)
SELECT m.conv_id, m.depth::BIGINT AS depth, a.conv_id AS parent_conv_id, m.n_convs, m.n_children, s.n_leaves, s.saved::BIGINT AS saved_tokens,
  sha256(coalesce(m.ends, '')) AS ends_sha256
FROM m LEFT JOIN n a ON m.depth > 0 AND a.prefix = m.above JOIN s ON s.top = m.prefix
"""

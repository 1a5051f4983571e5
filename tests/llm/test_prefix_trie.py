"""The trie against plain dictionaries, with shards of every size, and against its SQL form."""

import hashlib
import random
import zlib

import duckdb
import pytest
from pyspark.sql import functions as F

from check import as_rows
from modelyard.llm import prefix_trie as p

SCHEMA = "conv_id long, turn long, role string, text string"


def plain(rows):
    """All nodes as tuples, from dictionaries of prefixes."""
    convs = {}
    for c, turn, role, text in rows:
        if c is not None:
            convs.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    # Equal turns go by the digest of what they say.
    digest = lambda r, t: hashlib.md5(f"{len(r.encode())}:{r}{t}".encode()).hexdigest()
    convs = {c: [x[2:] for x in sorted(v, key=lambda x: (x[0], x[1], digest(x[2], x[3])))] for c, v in convs.items()}
    members, ends = {}, {}
    for c, own in convs.items():
        h = zlib.crc32(str(c).encode()) % 9
        first = int(c - (abs(c) % 5) * (1 if c >= 0 else -1))
        path = tuple(convs.get(first, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children, leaves, saved = {}, dict.fromkeys(members, 0), dict.fromkeys(members, 0)
    for node in members:
        if node:
            children[node[:-1]] = children.get(node[:-1], 0) + 1
    for node, who in members.items():
        for d in range(len(node) + 1):
            leaves[node[:d]] += node not in children
            saved[node[:d]] += (len(who) - 1) * len(node[-1][1].encode()) if node else 0
    return sorted(
        (
            min(who), len(node), min(members[node[:-1]]) if node else -1, len(who), children.get(node, 0), leaves[node], saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends.get(node, [])))).encode()).hexdigest(),
        )
        for node, who in members.items()
    )


def nodes(df):
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted(tuple(-1 if r[n] is None else r[n] for n in names) for r in df.collect())


def talks(seed, convs=70):
    """Conversations over few texts, so that many share starts, are equal, or end inside others."""
    rng, rows = random.Random(seed), []
    for c in range(convs):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 12])):
            role = rng.choice(["user", "user", None])
            rows.append((c, turn, role, rng.choice(["ä", "b", "cc", None])))
    return rows


@pytest.mark.parametrize("most_rows", [1, 2, 7, 1000])
def test_any_shards_give_the_same_trie(spark, most_rows):
    rows = talks(most_rows)
    df = spark.createDataFrame(rows, SCHEMA)
    paths = p.rebuilt(df.withColumn("path", F.lit("clash")))
    assert nodes(p.trie(paths, most_rows, 10**9)) == plain(rows)


def test_shards_close_at_turns_too(spark):
    rows = talks(99)
    assert nodes(p.trie(p.rebuilt(spark.createDataFrame(rows, SCHEMA)), 10**9, 3)) == plain(rows)


def test_hot_conversation(spark):
    """Most conversations say the same; they are spread over many shards."""
    rows = [(c, t, "user", "hello" if c % 3 else f"hello {c}") for c in range(600) for t in range(2)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(p.trie(p.rebuilt(df), 16, 10**9)) == plain(rows)


def test_edges(spark):
    rows = [
        (None, 0, "user", "x"), (1, None, "user", "first"), (1, 0, "user", "x"), (1, 0, "user", "x"), (2, 3, None, None), (-7, 1, "a", "é" * 9000),
        (-5, 1, "a", "q"), (10, 0, "r", "s"), (11, 0, "r", "s"), (1 << 60, 0, "r", "s"), ((1 << 60) + 1, 5, "", ""), (40, 1, "u", ""), (41, 0, "u", "z"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    assert nodes(p.prefix_nodes(df.withColumn("n_convs", F.lit("clash")))) == plain(rows)
    assert p.prefix_nodes(df.limit(0)).count() == 0
    assert p.prefix_nodes(spark.createDataFrame(rows[:1], SCHEMA)).count() == 0


def test_long_conversation(spark):
    df = spark.range(5000).select(F.lit(5).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.lit("u").alias("role"), F.lit("t").alias("text"))
    found = p.prefix_nodes(df)
    assert found.count() == 5001 and found.agg(F.max("n_children"), F.max("n_leaves")).first()[:] == (1, 1)


def test_query_equals_sql_and_brute_force(spark, folder):
    df = p.op13_prefix_trie(spark, folder)
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{folder}/conversations.parquet'")
    cursor = con.execute(p.OP13_SQL)
    assert as_rows(df.columns, df.collect()) == as_rows([d[0] for d in cursor.description], cursor.fetchall())
    rows = [tuple(r) for r in spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    assert nodes(df) == plain(rows)


def test_tree_is_balanced():
    tree = p.TernaryTree.of_sorted([[i] for i in range(1023)])
    depth, todo = 0, [(tree.below[0], 1)]
    while todo:
        node, level = todo.pop()
        if node >= 0:
            depth = max(depth, level)
            todo += [(tree.less[node], level + 1), (tree.more[node], level + 1)]
    assert depth == 10

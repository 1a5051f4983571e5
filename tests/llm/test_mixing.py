import duckdb
import pytest
from pyspark.sql import functions as F

from modelyard.llm.mixing import BLOCK, MOST, OP7_SQL, mixed, op7_golden_mix, schedule, placed_sizes, source_targets, word_takes
from tests.conftest import plan_of

LONG = " ".join(f"w{i}" for i in range(3000))


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, f" a{i} b\tc" * (i % 7 * 40), ["x", "y", None, "z", "Ä", "empty"][i % 6] if i % 6 != 5 else "y", 5, "k") for i in range(120)]
    rows += [(500, LONG, "y", 1, "k"), (501, None, "empty", 1, None), (502, "", "empty", 1, "k"), (None, LONG, "x", 1, "k")]
    rows += [(503, "same words here", "z", 1, "k")] * 2 + [(504, "one two", "tiny", 1, "k")]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars long, size string")


def sql_rows(frame):
    connection = duckdb.connect()
    connection.register("documents", frame.toPandas().astype({"doc_id": "Int64"}))
    return sorted(connection.execute(OP7_SQL).fetchall(), key=str)


def test_equals_sql_on_hard_rows(docs):
    rows = [tuple(r) for r in word_takes(docs).collect()]
    assert sorted(rows, key=str) == sql_rows(docs)
    assert all(r[4] <= MOST * r[1] for r in rows)


def test_targets_come_near(docs):
    rows = [tuple(r) for r in op7_rows(docs)]
    for (size, target), taken in rows:
        assert abs(taken - target) <= 4 * BLOCK


def op7_rows(docs):
    sums = {}
    for r in word_takes(docs).collect():
        sums[r.source_size, r.target] = sums.get((r.source_size, r.target), 0) + r.taken
    return sums.items()


def test_points_are_dealt_evenly(docs):
    targets = source_targets(docs.selectExpr("source", "2000L AS size"))
    rows = schedule(targets).collect()
    assert sorted(r.slot for r in rows) == sorted({r.slot for r in rows})
    needed = {r.sid: r.hi - r.lo for r in targets.collect()}
    for half in (rows, [r for r in rows if r.slot < len(rows) / 2]):
        for sid, n in needed.items():
            got = sum(r.sid == sid for r in half)
            assert abs(got - n * len(half) / len(rows)) <= 4
    for r in rows:
        assert r.epoch < MOST


def test_mixed_documents_hold_the_words_taken(docs):
    out = mixed(docs)
    assert out.columns == docs.columns
    words = {}
    for r in out.collect():
        assert r.n_chars == len(r.text)
        words[r.doc_id, r.source] = words.get((r.doc_id, r.source), 0) + len(r.text.split())
    want = {}
    for r in word_takes(docs).collect():
        want[r.doc_id] = want.get(r.doc_id, 0) + r.taken
    got = {}
    for (doc_id, _), n in words.items():
        got[doc_id] = got.get(doc_id, 0) + n
    assert got == {k: v for k, v in want.items() if v}


def test_rows_without_an_id_or_with_one_id_are_ordered_as_few(spark, docs):
    """A third of the rows has no id and a third one id; no window sees more than a row for each size."""
    many = spark.range(18_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).when(F.col("id") % 3 == 1, F.lit(7)).otherwise(F.col("id")).cast("long").alias("doc_id"),
        F.repeat(F.lit("w "), (F.col("id") % 4).cast("int")).alias("text"), F.lit("hot").alias("source"), F.lit(1).cast("long").alias("n_chars"), F.lit("k").alias("size"),
    )
    assert sorted((tuple(r) for r in word_takes(docs.unionAll(many)).collect()), key=str) == sql_rows(docs.unionAll(many))
    sized = many.select("doc_id", "source", (F.col("n_chars") * 2).alias("size"))
    rows = placed_sizes(sized, source_targets(sized))
    places = rows.groupBy("sid", "bucket").agg(F.count("*").alias("n"), F.countDistinct("place").alias("places"), F.max("place").alias("last"))
    assert all(r.n == r.places == r.last for r in places.collect()) and rows.count() == 18_000
    plan = plan_of(rows)
    assert plan.index("Window") < plan.index("Window", plan.index("Window") + 1) < plan.rindex("partial_count(1)"), "rows are merged first"


def test_empty_table(docs):
    assert word_takes(docs.limit(0)).count() == 0 and mixed(docs.limit(0)).count() == 0


def test_no_python_in_the_plan(spark, folder):
    df = op7_golden_mix(spark, folder)
    plan = plan_of(df)
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "BroadcastNestedLoopJoin"))
    assert sorted(map(tuple, df.collect())) == sorted(map(tuple, op7_golden_mix(spark, folder).collect()))

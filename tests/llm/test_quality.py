import duckdb

from modelyard.llm.quality import OP5_SQL, line_cleaned, measure, op5_line_rules

PROSE = "\n".join(" ".join(f"word{i}{letter}" for letter in "abcdefgh") + "." for i in range(8))


def brute_repeated(words):
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    return len({i + j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(3)})


def test_counts_of_worked_texts():
    assert measure("a b c a b c")[:6] == (6, 6, 0, 0, 6, True)
    assert measure("x\n \nx\n# y\nx")[:5] == (5, 5, 1, 2, 0)
    for text in ("a b a b a b a", "a a a a", "a b c d a b c x b c d", "a b", ""):
        assert measure(text)[4] == brute_repeated(text.split())


def test_line_rules():
    menu = "Home | About | Contact"
    got = measure(f"{PROSE}\n{menu}\nCopyright, all rights reserved.\nbuy buy now now\nNo end mark\n$$$ ###.")
    assert got[6] and got[7:11] == (5 + 4 + 4 + 3 + 2, 1, 2, 2) and got[11] == PROSE


def test_documents_that_lose_too_much_go():
    few = "\n".join(PROSE.split("\n")[:3])
    menu = "\n".join(["One | Two | Three | Four"] * 1 + [f"Go | to | page{i} | now{i}" for i in range(20)])
    assert measure(PROSE)[5:7] == (False, True) and measure(f"{few}\n{menu}")[5:7] == (False, False)


def test_edges(spark):
    rows = [(1, None, "x"), (2, "", "x"), (None, PROSE, "x"), (3, PROSE, "x"), (3, PROSE, "x"), (4, PROSE + "\nword" * 100000, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_words string")
    found = line_cleaned(docs).collect()
    assert sorted((r.doc_id or 0, r.kept) for r in found) == [(0, True), (1, False), (2, False), (3, True), (3, True), (4, False)]
    assert {r.clean_text for r in found if r.doc_id in (3, None)} == {PROSE}
    assert line_cleaned(docs.limit(0)).count() == 0
    # The SQL form gives the same on the same rows.
    connection = duckdb.connect()
    connection.register("documents", docs.toPandas())
    want = connection.execute(OP5_SQL).fetchdf()
    mine = line_cleaned(docs).drop("clean_text").toPandas()[list(want.columns)]
    order = lambda df: sorted(map(str, df.astype(object).where(df.notna(), None).values.tolist()))
    assert order(mine) == order(want)


def test_good_documents_stay(spark, folder):
    verdicts = op5_line_rules(spark, folder).join(spark.read.parquet(f"{folder}/labels.parquet"), "doc_id").filter("NOT base_failed").collect()
    good = [r.kept for r in verdicts if r.quality == 1]
    assert sum(good) >= 0.98 * len(good) and not any(r.kept for r in verdicts if r.quality == 0)

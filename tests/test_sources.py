import base64
import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from modelyard.session import scratch_path, shared_dir
from modelyard.sources import readers as R
from modelyard.sources import sinks as W
from modelyard.sources.tracking import Tracking


@pytest.fixture
def mixed(spark):
    rows = [(1, 'a "quoted", text', 0.1, dt.datetime(2024, 1, 1, 0, 0, 7, 179575)), (2, "", None, None), (4, "  \\", 1e-9, None), (3, None, -5e300, dt.datetime(1999, 12, 31))]
    return spark.createDataFrame(rows, "id bigint, s string, v double, at timestamp_ntz")


def test_csv_round_trip_keeps_every_value(spark, mixed, tmp_path):
    W.write_csv(mixed, str(tmp_path / "c"))
    assert R.read_csv(spark, str(tmp_path / "c"), mixed.schema).orderBy("id").collect() == mixed.orderBy("id").collect()


def test_csv_inference_and_separator(spark, tmp_path):
    (tmp_path / "x.csv").write_text("a;b\n1;2.5\n2;x\n")
    assert R.read_csv(spark, str(tmp_path / "x.csv"), sep=";").dtypes == [("a", "int"), ("b", "string")]


def test_csv_line_breaks(spark, tmp_path):
    df = spark.createDataFrame([(1, "a\nb"), (2, "c")], "id int, s string")
    W.write_csv(df, str(tmp_path / "c"))
    assert R.read_csv(spark, str(tmp_path / "c"), df.schema, multi_line=True).orderBy("id").collect() == df.collect()


def test_json_round_trip_keeps_every_value(mixed):
    assert W.rows_from_json(W.rows_as_json(mixed), mixed.schema).orderBy("id").collect() == mixed.orderBy("id").collect()


def test_source_by_kind(spark, mixed, tmp_path):
    W.save_table(mixed, "kinds", str(tmp_path / "t"))
    W.write_csv(mixed, str(tmp_path / "c"))
    assert R.read_source(spark, "delta", "kinds").count() == 4
    assert R.read_source(spark, "anything else", str(tmp_path / "c"), mixed.schema).count() == 4
    W.save_table(mixed.limit(1), "kinds", str(tmp_path / "t2"))
    assert R.select_all(spark, "kinds").count() == 1


def test_names_are_quoted():
    assert R.quoted_name("db.t") == "`db`.`t`"
    assert R.quoted_name("t`; drop table x") == "`t``; drop table x`"


def test_one_file_only_when_small(spark, tmp_path):
    files = lambda name: [f for f in os.listdir(tmp_path / name) if f.endswith(".csv")]
    assert W.write_single_csv(spark.range(100).repartition(4), str(tmp_path / "small")) == 100
    assert W.write_single_csv(spark.range(100).repartition(4), str(tmp_path / "large"), max_rows=10) == 100
    assert len(files("small")) == 1 and len(files("large")) == 4
    assert R.read_csv(spark, str(tmp_path / "large"), "id bigint").count() == 100


def test_document_and_latest(spark, tmp_path):
    for n in (1, 2):
        doc = spark.createDataFrame([(n, None)], "n int, missing string")
        W.write_document(doc, str(tmp_path / f"d{n}"), str(tmp_path / "latest"))
    assert [r.n for r in spark.read.json(str(tmp_path / "latest")).collect()] == [2]
    assert [r.n for r in spark.read.json(str(tmp_path / "d1")).collect()] == [1]


def test_missing_artifacts_are_all_named(spark, tmp_path):
    W.write_document(spark.createDataFrame([(1,)], "n int"), str(tmp_path / "here"))
    paths = {k: str(tmp_path / k) for k in ("here", "gone", "lost")}
    with pytest.raises(FileNotFoundError, match="gone .*lost"):
        R.read_artifacts(spark, paths, dict.fromkeys(paths, "n int"))
    found = R.read_artifacts(spark, {"here": paths["here"]}, {"here": "n int"})
    assert found["here"].first().n == 1


def test_listing_and_binary(spark, tmp_path):
    (tmp_path / "one.png").write_bytes(b"\x89PNG" + bytes(range(200)))
    (tmp_path / "two.JPEG").write_bytes(b"\xff\xd8")
    (tmp_path / "three").write_bytes(b"x")
    assert {r.name: r.size for r in R.list_files(spark, str(tmp_path)).collect()} == {"one.png": 204, "two.JPEG": 2, "three": 1}
    urls = {
        r.path.rsplit("/", 1)[1]: r.url
        for r in R.read_binary(spark, str(tmp_path)).select("path", R.data_url(F.col("path"), F.col("content")).alias("url")).collect()
    }
    assert urls["one.png"] == "data:image/png;base64," + base64.b64encode((tmp_path / "one.png").read_bytes()).decode()
    assert urls["two.JPEG"].startswith("data:image/jpeg;base64,") and urls["three"].startswith("data:image/png;base64,")


def test_listing_does_not_read_contents(spark, folder):
    plan = R.list_files(spark, folder)._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[1]


def test_cached_count(spark):
    kept, n = W.persist_and_count(spark.range(11))
    assert n == 11 and kept.is_cached
    kept.unpersist()


def test_a_failed_write_leaves_the_latest_document(spark, tmp_path, monkeypatch):
    one = spark.createDataFrame([(1,)], "n int")
    W.write_document(one, str(tmp_path / "d1"), str(tmp_path / "latest"))

    def stop(*args):
        raise RuntimeError("between write and swap")

    monkeypatch.setattr("modelyard.sources.commits._renamed", stop)
    with pytest.raises(RuntimeError):
        W.write_document(spark.createDataFrame([(2,)], "n int"), str(tmp_path / "d2"), str(tmp_path / "latest"))
    assert [r.n for r in spark.read.json(str(tmp_path / "latest")).collect()] == [1]


def test_tracking_tables(spark, tmp_path):
    tracking = Tracking(spark, str(tmp_path))
    assert tracking.read("metrics").count() == 0
    tracking.append_values("metrics", [("r", "rmse", 1.0)])
    tracking.append_values("metrics", [("r", "r2", 0.5)])
    assert {r.key: r.value for r in tracking.read("metrics").collect()} == {"rmse": 1.0, "r2": 0.5}


def test_scratch_paths_follow_the_session(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark)) and scratch_path(spark, "x") != scratch_path(spark, "x")

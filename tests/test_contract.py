import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, LongType, StringType, StructType

from modelyard.operators import contract as K
from tests.conftest import plan_of

NAN = float("nan")


@pytest.fixture
def gaps(spark):
    return spark.createDataFrame([(1, 1.0, "a"), (2, NAN, "b"), (3, None, "c"), (4, 9.0, None)], "id int, v double, s string")


def test_columns_by_type_leaves_ints_out_unless_asked(gaps):
    assert K.columns_by_type(gaps, "v") == (["s"], [])
    assert K.columns_by_type(gaps, include_ints=True) == (["s"], ["id", "v"])
    assert K.all_but(gaps, "v") == ["id", "s"]


def test_missing_values(gaps):
    assert [r.id for r in K.drop_missing(gaps).collect()] == [1]
    assert K.missing_cells(gaps).first()[0] == 3
    assert K.missing_cells(gaps.filter("false")).first()[0] == 0


def test_dropping_missing_rows_of_a_wide_frame_plans_quickly(spark):
    wide = spark.range(3).select("id", *[(F.col("id") + i).cast("double").alias(f"c{i}") for i in range(80)])
    assert K.drop_missing(wide).select(*[F.col(f"c{i}").alias(f"d{i}") for i in range(80)]).count() == 3


def test_null_checks_reach_the_scan(spark, folder):
    plan = plan_of(K.drop_missing(spark.read.parquet(f"{folder}/orders.parquet").select("o_orderkey", "o_totalprice")))
    assert "IsNotNull(o_totalprice)" in plan


def test_column_contract(gaps):
    found = K.column_violations(gaps, ["id", "z", "y"])
    assert found[:2] == [("absent", "z"), ("absent", "y")] and sorted(found[2:]) == [("unexpected", "s"), ("unexpected", "v")]
    with pytest.raises(K.ContractError, match="z is absent"):
        K.require_columns(gaps, ["id", "v", "s", "z"])
    assert K.require_columns(gaps, ["s", "v", "id"]) is gaps


def test_report_passes_and_fails(spark, gaps):
    good = spark.createDataFrame([(1, 0.0), (2, 5.5)], "id int, v double")
    row = K.contract_report(good, ["id", "v"], "v", 0.0, 5.5).first()
    assert row.status == "passed" and row.n_rows == 2
    K.enforce_contract(K.contract_report(good, ["id", "v"], "v", 0.0, 5.5))
    outside = K.contract_report(good, ["id", "v"], "v", 0.0, 5.0)
    assert outside.first().status == "failed"
    with pytest.raises(K.ContractError):
        K.enforce_contract(outside)
    assert K.contract_report(gaps, ["id", "v", "s"], "v", 0, 10).first().missing_cells == 3
    assert not K.contract_report(gaps, ["id", "v", "s"], "s", 0, 10).first().label_numeric


def test_missing_label_is_out_of_range(gaps):
    found = {r.id: r.ok for r in gaps.select("id", K.in_range(F.col("v"), 0, 5).alias("ok")).collect()}
    assert found == {1: True, 2: False, 3: False, 4: False}


def test_enforced_schema(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    out = K.enforce_schema(df, StructType().add("c", DoubleType()).add("a", LongType()))
    assert out.dtypes == [("c", "double"), ("a", "bigint")]
    with pytest.raises(K.ContractError, match="z is missing"):
        K.enforce_schema(df, StructType().add("z", StringType()))
    with pytest.raises(K.ContractError, match="c is double, expected int"):
        K.enforce_schema(df, StructType().add("c", IntegerType()))


def test_signature(gaps):
    rows = [(r.name, r.type, r.required) for r in K.infer_signature(gaps).orderBy("position").collect()]
    assert rows == [("id", "int", True), ("v", "double", False), ("s", "string", False)]


def test_row_rules(spark):
    df = spark.createDataFrame([(6.9, 3.1), (-6.9, 3.1), (None, 0.0)], "sepal_length double, sepal_width double")
    checked = K.check_rows(df, [K.positive_rule(c) for c in df.columns])
    assert [r.errors for r in checked.collect()] == [
        [], ["sepal_length must be positive"], ["sepal_length is required", "sepal_width must be positive"]
    ]
    good, bad = K.accepted_and_rejected(checked)
    assert (good.count(), bad.count(), good.columns) == (1, 2, df.columns)


def test_optional_email(spark):
    df = spark.createDataFrame([(None,), ("a.b@c.org",), ("no",), ("a@b",)], "m string")
    assert [r.accepted for r in K.check_rows(df, [K.optional_email_rule("m")]).collect()] == [True, True, False, False]


def test_band_gate_is_strict(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (None,)], "rmse double")
    assert [r.status for r in K.band_gate(df, "rmse", 0, 2).collect()] == ["failed", "passed", "failed", "failed"]
    with pytest.raises(K.ContractError):
        K.require_band(K.band_gate(df.limit(1), "rmse", 0, 2), "rmse")


def test_branch_by_rows(spark):
    assert K.minimum_rows(spark.range(19), 20).first().branch == "skip_monitoring"
    assert K.minimum_rows(spark.range(20), 20).first().branch == "monitoring_done"
    with pytest.raises(Exception, match="at least 5"):
        K.require_rows(spark.range(3), 5)

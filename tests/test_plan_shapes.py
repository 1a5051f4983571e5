"""Physical plans: what is read, what is shuffled, what stays in generated code."""

import re

import pytest

from __spark_entry__ import queries
from tests.conftest import plan_of


@pytest.fixture
def plan(spark, folder):
    return lambda name: plan_of(queries()[name](spark, folder))


def columns_read(plan):
    return [set(re.findall(r"(\w+):", schema)) for schema in re.findall(r"ReadSchema: struct<(.*?)>(?:\n|$)", plan)]


@pytest.mark.parametrize(
    "name",
    ["hash_split", "exact_split", "ordered_halves", "seeded_sample", "scored_by_expression", "row_rules", "schema_enforced", "scaled_columns",
     "rouge2_scores", "reading_grades", "image_payloads", "champion_versions", "residuals", "listed_users", "indicator_columns"],
)
def test_row_local_queries_do_not_shuffle(plan, name):
    shown = plan(name)
    assert "Exchange hashpartitioning" not in shown and "Exchange SinglePartition" not in shown and "rangepartitioning" not in shown


@pytest.mark.parametrize("name", ["best_prompt", "newest_run", "first_events", "last_predictions"])
def test_top_rows_are_not_a_full_sort(plan, name):
    shown = plan(name)
    assert "TakeOrderedAndProject" in shown and "Exchange rangepartitioning" not in shown


@pytest.mark.parametrize(
    ("name", "columns"),
    [
        ("regression_metrics", {"l_quantity", "l_extendedprice", "l_returnflag"}),
        ("drift_between_periods", {"l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_shipdate"}),
        ("request_rate", {"ts"}),
        ("hash_split", {"event_id"}),
        ("newest_run_per_experiment", {"o_custkey", "o_orderkey", "o_orderdate"}),
    ],
)
def test_only_needed_columns_are_read(plan, name, columns):
    read = columns_read(plan(name))
    assert read and all(r <= columns for r in read)


@pytest.mark.parametrize(
    ("name", "pushed"),
    [
        ("drift_between_periods", "LessThan(l_shipdate"),
        ("complete_rows", "IsNotNull(l_extendedprice)"),
        ("prompt_starts", "EqualTo(role,user)"),
    ],
)
def test_filters_reach_the_scan(plan, name, pushed):
    assert any(pushed in part for part in re.findall(r"PushedFilters: \[(.*?)\],? ReadSchema", plan(name), re.S))


@pytest.mark.parametrize("name", ["regression_metrics", "averaged_metrics", "roc_auc", "drift_between_periods", "rouge2_scores", "ranking_metrics"])
def test_metrics_stay_out_of_python(plan, name):
    shown = plan(name)
    assert "Python" not in shown and "Pandas" not in shown

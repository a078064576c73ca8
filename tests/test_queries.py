"""Registered queries against their SQL, and the shape of their plans."""

import contextlib
import io

import pytest

import __spark_entry__ as contract
from check import compare, database

SMALL = "/root/testdata/sf0.001"
NAMES = (
    "finance_clean_elt", "upi_clean_elt", "finance_clean_etl", "merchant_category_analysis",
    "time_based_spending_patterns", "mart_age_spending_behavior", "mart_savings_opportunity",
    "mart_merchant_performance", "joined_features_etl", "fact_spending_pattern", "v_top_savings_opportunities",
    "star_fact_upi_transaction", "global_checks",
)


@pytest.mark.parametrize("name", NAMES)
def test_same_rows_as_sql(spark, name):
    ok, text = compare(spark, database(SMALL), name, SMALL)
    assert ok, text


def test_every_oracle_has_its_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())
    without = set(contract.queries()) - set(contract.oracle_sql())
    assert without <= set(contract._LLM_QUERIES)  # all others have SQL; those without it are tested against brute force in tests/llm


def test_entry_has_rows(spark):
    assert contract.entry(spark).count() > 0


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@pytest.mark.parametrize("name", ["mart_age_spending_behavior", "mart_savings_opportunity", "integrated_spending_savings"])
def test_plans_make_no_pairs(spark, name):
    plan = plan_of(contract.queries()[name](spark, SMALL))
    for word in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "SortMergeJoin"):
        assert word not in plan
    assert plan.count("BroadcastHashJoin Inner") >= 1
    # only the orders columns in use are read
    assert "o_orderpriority" not in plan


def test_filters_reach_the_scan(spark):
    assert "EqualTo(o_orderstatus,P)" in plan_of(contract.queries()["src_parquet"](spark, SMALL))

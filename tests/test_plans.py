"""What the physical plans must and must not contain."""

from __future__ import annotations

import re

import pytest

from spendscore.operators import gold, reports, silver, text, windows
from spendscore.plans.queries import QUERIES
from spendscore.sources import fixtures

SF = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def executed_plan(df):
    """The plan as adaptive execution left it."""
    df._jdf.queryExecution().executedPlan().execute().count()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def debit(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("debit") / "table")
    QUERIES["categorize"](spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="module")
def salary(spark):
    return fixtures.salary_income(spark, SF)


WRITERS = ("stream_", "table_", "layered_", "bronze_statements_csv")
BATCH = sorted(name for name in QUERIES if not name.startswith(WRITERS))


@pytest.mark.parametrize("name", BATCH)
def test_no_python_no_cross_join_no_row_source(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"EvalPython|InPandas|InArrow|CartesianProduct|BroadcastNestedLoopJoin", plan)
    assert "ExistingRDD" not in plan


def test_features_take_two_shuffles_that_combine_first(debit):
    plan = plan_of(gold.customer_features(debit))
    assert plan.count("Exchange") == 2
    assert plan.count("partial_") >= 2
    assert "ReadSchema: struct<customer_id:int,txn_date:date,amount:double,category:string>" in plan


def test_score_and_audit_add_no_shuffle_beyond_the_salary(debit, salary):
    features = plan_of(gold.customer_features(debit)).count("Exchange")
    spark = debit.sparkSession
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(gold.add_audit(gold.gold_score(debit, salary)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert plan.count("Exchange") == features + 1


def test_each_merchant_is_matched_after_one_shuffle(debit):
    plan = plan_of(text.nearest_category(debit))
    assert plan.count("Exchange hashpartitioning") == 2  # the count and its reuse


def test_pivot_with_months_runs_no_extra_job(debit):
    tracker = debit.sparkSession.sparkContext.statusTracker()
    debit.sparkSession.sparkContext.setJobGroup("pivot", "pivot")
    try:
        silver.pivot_months(silver.monthly_spend(debit), ["1995_Jan"], "sum")
        assert len(tracker.getJobIdsForGroup("pivot")) == 0
    finally:
        debit.sparkSession.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_nothing_is_read_for_heavy_keys_where_there_are_none(debit):
    plan = executed_plan(windows.rolling_rows(debit))
    assert "Union" not in plan
    assert executed_plan(windows.rolling_rows(debit, hot_rows=5)).count("Union") > 0


def test_box_plot_shuffles_counts_and_narrow_ranges_only(debit, salary):
    score = gold.gold_score(debit, salary)
    plan = plan_of(reports.spend_boxstats(score))
    assert "percentile(" not in plan and "collect_" not in plan


def test_top_spenders_sort_in_place(debit, salary):
    assert "TakeOrderedAndProject" in plan_of(reports.top_spenders(gold.gold_score(debit, salary)))


def test_pivot_shuffles_narrow_rows_and_sorts_names_once(debit):
    """Cells of names come together by one shuffle without an aggregate before it; a row per month goes to its customer."""
    plan = plan_of(silver.pivot_months(silver.monthly_spend(debit), ["1995_Jan", "1995_Feb"], "first"))
    assert "pivotfirst" not in plan[plan.index("Exchange"):]
    assert plan.count("Exchange") == 3
    names = [line for line in plan.splitlines() if "min_by" in line]
    assert len(names) == 2 and "Exchange" not in plan[plan.index(names[0]):plan.index(names[1])]

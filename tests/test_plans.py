"""What the physical plans must and must not contain."""

import re

import pytest
from conftest import SF
from pyspark.sql import functions as F

from trisect.catalog.queries import QUERIES
from trisect.operators.split import SplitSpec, split


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "split_random_stratified", "split_time_fraction", "split_metric", "split_within_group", "stability_report",
    "roc_auc_ovr_weighted", "ecdf", "box_summary", "score_deciles", "eda_univariate",
])
def test_no_python_in_the_plan(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|FlatMapGroups|CartesianProduct|BroadcastNestedLoop", plan)


@pytest.mark.parametrize("name", ["split_time_fraction", "split_time_cut", "split_metric", "split_random_hash"])
def test_assignment_of_a_whole_table_moves_no_rows(spark, name):
    assert "Exchange" not in plan_of(QUERIES[name](spark, SF))


@pytest.mark.parametrize("name", ["split_random_stratified", "split_within_group"])
def test_assignment_within_groups_only_broadcasts_the_cuts(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert re.findall(r"(\w*Exchange)\b(?! SinglePartition)", plan).count("BroadcastExchange") == 1
    assert "Exchange hashpartitioning" not in plan


def test_only_needed_columns_are_read(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assigned = split(orders, SplitSpec("metric", metric="o_totalprice"))
    plan = plan_of(assigned.groupBy("subset").agg(F.count("*")))
    assert "ReadSchema: struct<o_totalprice:double>" in plan


def test_subset_filter_on_a_cut_is_not_blocked_by_the_split(spark):
    orders = spark.read.parquet(f"{SF}/orders.parquet")
    assigned = split(orders, SplitSpec("time", time="o_orderdate", train="1998-01-01", test="2000-01-01"))
    assert "Exchange" not in plan_of(assigned.where("subset = 'train'").select("o_orderkey"))

"""What the physical plans must and must not contain."""

import re

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
DATA_PLANS = [
    "features_corrected",
    "features_reference",
    "features_full_history",
    "churn_labels",
    "train_set",
    "asof_weekly_bucketed",
    "customer_spine",
    "completed_order_items",
    "last_order_to_date",
]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", DATA_PLANS)
def test_no_products_of_tables_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "ArrowEval" not in text


@pytest.mark.parametrize("name", ["features_corrected", "features_reference", "train_set"])
def test_filters_and_columns_reach_the_scan(spark, name):
    text = plan(entry.queries()[name](spark, FOLDER))
    scans = re.findall(r"FileScan parquet \[([^\]]*)\].*?/(\w+)\.parquet\].*?PushedFilters: \[([^\]]*)\]", text)
    seen = {}
    for columns, table, filters in scans:
        seen.setdefault(table, []).append((columns, filters))
    assert set(seen) == {"orders", "lineitem", "part"}
    for columns, filters in seen["orders"]:
        assert "EqualTo(o_orderstatus,F)" in filters and "GreaterThanOrEqual(o" in filters
        assert "o_totalprice" not in columns
    for columns, _ in seen["lineitem"]:
        assert len(columns.split(",")) == 3


def test_training_set_joins_without_another_shuffle(spark):
    """Labels and features leave their windows partitioned by customer; the as-of run reuses that."""
    text = plan(entry.queries()["train_set"](spark, FOLDER))
    top = text[: text.index("Union")]
    assert "Exchange" not in top and "Window" in top


def test_raw_rows_are_aggregated_before_every_shuffle(spark):
    """Without broadcasts, each exchange above the source joins carries grouped rows."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(entry.queries()["features_corrected"](spark, FOLDER))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" not in text and "SortMergeJoin" in text
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", text)
    names = [tuple(re.sub(r"#\d+L?", "", k).strip() for k in key.split(",")[:-1]) for key in keys]
    assert ("customer_id",) in names
    assert ("customer_id", "product_id", "order_date") in names or (
        "customer_id", "product_id", "day") in names
    assert text.count("partial_sum") >= 3


def test_latest_is_a_hash_aggregate(spark):
    text = plan(entry.queries()["latest_per_key"](spark, FOLDER))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text

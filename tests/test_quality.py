from datetime import datetime

import pytest
from local import frame

from lapsewise import BuildConfig
from lapsewise.plans import quality

CFG = BuildConfig(as_of=datetime(2024, 6, 30).date())
LABELS = f"customer_id bigint, label_timestamp timestamp_ntz, {CFG.label_column} bigint"


def labels(spark, ones, zeros):
    day = datetime(2024, 1, 1)
    rows = [(i, day, 1) for i in range(ones)] + [(1000 + i, day, 0) for i in range(zeros)]
    return frame(spark, rows, LABELS)


@pytest.mark.parametrize(
    "ones, zeros, status, rate",
    [
        (0, 7, quality.STATUS_ALL_ZERO, 0.0),
        (7, 0, quality.STATUS_ALL_ONE, 100.0),
        (4, 96, quality.STATUS_LOW, 4.0),
        (5, 95, quality.STATUS_OK, 5.0),
        (95, 5, quality.STATUS_OK, 95.0),
        (96, 4, quality.STATUS_HIGH, 96.0),
        (1, 2, quality.STATUS_OK, 33.33),
        (0, 0, quality.STATUS_OK, None),
    ],
)
def test_label_status(spark, ones, zeros, status, rate):
    row = quality.label_distribution(labels(spark, ones, zeros), CFG).first()
    assert row["status"] == status and row["churn_rate_pct"] == rate
    assert row["total_rows"] == ones + zeros


def test_label_patterns(spark):
    day = datetime(2024, 1, 1)
    rows = [(1, day, 0), (1, datetime(2024, 1, 2), 1), (2, day, 0), (3, day, None)]
    row = quality.customer_label_patterns(frame(spark, rows, LABELS), CFG).first()
    assert tuple(row)[1:] == (3, 1, 2)


def test_reports_on_empty_tables(spark):
    fields = ", ".join(
        f"{c} {'double' if c.startswith(('rev', 'avg')) else 'bigint'}" for c in CFG.feature_columns
    )
    features = frame(spark, [], f"customer_id bigint, feature_timestamp timestamp_ntz, {fields}")
    train = frame(spark, 
        [], f"customer_id bigint, label_timestamp timestamp_ntz, {fields}, {CFG.label_column} bigint"
    )
    none = labels(spark, 0, 0)
    nulls = quality.feature_null_rates(features, CFG).first()
    assert nulls["total_rows"] == 0 and nulls["orders_30d_null_pct"] is None
    assert quality.training_quality(train, CFG).first()["total_rows"] == 0
    assert quality.feature_means(train, CFG).first()["avg_orders_30d"] is None
    assert [r["date_range_days"] for r in quality.date_ranges(features, none, train).collect()] == [None] * 3
    assert tuple(quality.customer_label_patterns(none, CFG).first())[1:] == (0, 0, 0)


def test_split_bias(spark):
    rows = [("train", 1)] * 96 + [("train", 0)] * 4 + [("test", 1)] * 95 + [("test", 0)] * 5
    df = frame(spark, rows, f"split string, {CFG.label_column} bigint")
    got = {r["split"]: (r["positive_rate"], r["biased"]) for r in quality.split_label_bias(df, CFG).collect()}
    assert got == {"train": (0.96, True), "test": (0.95, False)}

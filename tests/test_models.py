import random

import pytest
from local import frame
from pyspark.sql import functions as F

from lapsewise.plans import models
from lapsewise.plans.metrics import evaluation_report

FEATURES = ["x", "y"]
DDL = "customer_id bigint, x double, y double, label bigint"


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(1)
    rows = []
    for i in range(400):
        x, y = rng.random(), rng.random()
        rows.append((i, None if i % 40 == 0 else x, y, int(x + 0.1 * rng.random() > 0.5)))
    return frame(spark, rows, DDL)


def probabilities(df, model):
    return {r[0]: r[1] for r in models.score(df, model, FEATURES).select("customer_id", "churn_probability").collect()}


@pytest.fixture(scope="module")
def forest(data):
    return models.fit_random_forest(data, FEATURES, "label", n_estimators=10, max_depth=4)


def test_forest(spark, data, forest, tmp_path):
    first = probabilities(data, forest)
    assert all(0.0 <= p <= 1.0 for p in first.values()) and len(first) == 400
    again = models.fit_random_forest(data, FEATURES, "label", n_estimators=10, max_depth=4)
    assert probabilities(data, again) == first
    models.save_model(forest, str(tmp_path / "m"))
    assert probabilities(data, models.load_model(str(tmp_path / "m"))) == first
    report = evaluation_report(models.score(data, forest, FEATURES), "churn_probability", "label", "train")
    assert report.first()["roc_auc"] > 0.9
    weights = models.feature_weights(spark, forest).collect()
    assert [r["feature"] for r in weights] == ["x", "y"]
    assert sum(r["weight"] for r in weights) == pytest.approx(1.0)
    meta = models.model_metadata(spark, forest, "label").first()
    assert (meta["model_type"], meta["n_estimators"], meta["max_depth"]) == ("random_forest", 10, 4)


def handed_to_fit(monkeypatch, train):
    """The rows that the forest is grown on, by partition."""
    handed, fit = [], models._fit
    monkeypatch.setattr(models, "_fit", lambda e, rows, *names: handed.append(rows) or fit(e, rows, *names))
    model = models.fit_random_forest(train, FEATURES, "label", n_estimators=3, max_depth=3)
    monkeypatch.setattr(models, "_fit", fit)
    parts = {}
    for p, *row in handed[0].select(F.spark_partition_id(), *FEATURES, "label").collect():
        parts.setdefault(p, []).append(tuple(row))
    return model, [parts[p] for p in sorted(parts)]


def test_forest_rows_are_dealt_evenly(spark, data, monkeypatch):
    monkeypatch.setattr(models, "TASK_ROWS", 50, raising=False)
    coarse = data.withColumn("y", F.round("y", 1))  # fewer values than x, so it leads the order
    model, parts = handed_to_fit(monkeypatch, coarse.coalesce(1))
    assert [len(p) for p in parts] == [50] * 8
    assert all(p == sorted(p, key=lambda r: (r[1], r[0], r[2])) for p in parts)
    want = models.model_input(coarse, FEATURES, "label").select(*FEATURES, "label").collect()
    assert sorted(r for p in parts for r in p) == sorted(map(tuple, want))
    again, _ = handed_to_fit(monkeypatch, coarse.coalesce(1))
    assert probabilities(coarse, again) == probabilities(coarse, model)


def test_forest_rows_in_even_tasks_stay_as_they_are(spark, data, monkeypatch):
    _, (rows,) = handed_to_fit(monkeypatch, data.coalesce(1))
    assert rows == [tuple(r) for r in models.model_input(data.coalesce(1), FEATURES, "label").collect()]
    monkeypatch.setattr(models, "TASK_ROWS", 100)
    even = data.repartitionByRange(5, "customer_id").sortWithinPartitions("customer_id")
    _, parts = handed_to_fit(monkeypatch, even)
    assert len(parts) == 5
    kept = models.model_input(even, FEATURES, "label").collect()
    assert [r for p in parts for r in p] == [tuple(r) for r in kept]


def test_logistic_regression(spark, data):
    model = models.fit_logistic_regression(data, FEATURES, "label")
    report = evaluation_report(models.score(data, model, FEATURES), "churn_probability", "label", "train")
    assert report.first()["roc_auc"] > 0.9
    assert models.model_metadata(spark, model, "label").first()["n_estimators"] is None
    assert models.feature_weights(spark, model).first()["feature"] == "x"


def test_missing_values_and_columns_count_as_zero(spark, data, forest):
    nulls = frame(spark, [(1, None, 0.7), (2, float("nan"), 0.7), (3, 0.0, 0.7)], "customer_id bigint, x double, y double")
    got = probabilities(nulls, forest)
    assert got[1] == got[2] == got[3]
    assert probabilities(nulls.drop("x"), forest)[3] == got[3]


def test_model_input_checks(spark, data):
    with pytest.raises(ValueError, match="feature"):
        models.model_input(data, ["x", "z"], "label")
    with pytest.raises(ValueError, match="label"):
        models.model_input(data, FEATURES, "target")
    row = models.model_input(frame(spark, [(1, None, 2.0, None)], DDL), FEATURES, "label").first()
    assert (row["x"], row["y"], row["label"]) == (0.0, 2.0, None)


def test_failed_fetches_get_no_score(spark, forest):
    fetched = frame(
        spark,
        [(1, 0.2, 0.3, "success", None), (2, None, None, "error", "no features for this key")],
        "customer_id bigint, x double, y double, status string, error string",
    )
    got = {r["customer_id"]: r for r in models.score_customers(fetched, forest, FEATURES).collect()}
    assert got[1]["churn_probability"] is not None
    assert got[2]["churn_probability"] is None and got[2]["status"] == "error"

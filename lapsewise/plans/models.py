"""Classifiers on the training set, with Spark ML."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.sources import scratch_path

VECTOR = "_features"
#: Rows of a task that grows trees: at most, and at least where cores would stay idle.
TASK_ROWS, LEAST_TASK_ROWS = 500_000, 25_000


def model_input(df: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Features and label; missing feature values become 0, labels stay as they are."""
    missing = [c for c in features if c not in df.columns]
    if missing:
        raise ValueError(f"missing feature columns: {missing}")
    if label not in df.columns:
        raise ValueError(f"label column not found: {label}")
    return df.select(*(F.col(c).cast("double").alias(c) for c in features), label).fillna(
        0.0, subset=list(features)
    )


def deal_evenly(data: DataFrame, features: Sequence[str], label: str) -> DataFrame:
    """Features and label in tasks of about as many rows, where they are not so already.

    A forest takes every row down all trees once a level and keeps some 500 bytes of it,
    so its tasks must be cut by rows, where files are cut by bytes.  Rows that are dealt
    anew are ordered: like rows pass the same nodes one after another, whose statistics
    then stay in the processor's cache.  Features of few values lead the order, as one of
    many leaves the next unordered.  Rows that tie are equal, so the order is repeatable,
    and with it the bootstrap.
    """
    sizes = data.groupBy(F.spark_partition_id().alias("_task")).agg(F.count(F.lit(1)).alias("_rows"))
    rows, largest = sizes.agg(F.coalesce(F.sum("_rows"), F.lit(0)), F.coalesce(F.max("_rows"), F.lit(0))).first()
    cores = data.sparkSession.sparkContext.defaultParallelism
    if largest <= min(TASK_ROWS, 1.5 * max(rows / cores, LEAST_TASK_ROWS)):
        return data
    tasks = max(math.ceil(rows / TASK_ROWS), min(cores, math.ceil(rows / LEAST_TASK_ROWS)))
    values = data.agg(*(F.approx_count_distinct(c).alias(f"_{c}") for c in features)).first()
    few_first = [c for _, c in sorted(zip(values, features), key=lambda pair: pair[0])]
    return data.repartition(tasks).sortWithinPartitions(*few_first, label)


def fit_random_forest(
    train: DataFrame,
    features: Sequence[str],
    label: str,
    n_estimators: int = 100,
    max_depth: int = 10,
    min_samples_leaf: int = 2,
    seed: int = 42,
) -> PipelineModel:
    """Random forest with square-root feature subsets and Gini impurity.

    Spark has no minimum split size; a leaf minimum of 2 implies a split of 4.
    """
    forest = RandomForestClassifier(
        featuresCol=VECTOR,
        labelCol=label,
        numTrees=n_estimators,
        maxDepth=max_depth,
        minInstancesPerNode=min_samples_leaf,
        featureSubsetStrategy="sqrt",
        impurity="gini",
        seed=seed,
    )
    data = model_input(train, features, label)
    return _fit(forest, deal_evenly(data, features, label), features, label)


def fit_logistic_regression(
    train: DataFrame, features: Sequence[str], label: str, max_iter: int = 1000
) -> PipelineModel:
    """Logistic regression with a unit L2 penalty on the summed loss.

    Spark minimises the mean loss, so that penalty is 1 / rows.
    """
    regression = LogisticRegression(
        featuresCol=VECTOR,
        labelCol=label,
        maxIter=max_iter,
        standardization=False,
        regParam=1.0 / max(train.count(), 1),
    )
    return _fit(regression, model_input(train, features, label), features, label)


def _fit(estimator, data: DataFrame, features: Sequence[str], label: str) -> PipelineModel:
    assembler = VectorAssembler(inputCols=list(features), outputCol=VECTOR)
    data = data.withColumn(label, F.col(label).cast("double"))
    model = Pipeline(stages=[assembler, estimator]).fit(data)
    # A fresh model carries its training summary, and with that the session and
    # the training plan, into every scoring task.  The stored copy does not.
    path = scratch_path(data.sparkSession, "model")
    save_model(model, path)
    return load_model(path)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def feature_weights(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """``(feature, weight)``, heaviest first: importances, or coefficients by size."""
    names = model.stages[0].getInputCols()
    fitted = model.stages[-1]
    if hasattr(fitted, "featureImportances"):
        weights = fitted.featureImportances.toArray()
    else:
        weights = fitted.coefficients.toArray()
    rows = [(n, float(w)) for n, w in zip(names, weights)]
    frame = spark.createDataFrame(rows, "feature string, weight double")
    return frame.orderBy(F.desc(F.abs("weight")), "feature")


def model_metadata(spark: SparkSession, model: PipelineModel, label: str) -> DataFrame:
    """One row on the model: kind, columns, parameters, weights."""
    names = list(model.stages[0].getInputCols())
    fitted = model.stages[-1]
    is_forest = hasattr(fitted, "featureImportances")
    weights = fitted.featureImportances if is_forest else fitted.coefficients
    row = (
        "random_forest" if is_forest else "logistic_regression",
        names,
        label,
        fitted.getNumTrees if is_forest else None,
        fitted.getOrDefault("maxDepth") if is_forest else None,
        dict(zip(names, (float(w) for w in weights.toArray()))),
        spark.version,
    )
    schema = (
        "model_type string, feature_columns array<string>, label_column string, "
        "n_estimators int, max_depth int, feature_weights map<string,double>, spark_version string"
    )
    return spark.createDataFrame([row], schema)


def score(
    df: DataFrame, model: PipelineModel, features: Sequence[str], output: str = "churn_probability"
) -> DataFrame:
    """Adds the probability of class 1; absent or missing features count as 0."""
    filled = df.select(
        "*",
        *(
            F.coalesce(F.nanvl(F.col(c).cast("double"), F.lit(0.0)), F.lit(0.0)).alias(f"_in_{c}")
            if c in df.columns
            else F.lit(0.0).alias(f"_in_{c}")
            for c in features
        ),
    )
    assembler = VectorAssembler(inputCols=[f"_in_{c}" for c in features], outputCol=VECTOR)
    scored = model.stages[-1].transform(assembler.transform(filled))
    return scored.select(
        *df.columns, vector_to_array("probability").getItem(1).alias(output)
    )


def score_customers(
    fetched: DataFrame, model: PipelineModel, features: Sequence[str], key: str = "customer_id"
) -> DataFrame:
    """Scores for fetched customers; failed fetches keep their error and get no score."""
    scored = score(fetched, model, features)
    found = F.col("status") == "success"
    return scored.select(
        key, F.when(found, F.col("churn_probability")).alias("churn_probability"), "status", "error"
    )

"""The whole build: three stored tables and their report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.plans import quality
from lapsewise.plans.features import feature_snapshots
from lapsewise.plans.labels import churn_labels
from lapsewise.plans.training import training_set
from lapsewise.sources import (
    VersionedTable,
    build_report,
    completed_order_items,
    completed_orders,
)


@dataclass(frozen=True)
class Tables:
    features: DataFrame
    labels: DataFrame
    train: DataFrame


def _measures(cfg: BuildConfig) -> dict[str, dict[str, Column]]:
    """What is measured of each table while it is written."""
    rows = {"total_rows": F.count(F.lit(1))}
    ranges = {name: quality.range_measures(name) for name in quality.TIMES}
    return {
        "features_customer": {**ranges["features_customer"], **quality.null_measures(cfg)},
        "labels_customer_churn": {**ranges["labels_customer_churn"], **quality.label_measures(cfg)},
        "train_dataset": {**ranges["train_dataset"], **quality.mean_measures(cfg), **rows},
    }


def build_tables(
    orders: DataFrame, items: DataFrame, products: DataFrame, cfg: BuildConfig, path: str
) -> Tables:
    """Rebuild features, labels and training set under ``path``, each from stored inputs.

    Each table is replaced in one step, and measured in the job that writes it.
    """
    measures = _measures(cfg)

    def stored(df: DataFrame, name: str) -> DataFrame:
        return VersionedTable(df.sparkSession, f"{path.rstrip('/')}/{name}").replace(df, measures=measures[name])

    orders_view = completed_orders(orders, cfg)
    items_view = completed_order_items(items, orders, cfg)
    features = stored(feature_snapshots(orders_view, items_view, products, cfg), "features_customer")
    labels = stored(churn_labels(orders_view, cfg), "labels_customer_churn")
    train = stored(training_set(labels, features, cfg), "train_dataset")
    return Tables(features, labels, train)


def tables_report(spark: SparkSession, path: str) -> DataFrame:
    names = ("features_customer", "labels_customer_churn", "train_dataset")
    return build_report(spark, {n: f"{path.rstrip('/')}/{n}" for n in names})


@dataclass(frozen=True)
class MeasuredReports:
    """The quality reports that are plain aggregates, of the tables of a build under ``path``.

    They come from what the build measured: no table is read.
    """

    spark: SparkSession
    path: str
    cfg: BuildConfig

    def _row(self, table: str, names: Iterable[str], kind: str = "bigint") -> DataFrame:
        found = VersionedTable(self.spark, f"{self.path.rstrip('/')}/{table}")
        return found.measured({n: "decimal(38,0)" if n.startswith("sum_") else kind for n in names})

    def label_distribution(self) -> DataFrame:
        row = self._row("labels_customer_churn", quality.label_measures(self.cfg))
        return quality.label_distribution_of(row)

    def feature_null_rates(self) -> DataFrame:
        row = self._row("features_customer", quality.null_measures(self.cfg))
        return quality.feature_null_rates_of(row, self.cfg)

    def feature_means(self) -> DataFrame:
        return quality.feature_means_of(self._row("train_dataset", quality.mean_measures(self.cfg)), self.cfg)

    def date_ranges(self) -> DataFrame:
        rows = {t: self._row(t, quality.range_measures(t), "timestamp_ntz") for t in quality.TIMES}
        return quality.date_ranges_of(rows)

    def row_counts(self) -> DataFrame:
        """As ``tables_report``."""
        parts = [
            self._row(t, ["total_rows"]).select(
                F.lit(t).alias("table_name"), F.col("total_rows").alias("num_rows"), F.lit("present").alias("status")
            )
            for t in quality.TIMES
        ]
        return reduce(DataFrame.unionByName, parts)

"""Data-quality reports.  Each is one aggregation; rates are rounded exactly.

The reports that are plain aggregates of a table come in two steps: the aggregates
(``..._measures``, by name) and the report on a row of them (``..._of``).  So they can be
taken while the table is written, and the report reads no row of it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.functions import from_cents, percentage, ratio, round_half_up

# Report names and status texts.
LABEL_DISTRIBUTION = "1_label_distribution"
FEATURE_NULL_RATE = "2_feature_null_rate"
TRAIN_DATA_QUALITY = "3_train_data_quality"
DATE_RANGE = "4_date_range"
FEATURE_STATS = "5_feature_stats"
CUSTOMER_LABEL_PATTERNS = "6_customer_label_patterns"
STATUS_ALL_ZERO = "WARNING: All labels are 0 (no churn)"
STATUS_ALL_ONE = "WARNING: All labels are 1 (all churn)"
STATUS_LOW = "WARNING: Churn rate < 5%"
STATUS_HIGH = "WARNING: Churn rate > 95%"
STATUS_OK = "OK: Balanced distribution"


def _named(check: str) -> Column:
    return F.lit(check).alias("check_name")


def _aggregated(df: DataFrame, measures: Mapping[str, Column]) -> DataFrame:
    return df.agg(*(m.alias(name) for name, m in measures.items()))


def label_measures(cfg: BuildConfig) -> dict[str, Column]:
    label = F.col(cfg.label_column)
    return {"total_rows": F.count(F.lit(1)), "labelled": F.count(label), "churned_count": F.sum(label)}


def label_distribution(labels: DataFrame, cfg: BuildConfig) -> DataFrame:
    return label_distribution_of(_aggregated(labels, label_measures(cfg)))


def label_distribution_of(totals: DataFrame) -> DataFrame:
    churned, labelled = F.col("churned_count"), F.col("labelled")
    # Compared as integers: 5 % is churned * 20 = labelled.  On no rows every
    # test is null and the last branch answers.
    status = (
        F.when(churned == 0, STATUS_ALL_ZERO)
        .when(churned == labelled, STATUS_ALL_ONE)
        .when(churned * 20 < labelled, STATUS_LOW)
        .when(churned * 20 > labelled * 19, STATUS_HIGH)
        .otherwise(STATUS_OK)
    )
    return totals.select(
        _named(LABEL_DISTRIBUTION),
        "total_rows",
        "churned_count",
        (F.col("total_rows") - churned).alias("retained_count"),
        percentage(churned, labelled).alias("churn_rate_pct"),
        status.alias("status"),
    )


def _null_checked(cfg: BuildConfig) -> list[str]:
    """Every feature but the two distinct counts."""
    return [c for c in cfg.feature_columns if not c.startswith("distinct_")]


def null_measures(cfg: BuildConfig) -> dict[str, Column]:
    return {"total_rows": F.count(F.lit(1)), **{f"known_{c}": F.count(c) for c in _null_checked(cfg)}}


def feature_null_rates(features: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Null share of every feature but the two distinct counts."""
    return feature_null_rates_of(_aggregated(features, null_measures(cfg)), cfg)


def feature_null_rates_of(totals: DataFrame, cfg: BuildConfig) -> DataFrame:
    total = F.col("total_rows")
    return totals.select(
        _named(FEATURE_NULL_RATE),
        "total_rows",
        *(percentage(total - F.col(f"known_{c}"), total).alias(f"{c}_null_pct") for c in _null_checked(cfg)),
    )


def training_quality(train: DataFrame, cfg: BuildConfig) -> DataFrame:
    orders, label = cfg.feature_columns[1], cfg.label_column
    # Per customer first: the distinct count becomes a plain count, and the
    # shuffle carries one row per customer and map task.
    per_customer = train.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count(orders).alias("with_feature"),
        F.count(label).alias("labelled"),
        F.sum(label).alias("churned"),
    )
    totals = per_customer.agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("total_rows"),
        F.count("customer_id").alias("unique_customers"),
        F.sum("with_feature").alias("with_feature"),
        F.sum("labelled").alias("labelled"),
        F.sum("churned").alias("churned"),
    )
    total = F.col("total_rows")
    return totals.select(
        _named(TRAIN_DATA_QUALITY),
        "total_rows",
        "unique_customers",
        percentage(total - F.col("with_feature"), total).alias("feature_null_pct"),
        percentage(total - F.col("labelled"), total).alias("label_null_pct"),
        percentage(F.col("churned"), F.col("labelled")).alias("train_churn_rate_pct"),
    )


#: The tables of a build and their time columns, in the order of the report.
TIMES = {
    "features_customer": "feature_timestamp",
    "labels_customer_churn": "label_timestamp",
    "train_dataset": "label_timestamp",
}


def range_measures(table: str) -> dict[str, Column]:
    return {"min_date": F.min(TIMES[table]), "max_date": F.max(TIMES[table])}


def date_ranges(features: DataFrame, labels: DataFrame, train: DataFrame) -> DataFrame:
    tables = zip(TIMES, (features, labels, train))
    return date_ranges_of({name: _aggregated(df, range_measures(name)) for name, df in tables})


def date_ranges_of(bounds: Mapping[str, DataFrame]) -> DataFrame:
    """Of each table's row of bounds."""

    def one(name: str) -> DataFrame:
        days = F.datediff(F.to_date("max_date"), F.to_date("min_date")).cast("bigint")
        return bounds[name].select(
            _named(DATE_RANGE),
            F.lit(name).alias("table_name"),
            "min_date",
            "max_date",
            days.alias("date_range_days"),
        )

    return reduce(DataFrame.unionByName, map(one, TIMES))


def mean_measures(cfg: BuildConfig) -> dict[str, Column]:
    """Sums in hundredths, and counts."""

    def hundredths(name: str) -> Column:
        money = name.startswith(("revenue_", "avg_"))
        return (F.col(name).cast("decimal(30,2)" if money else "decimal(30,0)") * 100).cast(
            "decimal(34,0)"
        )

    sums = {f"sum_{c}": F.sum(hundredths(c)) for c in cfg.feature_columns}
    return {**sums, **{f"n_{c}": F.count(c) for c in cfg.feature_columns}}


def feature_means(train: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Mean of every feature with two decimals."""
    return feature_means_of(_aggregated(train, mean_measures(cfg)), cfg)


def feature_means_of(sums: DataFrame, cfg: BuildConfig) -> DataFrame:
    return sums.select(
        _named(FEATURE_STATS),
        *(
            from_cents(round_half_up(F.col(f"sum_{c}"), F.col(f"n_{c}"))).alias(
                c if c.startswith("avg_") else f"avg_{c}"
            )
            for c in cfg.feature_columns
        ),
    )


def customer_label_patterns(labels: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Customers in all, ever churned, and always retained."""
    churned = F.max(F.when(F.col(cfg.label_column) == 1, 1).otherwise(0))
    per_customer = labels.where(F.col("customer_id").isNotNull()).groupBy("customer_id").agg(
        churned.alias("ever")
    )
    totals = per_customer.agg(
        F.count(F.lit(1)).alias("total_customers"),
        F.coalesce(F.sum("ever"), F.lit(0)).alias("customers_with_churn"),
    )
    return totals.select(
        _named(CUSTOMER_LABEL_PATTERNS),
        "total_customers",
        "customers_with_churn",
        (F.col("total_customers") - F.col("customers_with_churn")).alias("always_retained_customers"),
    )


def split_label_bias(split_df: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Positive rate per split, flagged outside 5 % to 95 %."""
    label = F.col(cfg.label_column)
    counts = split_df.groupBy("split").agg(
        F.count(F.lit(1)).alias("samples"),
        F.count(label).alias("labelled"),
        F.sum(label).alias("positives"),
    )
    positives, labelled = F.col("positives"), F.col("labelled")
    return counts.select(
        "split",
        "samples",
        ratio(positives, labelled).alias("positive_rate"),
        ((positives * 20 < labelled) | (positives * 20 > labelled * 19)).alias("biased"),
    )

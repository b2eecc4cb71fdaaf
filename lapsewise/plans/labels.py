"""Churn labels per customer and day."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.functions import midnight
from lapsewise.operators import next_order_labels


def churn_labels(orders_view: DataFrame, cfg: BuildConfig) -> DataFrame:
    """1 when no order follows within ``churn_days``, else 0.

    Days run over the order dates as far as a full horizon remains, for
    customers with an order on or before the day.
    """
    return next_order_labels(orders_view, cfg).select(
        "customer_id",
        midnight(F.col("label_date")).alias("label_timestamp"),
        F.when(F.col("bought"), 0).otherwise(1).cast("bigint").alias(cfg.label_column),
    )

"""Point-in-time training set."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.operators import asof_join


def labels_with_features(
    labels: DataFrame, features: DataFrame, bucket: str | None = None
) -> DataFrame:
    """Each label row with the latest features not after it."""
    return asof_join(
        labels, features, ["customer_id"], "label_timestamp", "feature_timestamp", bucket=bucket
    )


def training_set(
    labels: DataFrame, features: DataFrame, cfg: BuildConfig, bucket: str | None = None
) -> DataFrame:
    """Label rows of active customers with their features.

    Activity is tested on the matched snapshot, after the match: an inactive
    newest snapshot drops the label, it does not fall back to an older one.
    """
    names = cfg.feature_columns
    orders, average = names[1], names[4]
    return (
        labels_with_features(labels, features, bucket)
        .where(F.col(orders) > 0)
        .select(
            "customer_id",
            "label_timestamp",
            "feature_timestamp",
            *(
                F.coalesce(F.col(c), F.lit(0.0)).alias(c) if c == average else F.col(c)
                for c in names
            ),
            cfg.label_column,
        )
    )

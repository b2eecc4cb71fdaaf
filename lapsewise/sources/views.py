"""Lazy views over the four commerce tables.

Expected columns: ``orders(order_id, user_id, status, created_at, num_of_item)``,
``order_items(id, order_id, user_id, product_id, sale_price, created_at)``,
``users(id, ...)`` and ``products(id, category)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.functions import day_sequence, lookback_start

USER_COLUMNS = ["first_name", "last_name", "email", "age", "gender", "country", "city"]


def sample_customers(df: DataFrame, rate: float, key: str = "customer_id") -> DataFrame:
    """A repeatable share ``rate`` of the customers, each with all of their rows.

    A customer is in when the digest of the key falls below the rate, so every
    table sampled with the same rate keeps the same customers.
    """
    if rate >= 1.0:
        return df
    limit = f"{int(rate * 2**32):08x}"
    return df.where(F.substring(F.md5(F.col(key).cast("string")), 1, 8) < limit)


def completed_orders(orders: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Completed orders from the lookback start on; there is no upper bound."""
    view = orders.where(
        (F.col("status") == cfg.complete_status)
        & (F.col("created_at") >= lookback_start(cfg.as_of, cfg.lookback_months))
    ).select(
        "order_id",
        F.col("user_id").alias("customer_id"),
        "status",
        "created_at",
        "num_of_item",
        F.to_date("created_at").alias("order_date"),
    )
    return sample_customers(view, cfg.sample_rate)


def completed_order_items(items: DataFrame, orders: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Items of completed orders, with the lookback on the item's own date.

    Item tables without ``user_id`` or ``created_at`` take them from their order
    in the same join, so no second pass over the orders is needed.
    """
    low = lookback_start(cfg.as_of, cfg.lookback_months)
    borrowed = [c for c in ("user_id", "created_at") if c not in items.columns]
    parents = orders.where(F.col("status") == cfg.complete_status).select("order_id", *borrowed)
    if "created_at" in borrowed:
        parents = parents.where(F.col("created_at") >= low)
    else:
        items = items.where(F.col("created_at") >= low)
    item_id = [F.col("id").alias("item_id")] if "id" in items.columns else []
    view = items.join(parents, "order_id").select(
        *item_id,
        "order_id",
        F.col("user_id").alias("customer_id"),
        "product_id",
        "sale_price",
        "created_at",
        F.to_date("created_at").alias("order_date"),
    )
    return sample_customers(view, cfg.sample_rate)


def customers(users: DataFrame) -> DataFrame:
    """All customers; profile columns the source lacks are left out."""
    registered = [F.col("created_at").alias("registered_at")] if "created_at" in users.columns else []
    profile = [c for c in USER_COLUMNS if c in users.columns]
    return users.select(F.col("id").alias("customer_id"), *profile, *registered)


def date_spine(spark: SparkSession, cfg: BuildConfig) -> DataFrame:
    """Every day from the lookback start to ``as_of``."""
    days = day_sequence(lookback_start(cfg.as_of, cfg.lookback_months), F.lit(cfg.as_of))
    return spark.range(1).select(F.explode(days).alias("snapshot_date"))


def label_date_spine(orders_view: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Days whose whole label horizon lies within the order dates."""
    bounds = orders_view.agg(
        F.min("order_date").alias("low"),
        F.date_sub(F.max("order_date"), cfg.churn_days).alias("high"),
    )
    return bounds.select(F.explode(day_sequence(F.col("low"), F.col("high"))).alias("label_date"))

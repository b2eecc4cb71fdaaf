"""Order dates of a customer, and what comes next on the calendar."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.functions import midnight


def order_date_range(orders: DataFrame) -> DataFrame:
    return orders.agg(
        F.min("order_date").alias("min_order_date"), F.max("order_date").alias("max_order_date")
    )


def distinct_customers(orders: DataFrame) -> DataFrame:
    return orders.select("customer_id").distinct()


def order_gaps(orders: DataFrame) -> DataFrame:
    """``(customer_id, order_date, next_order_date)`` per distinct order day.

    The distinct step combines map-side, so the window sees at most one row per
    customer and calendar day however many orders a customer has.
    """
    days = (
        orders.select("customer_id", "order_date")
        .where(F.col("customer_id").isNotNull() & F.col("order_date").isNotNull())
        .distinct()
    )
    w = Window.partitionBy("customer_id").orderBy("order_date")
    return days.withColumn("next_order_date", F.lead("order_date").over(w))


def _label_high(orders: DataFrame, cfg: BuildConfig) -> Column:
    """Last label day, as a scalar subquery over the orders."""
    return orders.select(F.date_sub(F.max("order_date"), cfg.churn_days)).scalar()


def next_order_labels(orders: DataFrame, cfg: BuildConfig) -> DataFrame:
    """``(customer_id, label_date, bought)`` for each day with an order behind it.

    ``bought`` says whether an order follows within the horizon.  Between two
    order days the next order is the same, so each gap yields its own days and no
    range join is needed.
    """
    gaps = order_gaps(orders).withColumn("high", _label_high(orders, cfg))
    low = F.col("order_date")
    high = F.least(F.date_sub("next_order_date", 1), F.col("high"))
    days = (
        gaps.where(low <= high)
        .select("*", F.explode_outer(F.sequence(F.lit(0), F.datediff(high, low))).alias("i"))
        .withColumn("label_date", F.date_add("order_date", F.col("i")))
    )
    reach = F.date_add("label_date", cfg.churn_days)
    return days.select(
        "customer_id",
        "label_date",
        F.coalesce(F.col("next_order_date") <= reach, F.lit(False)).alias("bought"),
    )


def last_order_to_date(orders: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Last order day on or before each snapshot, for customers that have one."""
    spine = customer_spine(orders, cfg)
    gaps = order_gaps(orders)
    events = (
        gaps.select("customer_id", F.col("order_date").alias("day"), F.lit(0).alias("kind"))
        .unionByName(
            spine.select("customer_id", F.col("snapshot_date").alias("day"), F.lit(1).alias("kind"))
        )
    )
    w = (
        Window.partitionBy("customer_id")
        .orderBy("day", "kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = F.max(F.when(F.col("kind") == 0, F.col("day"))).over(w)
    return (
        events.withColumn("last_order_date", seen)
        .where((F.col("kind") == 1) & F.col("last_order_date").isNotNull())
        .select(
            "customer_id",
            midnight(F.col("day")).alias("feature_timestamp"),
            midnight(F.col("last_order_date")).alias("last_order_timestamp"),
        )
    )


def customer_spine(orders: DataFrame, cfg: BuildConfig) -> DataFrame:
    """Every customer with every snapshot day.

    The days follow from the parameters alone, so each customer row generates
    its own: the product of the two sets without a join.
    """
    from lapsewise.functions import day_sequence, lookback_start

    days = day_sequence(lookback_start(cfg.as_of, cfg.lookback_months), F.lit(cfg.as_of))
    return distinct_customers(orders).select("customer_id", F.explode(days).alias("snapshot_date"))

"""Feature snapshots per customer and day."""

from __future__ import annotations

from pyspark.sql import DataFrame

from lapsewise.config import BuildConfig
from lapsewise.operators import daily_snapshots, item_facts, order_facts
from lapsewise.sources import completed_order_items, completed_orders


def feature_snapshots(
    orders_view: DataFrame, items_view: DataFrame, products: DataFrame, cfg: BuildConfig
) -> DataFrame:
    """One row per customer and snapshot day once the customer has an order.

    Snapshots run from the lookback start to ``as_of``, every ``step_days``.
    """
    facts = order_facts(orders_view).unionByName(item_facts(items_view, products, cfg))
    return daily_snapshots(facts, cfg)


def features_from_sources(
    orders: DataFrame, items: DataFrame, products: DataFrame, cfg: BuildConfig
) -> DataFrame:
    return feature_snapshots(
        completed_orders(orders, cfg), completed_order_items(items, orders, cfg), products, cfg
    )

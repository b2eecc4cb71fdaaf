"""Order-entry tables (orders, lineitem, part, customer, nation) and event logs
mapped onto the four commerce tables the views expect.

Each mapping is a projection, so filters and column pruning reach the files.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class RetailTables:
    """Commerce tables from one folder of Parquet files."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder.rstrip("/")

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def orders(self, with_item_counts: bool = False) -> DataFrame:
        count = F.lit(None).cast("bigint")
        source = self.table("orders")
        if with_item_counts:
            items = self.table("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("_n"))
            source = source.join(items, F.col("o_orderkey") == F.col("l_orderkey"), "left")
            count = F.coalesce(F.col("_n"), F.lit(0))
        return source.select(
            F.col("o_orderkey").alias("order_id"),
            F.col("o_custkey").alias("user_id"),
            F.col("o_orderstatus").alias("status"),
            F.col("o_orderdate").alias("created_at"),
            count.alias("num_of_item"),
        )

    def items(self) -> DataFrame:
        """Lines carry no customer or date of their own; the view takes both from the order."""
        return self.table("lineitem").select(
            F.col("l_orderkey").alias("order_id"),
            F.col("l_partkey").alias("product_id"),
            F.col("l_extendedprice").alias("sale_price"),
        )

    def products(self) -> DataFrame:
        return self.table("part").select(
            F.col("p_partkey").alias("id"), F.col("p_type").alias("category")
        )

    def users(self) -> DataFrame:
        nation = self.table("nation").select("n_nationkey", F.col("n_name").alias("country"))
        return (
            self.table("customer")
            .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
            .select(F.col("c_custkey").alias("id"), F.col("c_name").alias("first_name"), "country")
        )

    def event_orders(self) -> DataFrame:
        """Every event as an order whose status is the event's type."""
        return self.table("events").select(
            F.col("event_id").alias("order_id"),
            "user_id",
            F.col("event_type").alias("status"),
            F.col("ts").alias("created_at"),
            F.lit(1).cast("bigint").alias("num_of_item"),
        )

    def event_items(self) -> DataFrame:
        """Every event as its own item, priced by its value."""
        return self.table("events").select(
            F.col("event_id").alias("id"),
            F.col("event_id").alias("order_id"),
            "user_id",
            F.get_json_object("props", "$.k").cast("bigint").alias("product_id"),
            F.col("value").alias("sale_price"),
            F.col("ts").alias("created_at"),
        )

"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], order: Column | str
) -> DataFrame:
    """``columns`` of the row with the greatest ``order`` for each key.

    One ``max_by`` per column rather than one over a struct: fixed-width buffers
    keep it a hash aggregate that combines map-side, so a key with very many
    rows costs no more than any other.
    """
    return df.groupBy(*keys).agg(*(F.max_by(c, order).alias(c) for c in columns))


def latest_by_rank(df: DataFrame, keys: Sequence[str], order: Column) -> DataFrame:
    """The whole latest row per key by rank, for keys with a bounded number of rows."""
    w = Window.partitionBy(*keys).orderBy(order)
    return df.withColumn("_rank", F.row_number().over(w)).where("_rank = 1").drop("_rank")

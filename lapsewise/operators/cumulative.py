"""Running totals over a long ordered table, in parallel."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def running_totals(
    df: DataFrame, order: str, values: Sequence[str], buckets: int = 256
) -> DataFrame:
    """Adds ``<value>_upto`` columns: totals from the greatest ``order`` down to the row.

    ``df`` must be unique by ``order`` and cheap to read twice (staged).  The
    order is cut at quantiles into equal pieces; a piece's total is known from an
    aggregation, so each piece can be summed in its own task on top of the pieces
    above it.  The totals joined back are at most ``buckets`` rows.
    """
    steps = [i / buckets for i in range(1, buckets)]
    splits = sorted(set(df.approxQuantile(order, steps, 0.25 / buckets))) if steps else []
    if splits:
        bucketizer = Bucketizer(
            splits=[float("-inf"), *splits, float("inf")], inputCol="_order", outputCol="_piece"
        )
        pieces = bucketizer.transform(df.withColumn("_order", F.col(order).cast("double"))).drop("_order")
    else:
        pieces = df.withColumn("_piece", F.lit(0.0))

    above = Window.partitionBy(F.lit(0)).orderBy(F.desc("_piece")).rowsBetween(Window.unboundedPreceding, -1)
    totals = pieces.groupBy("_piece").agg(*(F.sum(v).alias(v) for v in values))
    offsets = totals.select(
        "_piece", *(F.coalesce(F.sum(v).over(above), F.lit(0)).alias(f"_{v}") for v in values)
    )
    w = (
        Window.partitionBy("_piece")
        .orderBy(F.desc(order))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        pieces.join(F.broadcast(offsets), "_piece")
        .select(
            *df.columns,
            *((F.sum(v).over(w) + F.col(f"_{v}")).alias(f"{v}_upto") for v in values),
        )
    )

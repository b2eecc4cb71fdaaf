"""Backward as-of join: for each left row the latest right row not after it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def asof_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    bucket: str | None = None,
) -> DataFrame:
    """Inner as-of join; left rows without an earlier right row drop out.

    Both sides are merged into one time-ordered run per key and the last right
    row is carried forward: one shuffle, linear in the rows, where a range join
    would pair every left row with all its earlier right rows.  ``right`` should
    be unique per key and time; of several, one is taken.

    With ``bucket`` (a ``date_trunc`` unit such as ``"month"``) a key's run is cut
    into calendar pieces that sort in separate tasks; each piece starts with the
    row carried over from the pieces before it.  Use it when single keys are too
    long for one task.
    """
    on = list(on)
    left_rest = [c for c in left.columns if c not in on]
    right_rest = [c for c in right.columns if c not in on]
    overlap = set(left_rest) & set(right_rest)
    if overlap:
        raise ValueError(f"columns on both sides: {sorted(overlap)}")

    rows = left.select(
        *on,
        F.col(left_time).alias("_time"),
        F.lit(1).alias("_kind"),
        F.struct(*left_rest).alias("_left"),
    ).unionByName(
        right.where(F.col(right_time).isNotNull()).select(
            *on,
            F.col(right_time).alias("_time"),
            F.lit(0).alias("_kind"),
            F.struct(*right_rest).alias("_right"),
        ),
        allowMissingColumns=True,
    )
    keys = list(on)
    if bucket is not None:
        rows = rows.withColumn("_bucket", F.date_trunc(bucket, "_time"))
        keys.append("_bucket")
        rows = rows.unionByName(_carried(rows, on), allowMissingColumns=True)

    run = (
        Window.partitionBy(*keys)
        .orderBy("_time", "_kind")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    return (
        rows.withColumn("_match", F.last("_right", ignorenulls=True).over(run))
        .where((F.col("_kind") == 1) & F.col("_match").isNotNull())
        .select(*on, "_left.*", "_match.*")
    )


def _carried(rows: DataFrame, on: list[str]) -> DataFrame:
    """For each piece of a key's run, the last right row of the earlier pieces."""
    latest = F.max_by("_right", F.when(F.col("_kind") == 0, F.col("_time")))
    pieces = rows.groupBy(*on, "_bucket").agg(latest.alias("_right"))
    before = (
        Window.partitionBy(*on).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    )
    carried = pieces.withColumn("_right", F.last("_right", ignorenulls=True).over(before))
    return carried.where(F.col("_right").isNotNull()).select(
        *on,
        "_bucket",
        F.col("_bucket").cast(rows.schema["_time"].dataType).alias("_time"),
        F.lit(-1).alias("_kind"),
        "_right",
    )

"""Train, validation and test parts, and their description."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.config import BuildConfig
from lapsewise.functions import order_value, ratio
from lapsewise.operators import cuts_after
from lapsewise.sources import stage

_ORDER = "_order_"


def time_split(
    df: DataFrame,
    time_column: str = "label_timestamp",
    keys: Sequence[str] = ("customer_id",),
    train_ratio: float = 0.7,
    valid_ratio: float = 0.15,
) -> DataFrame:
    """Adds ``split``: the earliest rows train, the next validate, the last test.

    The cuts are positions in the order of time, then ``keys`` (integers telling
    apart rows of one time).  ``df`` is read a few times for its ordering columns
    alone, so pass a stored table.
    """
    columns = [time_column, *keys]
    order = [f"{_ORDER}{c}" for c in columns]
    keyed = df.select(
        "*",
        *(order_value(F.col(c), df.schema[c].dataType).alias(o) for c, o in zip(columns, order)),
    )
    ordering = keyed.select(*order)
    n = ordering.count()
    # Floating products are cut off exactly as written here: 90 * 0.7 gives 62.
    ranks = [int(n * train_ratio), int(n * (train_ratio + valid_ratio))]
    ((train, valid),) = cuts_after(ordering, order, [(F.lit(True), n, ranks)])
    split = F.when(train.includes(), "train").when(valid.includes(), "valid").otherwise("test")
    return keyed.withColumn("split", split).drop(*order)


def class_train_counts(counts: dict, test_size: float) -> dict:
    """Training rows per class: proportional shares, leftovers to the largest remainders."""
    total = sum(counts.values())
    train = total - math.ceil(test_size * total)
    shares = {c: train * k / total for c, k in counts.items()}
    taken = {c: math.floor(s) for c, s in shares.items()}
    by_remainder = sorted(counts, key=lambda c: (taken[c] - shares[c], c))
    for c in by_remainder[: train - sum(taken.values())]:
        taken[c] += 1
    return taken


def stratified_split(
    df: DataFrame,
    label_column: str,
    keys: Sequence[str] = ("customer_id", "label_timestamp"),
    test_size: float = 0.2,
    seed: int = 42,
) -> DataFrame:
    """Adds ``split`` (train, test): a repeatable random split with each label's share kept.

    Rows are ordered at random by a seeded hash of ``keys``, which must tell rows
    apart, and cut at the label's share.
    """
    digest = F.xxhash64(F.lit(seed), *(F.col(k) for k in keys))
    order = [f"{_ORDER}hash", *(f"{_ORDER}{k}" for k in keys)]
    keyed = df.select(
        "*",
        F.shiftrightunsigned(digest, 1).alias(order[0]),
        *(order_value(F.col(k), df.schema[k].dataType).alias(o) for k, o in zip(keys, order[1:])),
    )
    ordering = keyed.select(label_column, *order)
    classes = {r[0]: r[1] for r in ordering.groupBy(label_column).count().collect()}
    taken = class_train_counts(classes, test_size)
    of_label = {label: F.col(label_column).eqNullSafe(F.lit(label)) for label in classes}
    cuts = cuts_after(ordering, order, [(of_label[c], classes[c], [taken[c]]) for c in classes])
    in_train = F.lit(False)
    for label, (cut,) in zip(classes, cuts):
        in_train = in_train | (of_label[label] & cut.includes())
    return keyed.withColumn("split", F.when(in_train, "train").otherwise("test")).drop(*order)


def dataset_metadata(
    split_df: DataFrame, cfg: BuildConfig, time_column: str = "label_timestamp"
) -> DataFrame:
    """One row describing a split data set."""
    label = F.col(cfg.label_column)

    def rows(split: str):
        return F.count_if(F.col("split") == split)

    def positives(split: str):
        return ratio(
            F.sum(F.when(F.col("split") == split, label)),
            F.count(F.when(F.col("split") == split, label)),
        )

    columns = [c for c in split_df.columns if c != "split"]
    return split_df.agg(
        *(rows(s).alias(f"{s}_samples") for s in ("train", "valid", "test")),
        F.count(F.lit(1)).alias("total_samples"),
        F.lit(cfg.label_column).alias("label_column"),
        F.lit(time_column).alias("time_column"),
        *(positives(s).alias(f"{s}_positive_rate") for s in ("train", "valid", "test")),
        F.struct(
            F.min(time_column).cast("string").alias("min"),
            F.max(time_column).cast("string").alias("max"),
        ).alias("time_range"),
        F.array(*(F.lit(c) for c in columns)).alias("columns"),
    )


def staged_time_split(df: DataFrame, **options) -> DataFrame:
    """``time_split`` of a computed frame, which is written once first."""
    return time_split(stage(df, "split-input"), **options)

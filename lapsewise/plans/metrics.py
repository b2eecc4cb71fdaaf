"""Classifier metrics from scored rows.

All metrics depend on the rows through the counts of positives and negatives
per score only, so the rows are read once and reduced map-side to those counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.functions import ratio
from lapsewise.operators import running_totals
from lapsewise.sources import stage


def score_counts(scored: DataFrame, score: str, label: str) -> DataFrame:
    """``(score, pos, neg)`` per distinct score."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )


def threshold_metrics(counts: DataFrame, threshold: float = 0.5) -> DataFrame:
    """Accuracy, precision, recall and F1; each 0 where its denominator is 0.

    A row is called positive above the threshold; at it, the first class wins.
    """
    called = F.col("score") > threshold

    def total(condition, column):
        return F.coalesce(F.sum(F.when(condition, F.col(column))), F.lit(0))

    confusion = counts.agg(
        total(called, "pos").alias("tp"),
        total(called, "neg").alias("fp"),
        total(~called, "pos").alias("fn"),
        total(~called, "neg").alias("tn"),
    )
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))

    def share(part, whole):
        return F.coalesce(ratio(part, whole), F.lit(0.0))

    return confusion.select(
        share(tp + tn, tp + fp + fn + tn).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        share(tp, tp + fn).alias("recall"),
        share(tp * 2, tp * 2 + fp + fn).alias("f1"),
        ratio(tp + fn, tp + fp + fn + tn).alias("positive_rate"),
        (tp + fp + fn + tn).alias("eval_samples"),
    )


def ranking_metrics(counts: DataFrame) -> DataFrame:
    """ROC-AUC and average precision; ``counts`` should be staged.

    ROC-AUC counts, for each negative, the positives scored above it and half of
    those scored the same: integers up to the final division, null for one class.
    Average precision is the step sum of precision over recall gained.
    """
    ranked = running_totals(counts, "score", ["pos", "neg"])
    pos, above, below = F.col("pos"), F.col("pos_upto"), F.col("neg_upto")
    doubled_wins = F.col("neg").cast("decimal(19,0)") * (above * 2 - pos).cast("decimal(19,0)")
    steps = pos * ratio(above, above + below)
    sums = ranked.agg(
        F.sum(doubled_wins).alias("wins"),
        F.sum(steps).alias("steps"),
        F.sum("pos").alias("positives"),
        F.sum("neg").alias("negatives"),
    )
    pairs = F.col("positives").cast("decimal(19,0)") * F.col("negatives").cast("decimal(19,0)") * 2
    return sums.select(
        ratio(F.col("wins"), pairs).alias("roc_auc"),
        F.when(F.col("positives") > 0, F.col("steps") / F.col("positives"))
        .when(F.col("positives") == 0, 0.0)
        .alias("pr_auc"),
    )


def evaluation_report(
    scored: DataFrame,
    score: str,
    label: str,
    eval_split: str,
    threshold: float = 0.5,
) -> DataFrame:
    """All metrics of one split in one row."""
    counts = stage(score_counts(scored, score, label), "score-counts")
    first = threshold_metrics(counts, threshold)
    # Two one-row frames side by side, by a constant key.
    both = first.withColumn("_k", F.lit(1)).join(
        ranking_metrics(counts).withColumn("_k", F.lit(1)), "_k"
    )
    return both.select(
        "accuracy",
        "precision",
        "recall",
        "f1",
        "roc_auc",
        "pr_auc",
        "positive_rate",
        F.lit(eval_split).alias("eval_split"),
        "eval_samples",
    )

"""Mixing sources to target weights by subset-sum budget fitting.

Sources share ``share`` times all words by weight; a source's target stops at
``most`` times its words, and what is left over goes to the others by weight.  A
target of at least the source's words takes every document once; what remains is
a budget for a subset.  Documents are counted by exact length.  Most of the budget is
spent over all lengths in proportion, the rest, at most ``reserve`` words and what
rounding leaves, by bounded-knapsack dynamic programming over the documents still
available, with the reachable sums as bits of one integer.  Of each length the
documents with the smallest seeded hashes are taken.

A source's lengths, not its documents, meet in one task.  A length with very many
documents is cut by the first bits of their hashes, so that only the part in which
the last one taken lies has to be ranked.

Defined results: a null or empty text has size 0 and takes no words; a null source is
a source, last in order; rows that repeat each count; with no words all targets are 0.
Columns other than doc_id, text and source are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm.common import WORD, first_bits, on_workers, row_key, seeded, text_hash
from lapsewise.sources import stage

#: Documents of one length beyond which their hashes are cut before ranking.
MANY = 256


def n_words(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


# -- targets --------------------------------------------------------------------------


def targets(sizes: DataFrame, weights: tuple[float, ...], share: float, most: float) -> DataFrame:
    """Target of each source; one row a source in and out.

    Filling by weight with caps has one level: sources whose cap per weight is
    below it stand at their cap, the others at their weight times the level.
    """
    everything = Window.partitionBy(F.lit(0))
    ordered = sizes.withColumn(
        "number", F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    weight = F.element_at(F.array(*map(F.lit, map(float, weights))), F.col("number") % len(weights) + 1)
    weighed = ordered.withColumn("weight", weight).withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_cap = everything.orderBy(F.col("cap") / F.col("weight"), "number")
    below = by_cap.rowsBetween(Window.unboundedPreceding, -1)
    above = by_cap.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    budget = F.sum("source_size").over(everything) * F.lit(float(share))
    level = (budget - F.coalesce(F.sum("cap").over(below), F.lit(0.0))) / F.sum("weight").over(above)
    levelled = weighed.withColumn("_level", level)
    holds = F.when(F.col("_level") <= F.col("cap") / F.col("weight"), F.col("_level"))
    filled = levelled.withColumn("_level", F.max(holds).over(everything))
    target = F.least(F.col("cap"), F.coalesce(F.col("_level") * F.col("weight"), F.col("cap")))
    return filled.select("source", "number", "source_size", target.alias("target"))


# -- subset sums ------------------------------------------------------------------------


def fit_counts(sizes: np.ndarray, counts: np.ndarray, budget: int, reserve: int = 20_000) -> np.ndarray:
    """How many documents of each size to take, for a sum as near below ``budget`` as can be reached."""
    taken = np.zeros(len(sizes), np.int64)
    whole = int((sizes * counts).sum())
    if budget >= whole:
        return counts.astype(np.int64)
    # In proportion, from the largest size down; what a size leaves over goes to the next.
    spent, share, owed = 0, max(0, budget - reserve) / max(whole, 1), 0.0
    for i in np.argsort(-sizes, kind="stable"):
        owed += share * sizes[i] * counts[i]
        taken[i] = min(counts[i], int(owed // sizes[i]))
        owed -= taken[i] * sizes[i]
        spent += int(taken[i] * sizes[i])
    # The rest exactly: bit s of ``reached`` says whether a sum of s words can be made.
    rest = budget - spent
    mask, reached, steps = (1 << (rest + 1)) - 1, 1, []
    for i in np.argsort(-sizes, kind="stable").tolist():
        left, lot = min(int(counts[i] - taken[i]), rest // int(sizes[i])), 1
        while left and not reached >> rest & 1:
            lot = min(lot, left)
            more = reached | (reached << (lot * int(sizes[i]))) & mask
            if more != reached:
                steps.append((i, lot, reached))
            reached, left, lot = more, left - lot, lot * 2
    at = reached.bit_length() - 1
    for i, lot, before in reversed(steps):
        if not before >> at & 1:
            taken[i] += lot
            at -= lot * int(sizes[i])
    return taken


def _subsets(plan: DataFrame, reserve: int) -> DataFrame:
    """(number, size, n, extra) from (number, size, n, budget), one group a source."""

    def fit(lengths: pd.DataFrame) -> pd.DataFrame:
        sizes = lengths["size"].to_numpy(np.int64)
        counts = lengths["n"].to_numpy(np.int64)
        budget = int(np.floor(lengths["budget"].iloc[0] + 1e-6))
        return lengths[["number", "size", "n"]].assign(extra=fit_counts(sizes, counts, budget, reserve))

    return on_workers(plan).groupBy("number").applyInPandas(fit, "number int, size long, n long, extra long")


# -- on Spark -----------------------------------------------------------------------------


def mix(
    documents: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    reserve: int = 20_000,
    seed: int = 6,
) -> DataFrame:
    """doc_id, text_hash, source, size, source_size, target, copies and taken of every row.

    ``most`` is at most 2: a document is taken once, twice or not at all.
    """
    if not 0 < most <= 2 or share > most:
        raise ValueError("need share <= most <= 2")
    sized = stage(
        documents.select("doc_id", text_hash(), "source", n_words().alias("size")), "sizes"
    )
    lengths = stage(sized.groupBy("source", "size").agg(F.count(F.lit(1)).alias("n")), "lengths")
    sizes = lengths.groupBy("source").agg(F.sum(F.col("size") * F.col("n")).alias("source_size"))
    wanted = targets(sizes, weights, share, most).withColumn("once", (F.col("target") >= F.col("source_size")).cast("int"))
    same = F.col("l.source").eqNullSafe(F.col("t.source"))
    plan = lengths.alias("l").join(wanted.alias("t"), same).select("l.*", "t.number", "source_size", "target", "once")
    plan = stage(plan, "mix-plan")
    budget = F.col("target") - F.col("once") * F.col("source_size")
    extra = _subsets(plan.where("size > 0").select("number", "size", "n", budget.alias("budget")), reserve)
    plan = plan.join(extra.select("number", "size", "extra"), ["number", "size"], "left").fillna(0, ["extra"])

    same = F.col("d.source").eqNullSafe(F.col("p.source")) & (F.col("d.size") == F.col("p.size"))
    rows = sized.alias("d").join(plan.alias("p"), same).select(
        "d.*", "number", "n", "source_size", "target", "once", "extra",
        F.when(F.col("n") > MANY, first_bits("doc_id", seed)).otherwise(0).alias("part"),
    )
    some = rows.where("extra > 0 and extra < n")
    before = Window.partitionBy("number", "size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = (
        some.where(F.col("n") > MANY)
        .groupBy("number", "size", "part")
        .agg(F.count(F.lit(1)).alias("held"))
        .withColumn("upto", F.coalesce(F.sum("held").over(before), F.lit(0)))
    )
    placed = some.join(parts, ["number", "size", "part"], "left").withColumn("left", F.col("extra") - F.coalesce("upto", F.lit(0)))
    whole = F.coalesce(F.col("held") <= F.col("left"), F.lit(False))
    none = F.col("left") <= 0
    order = Window.partitionBy("number", "size", "part").orderBy(seeded("doc_id", seed), "doc_id", "text_hash")
    ranked = placed.where(~whole & ~none).withColumn("again", (F.row_number().over(order) <= F.col("left")).cast("int"))
    settled = placed.where(whole | none).withColumn("again", whole.cast("int"))
    plain = rows.where("extra = 0 or extra = n").withColumn("again", ((F.col("extra") > 0) & (F.col("size") > 0)).cast("int"))
    kept = ["doc_id", "text_hash", "source", "size", "source_size", "target"]
    chosen = [x.select(*kept, (F.col("once") + F.col("again")).alias("copies")) for x in (plain, settled, ranked)]
    mixed = chosen[0].unionByName(chosen[1]).unionByName(chosen[2])
    return mixed.withColumn("taken", F.col("copies") * F.col("size"))


def take(documents: DataFrame, **options) -> DataFrame:
    """The whole rows of the mix, each as often as it is taken."""
    made = mix(documents, **options).where("copies > 0").select(*row_key(hashed="text_hash"), "copies")
    # Rows that share id and text are told apart by number.
    made = made.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy(F.desc("copies"))))
    rows = documents.select(F.struct("*").alias("row"), *row_key())
    rows = rows.withColumn("_n", F.row_number().over(Window.partitionBy("_id", "_hash").orderBy("_hash")))
    copies = F.explode(F.sequence(F.lit(1), F.col("copies")))
    return rows.join(made, ["_id", "_hash", "_n"]).select("row", copies).select("row.*")

"""What the operators of this subpackage share: worker setup, batches, folds, samples."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
from collections.abc import Callable, Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROOT = str(Path(__file__).resolve().parents[2])
#: Words of the contracts: runs of anything but a space and the five controls 09-0D.
WORD = r"[^\x20\x09-\x0D]+"
FOLDS = 5


def on_workers(df: DataFrame) -> DataFrame:
    """Lets Python workers import this package where it lies beside the driver's code."""
    env = df.sparkSession.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", os.environ.get("PYTHONPATH", "")).split(os.pathsep) if p]
    if ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])
    return df


def slices(batches: Iterator[pa.RecordBatch], max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """Cuts record batches so that each holds about ``max_bytes`` of data (a longer row stands alone)."""
    for batch in batches:
        parts = max(1, -(-batch.nbytes // max_bytes))
        step = max(1, batch.num_rows // parts)
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def hand_back() -> None:
    """Hands memory that is no longer used back to the system."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # other C libraries have no such call
        ctypes.CDLL(None).malloc_trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hands memory that a task no longer uses back to the system, since workers outlive their tasks."""
    yield from batches
    hand_back()


#: What a worker keeps between tasks, by operator: how much there is, and how it is dropped.
KEPT: dict[str, tuple[Callable[[], int], Callable[[], None]]] = {}


def forget_others(operator: str = "") -> None:
    """Drops what tasks of other operators left in this worker: idle or at other work, it would hold that for nothing."""
    others = [drop for name, (held, drop) in KEPT.items() if name != operator and held()]
    for drop in others:
        drop()
    if others:
        hand_back()


def map_arrow(
    df: DataFrame, rows: Callable[[pa.RecordBatch], dict], schema: str, max_bytes: int = 8 << 20, operator: str = ""
) -> DataFrame:
    """``rows`` turns a bounded record batch into columns, in the order of ``schema``.

    ``operator`` is the one whose entry in ``KEPT`` is used, if any.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget_others(operator)
        for batch in slices(batches, max_bytes):
            yield pa.RecordBatch.from_pydict(rows(batch))

    return on_workers(df).mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of a binary column; a null is empty."""
    return [b"" if t is None else t for t in batch.column(name).to_pylist()]


def text_bytes(name: str = "text") -> Column:
    return F.col(name).cast("binary").alias(name)


def text_hash() -> Column:
    """With doc_id, what tells rows apart; rows equal in both are the same document again."""
    return F.xxhash64(F.col("doc_id").isNull(), F.col("text")).alias("text_hash")


def row_key(doc_id: str = "doc_id", hashed: str | None = None) -> list[Column]:
    """``_id`` and ``_hash``, equal for equal rows and never null: keys of plain equality joins."""
    known = F.coalesce(F.col(doc_id).cast("long"), F.lit(-(1 << 63))).alias("_id")
    return [known, (F.col(hashed) if hashed else text_hash()).alias("_hash")]


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the fold that no model learns from; a null id is in it, too."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % FOLDS == 0, F.lit(True))


def seeded(key: str, seed: int) -> Column:
    """A hash of 63 bits that orders rows at random; ``first_bits`` of it keep that order."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), F.col(key)), 1)


def first_bits(key: str, seed: int) -> Column:
    """The first 12 of the 63 bits."""
    return F.shiftright(seeded(key, seed), 51)


def sampled(df: DataFrame, group: str, key: str, n: int, seed: int) -> DataFrame:
    """The ``n`` rows of each group with the smallest seeded hashes of ``key``.

    Counts by the hashes' first 12 bits, combined before their shuffle, tell the
    part of each group in which its n-th hash lies, so that only about ``n`` rows
    of a group, however large, are ranked.  There must be few groups: one row of
    each is broadcast.
    """
    part = first_bits(key, seed)
    upto = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        df.groupBy(group, part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        .where(F.col("_before") < n)
        .groupBy(group)
        .agg(F.max("_part").alias("_cut"))
    )
    near = df.withColumn("_part", part).join(F.broadcast(cuts), group).where("_part <= _cut")
    order = Window.partitionBy(group).orderBy(seeded(key, seed), F.col(key))
    ranked = near.withColumn("_rank", F.row_number().over(order))
    return ranked.where(F.col("_rank") <= n).select(*df.columns)


def excerpt(data: Column, length: Column, n: int, key: str, seed: int) -> Column:
    """``data`` if it is at most ``n`` long, else ``n`` in a row of it from a seeded place on."""
    start = F.pmod(seeded(key, seed), F.greatest(length - n + 1, F.lit(1))) + 1
    return F.when(length <= n, data).otherwise(F.substr(data, F.coalesce(start, F.lit(1)).cast("int"), F.lit(n)))


def labelled_sample(
    labels: DataFrame, column: str, per_class: int, seed: int
) -> DataFrame:
    """At most ``2 * per_class`` rows (doc_id, label) outside the held-out fold.

    Documents whose rows disagree, and labels other than 0 and 1, are left out.
    """
    known = (
        labels.select("doc_id", F.col(column).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("_most"))
        .where(F.col("label") == F.col("_most"))
        .drop("_most")
    )
    return sampled(known, "label", "doc_id", per_class, seed)

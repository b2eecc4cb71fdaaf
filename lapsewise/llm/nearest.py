"""Approximate nearest neighbours by multiprobe p-stable hashing.

Each of a few tables hashes a vector by Gaussian projections cut into cells of one
width.  A query visits, besides its own bucket, the buckets around it in the order of
their estimated chance of success: the chance falls with the squared distances from
the query's projections to the cells' borders, and a heap yields the perturbations in
that order without listing them all.  A query stops at a radius of such distances that
is fitted beforehand: a bounded sample of rows is searched exactly, and the radius is
that within which ``recall`` of their true neighbours' buckets lie in some table.  All
rows are indexed.  Candidates of all tables are merged and ranked by exact distance.

Rows with equal vectors share one index entry that carries their smallest ids, as many
as a result can name.  Buckets of more than ``chunk`` entries are split at random into
parts, which a probe visits one by one, and parts are packed into groups of bounded
size; no task sees a bucket whole.  Visits are numbers at first; those of a group are cut by
their queries into blocks of bounded size, to which the vectors follow.  A query that finds too few rows is searched exactly,
in blocks of bounded size.

Defined results: vectors that are null, zero, hold null or non-finite components or
have another length than most take no part; with fewer than ``k`` other rows all are
returned; ties go to the smaller vec_id, whose repeats count as one row; columns other
than vec_id and the vector are not read.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm.common import map_arrow, on_workers, seeded
from lapsewise.sources import stage

RESULT = "query_id long, vec_id long, score double"


def _matrix(column: pa.Array, dtype=np.float64) -> np.ndarray:
    """Rows of a list column whose lists are equally long."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(dtype).reshape(len(column), -1)


@dataclass(frozen=True)
class Hashes:
    """Projections (tables, dimensions, hashes), offsets and cell width, and the radius of probing."""

    projections: np.ndarray
    offsets: np.ndarray
    width: float
    radius: float = 0.0

    def places(self, vectors: np.ndarray) -> np.ndarray:
        """Projections in units of cells: (tables, rows, hashes)."""
        return np.einsum("nd,tdm->tnm", vectors, self.projections) / self.width + self.offsets[:, None, :]

    def codes(self, cells: np.ndarray) -> np.ndarray:
        """One number a bucket; (tables, rows, hashes) to (tables, rows)."""
        code = np.arange(1, len(cells) + 1, dtype=np.uint64)[:, None] * np.uint64(0x9E3779B97F4A7C15)
        code = np.broadcast_to(code, cells.shape[:2]).copy()
        for j in range(cells.shape[2]):
            code = (code ^ cells[:, :, j].astype(np.int64).view(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)
            code ^= code >> np.uint64(32)
        return code.view(np.int64)

    def costs(self, query: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Squared distances, in cells, from a query's projections to others' cells; least over the tables."""
        at, cells = self.places(query[None]), np.floor(self.places(others))
        gaps = np.maximum(np.maximum(cells - at, at - cells - 1), 0)
        return (gaps**2).sum(axis=2).min(axis=0)


def probes(at: np.ndarray, radius: float) -> Iterator[np.ndarray]:
    """Cells of one table in the order of cost, up to ``radius``; ``at`` are a query's projections.

    A choice says how many steps of each projection's sorted list of moves are taken.
    Choices form a tree in which the last projection moved, or a later one, moves on,
    so each comes up once and never before a cheaper one.
    """
    home = np.floor(at)
    inner = at - home
    # Move s of a projection goes to the cell s places out, nearer border first.
    moves = []
    for x in inner:
        steps = [(0.0, 0)]
        for reach in range(1, int(np.ceil(np.sqrt(radius))) + 2):
            steps += [((x + reach - 1) ** 2, -reach), ((reach - x) ** 2, reach)]
        moves.append(sorted(s for s in steps if s[0] <= radius))
    heap = [(0.0, 0, (0,) * len(at))]
    while heap:
        cost, first, taken = heapq.heappop(heap)
        yield home + np.array([moves[j][s][1] for j, s in enumerate(taken)])
        for j in range(first, len(at)):
            if taken[j] + 1 < len(moves[j]):
                more = cost - moves[j][taken[j]][0] + moves[j][taken[j] + 1][0]
                if more <= radius:
                    heapq.heappush(heap, (more, j, (*taken[:j], taken[j] + 1, *taken[j + 1 :])))


# -- rows that take part ----------------------------------------------------------------


def _usable(vector: str) -> Column:
    parts = F.col(vector)
    finite = F.forall(parts, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return parts.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(parts, lambda x: x != 0)


def usable_rows(rows: DataFrame, vector: str) -> DataFrame:
    """(vec_id, vec) of the rows that take part, once each."""
    known = rows.select("vec_id", F.col(vector).cast("array<double>").alias("vec")).where(
        F.col("vec_id").isNotNull() & _usable("vec")
    )
    length = known.groupBy(F.size("vec").alias("length")).count().orderBy(F.desc("count"), F.desc("length")).first()
    return known.where(F.size("vec") == (length["length"] if length else 0)).distinct()


def _entries(rows: DataFrame, k: int) -> DataFrame:
    """(ids, vec): distinct vectors with the ``k + 1`` smallest ids of each."""
    order = Window.partitionBy("vec").orderBy("vec_id")
    few = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    return few.groupBy("vec").agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))


# -- exact ranking ------------------------------------------------------------------------


class Nearest:
    """The ``k`` nearest ids of each query, gathered over blocks of entries."""

    def __init__(self, k: int):
        self.k = k
        self.found: dict[int, list[np.ndarray]] = {}

    def add(self, query_ids: np.ndarray, queries: np.ndarray, ids: list, vectors: np.ndarray) -> None:
        squares, k = (vectors**2).sum(axis=1), self.k
        for at in range(0, len(queries), 256):
            asked = queries[at : at + 256]
            rough = squares[None, :] + (asked**2).sum(axis=1)[:, None] - 2 * asked @ vectors.T
            # Rounding of the product form is far below this margin; exact distances decide.
            margin = 1e-9 * (squares.max() + (asked**2).sum(axis=1).max())
            keep = min(k + 1, len(ids))
            bound = np.partition(rough, keep - 1, axis=1)[:, keep - 1 : keep] + margin
            for row, near in enumerate(rough <= bound):
                near = np.flatnonzero(near)
                exact = np.sqrt(((vectors[near] - asked[row]) ** 2).sum(axis=1))
                own = int(query_ids[at + row])
                pairs = [(s, i) for s, e in zip(exact.tolist(), near.tolist()) for i in ids[e] if i != own]
                self._merge(own, pairs)

    def _merge(self, query: int, pairs: list[tuple[float, int]]) -> None:
        self.found[query] = sorted({*self.found.get(query, ()), *pairs})[: self.k]

    def batch(self) -> pa.RecordBatch:
        rows = [(q, i, s) for q, pairs in self.found.items() for s, i in pairs]
        columns = list(zip(*rows)) if rows else [(), (), ()]
        kinds = (pa.int64(), pa.int64(), pa.float64())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, kind) for c, kind in zip(columns, kinds)], names=["query_id", "vec_id", "score"]
        )


def _best(found: DataFrame, k: int) -> DataFrame:
    """The ``k`` nearest of each query's merged candidates."""
    merged = found.groupBy("query_id", "vec_id").agg(F.min("score").alias("score"))
    order = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return merged.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def exact_search(entries: DataFrame, query_ids: np.ndarray, queries: np.ndarray, k: int) -> DataFrame:
    """One block of queries against all entries; a task hands on ``k`` rows a query."""
    block = entries.sparkSession.sparkContext.broadcast((query_ids, queries))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nearest = Nearest(k)
        for batch in batches:
            if batch.num_rows:
                nearest.add(*block.value, batch.column("ids").to_pylist(), _matrix(batch.column("vec")))
        yield nearest.batch()

    return _best(on_workers(entries.select("ids", "vec")).mapInArrow(run, RESULT), k)


# -- index and search ---------------------------------------------------------------------


def fit(
    entries: DataFrame,
    k: int,
    tables: int = 4,
    bucket: int = 256,
    width: float = 1.5,
    recall: float = 0.985,
    sample: int = 128,
    seed: int = 8,
) -> Hashes | None:
    """Hash functions for buckets of about ``bucket`` entries, and their probing radius.

    ``sample`` rows, those with the smallest seeded hashes, are searched exactly.
    """
    some = entries.orderBy(seeded("ids", seed), "ids").limit(sample).collect()
    if not some:
        return None
    n = entries.count()
    asked = np.array([r["vec"] for r in some])
    rng = np.random.default_rng(seed)
    spread = (asked @ rng.standard_normal((asked.shape[1], 256))).std(axis=0).mean() if len(some) > 1 else 1.0
    # A normal projection of unit spread cut into cells of this width has so many bits.
    bits = max(0.5, float(np.log2(np.sqrt(2 * np.pi * np.e) / width)))
    hashes = max(2, round(np.log2(max(2.0, n / bucket)) / bits))
    plain = Hashes(
        rng.standard_normal((tables, asked.shape[1], hashes)), rng.random((tables, hashes)), width * (spread or 1.0)
    )
    ids = np.array([r["ids"][0] for r in some])
    truth = exact_search(entries, ids, asked, k).select("query_id", "vec_id")
    vectors = entries.select("vec", F.explode("ids").alias("vec_id"))
    near = truth.join(vectors, "vec_id").select("query_id", "vec").collect()  # at most sample * k rows
    if not near:
        return plain
    place = {int(i): row for i, row in zip(ids, asked)}
    costs = np.concatenate([plain.costs(place[r["query_id"]], np.array([r["vec"]])) for r in near])
    return Hashes(plain.projections, plain.offsets, plain.width, float(np.quantile(costs, recall)))


def _index(entries: DataFrame, hashes: Hashes, vectors: bool) -> DataFrame:
    """(bucket, ids, vec), a row for each entry and table; ``vectors=False`` leaves the buckets alone."""

    def rows(batch: pa.RecordBatch) -> dict:
        codes = hashes.codes(np.floor(hashes.places(_matrix(batch.column("vec")))))
        out = {"bucket": pa.array(codes.ravel())}
        if vectors:
            order = np.tile(np.arange(batch.num_rows), len(codes))
            out |= {c: batch.column(c).take(pa.array(order)) for c in ("ids", "vec")}
        return out

    schema = "bucket long" + (", ids array<long>, vec array<double>" if vectors else "")
    return map_arrow(entries.select("ids", "vec"), rows, schema, 2 << 20)


def _probes(queries: DataFrame, hashes: Hashes) -> DataFrame:
    """(bucket, query_id): every bucket that a query visits."""

    def rows(batch: pa.RecordBatch) -> dict:
        vectors = _matrix(batch.column("vec"))
        places, buckets, asked = hashes.places(vectors), [], []
        for row in range(len(vectors)):
            visited = [np.array(list(probes(places[t, row], hashes.radius))) for t in range(len(places))]
            most = max(map(len, visited))
            # The tables' cells side by side; a shorter list repeats its first bucket, which is dropped below.
            cells = np.stack([np.concatenate([v, np.repeat(v[:1], most - len(v), axis=0)]) for v in visited])
            codes = np.unique(hashes.codes(cells))
            buckets.append(codes)
            asked.append(np.full(len(codes), row))
        order = pa.array(np.concatenate(asked))
        return {"bucket": pa.array(np.concatenate(buckets)), "query_id": batch.column("query_id").take(order)}

    return map_arrow(queries.select("query_id", "vec"), rows, "bucket long, query_id long", 1 << 16)


def search(
    rows: DataFrame,
    queries: Column,
    k: int = 10,
    vector: str = "embedding",
    chunk: int = 4096,
    group: int = 20_000,
    visit_group: int = 40_000,
    **options,
) -> DataFrame:
    """query_id, rank, vec_id and score: the ``k`` nearest found of each row that ``queries`` selects.

    Cells are packed into groups of about ``group`` entries, and the visits of a pack are cut
    by their queries into blocks of about ``visit_group``, each with the pack's entries.
    """
    spark = rows.sparkSession
    known = stage(usable_rows(rows, vector), "vectors")
    entries = stage(_entries(known, k), "entries")
    asked = known.where(queries).select(F.col("vec_id").alias("query_id"), "vec")
    hashes = fit(entries, k, **options)
    if hashes is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")

    sizes = stage(
        _index(entries, hashes, vectors=False)
        .groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("bucket", "n", F.ceil(F.col("n") / chunk).cast("int").alias("parts")),
        "buckets",
    )
    total = sizes.agg(F.sum("n")).first()[0] or 0
    groups = max(spark.sparkContext.defaultParallelism, -(-total // group))
    cell = F.xxhash64("bucket", "part")
    packed = F.pmod(cell, F.lit(groups)).cast("int").alias("pack")
    held = (
        _index(entries, hashes, vectors=True)
        .join(sizes, "bucket")
        .withColumn("part", F.pmod(F.xxhash64("ids"), F.col("parts")).cast("int"))
        .select(packed, cell.alias("cell"), "ids", "vec")
    )
    visits = stage(
        _probes(asked, hashes)
        .join(sizes, "bucket")
        .withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
        .select(packed, cell.alias("cell"), "query_id"),
        "visits",
    )
    blocks = stage(
        visits.groupBy("pack").agg(F.ceil(F.count(F.lit(1)) / visit_group).cast("int").alias("blocks")), "blocks"
    )
    held = held.join(blocks, "pack").withColumn("block", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    block = F.pmod(F.xxhash64("query_id"), F.col("blocks")).cast("int").alias("block")
    visits = visits.join(blocks, "pack").select("pack", block, "cell", "query_id").join(asked, "query_id")

    def rank(left: pa.Table, right: pa.Table) -> pa.Table:
        nearest = Nearest(k)
        if left.num_rows and right.num_rows:
            left, right = left.sort_by("cell"), right.sort_by("cell")
            held_cells, asked_cells = left["cell"].to_numpy(), right["cell"].to_numpy()
            ids, vectors = left["ids"].to_pylist(), _matrix(left["vec"])
            query_ids, queries = right["query_id"].to_numpy(), _matrix(right["vec"])
            both = np.intersect1d(held_cells, asked_cells)
            spans = [np.searchsorted(x, both, side) for x in (held_cells, asked_cells) for side in ("left", "right")]
            for a, b, c, d in zip(*spans):
                nearest.add(query_ids[c:d], queries[c:d], ids[a:b], vectors[a:b])
        return pa.Table.from_batches([nearest.batch()])

    held, visits = (x.select("pack", "block", "cell", *c) for x, c in ((held, ("ids", "vec")), (visits, ("query_id", "vec"))))
    ranked = on_workers(held).groupBy("pack", "block").cogroup(visits.groupBy("pack", "block")).applyInArrow(rank, RESULT)
    found = stage(_best(ranked, k), "found")
    full = found.groupBy("query_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= k)
    found = found.join(full, "query_id", "left_semi")
    for part in _exact_blocks(entries, asked.join(full, "query_id", "left_anti"), k):
        found = found.unionByName(part)
    return found.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def _exact_blocks(entries: DataFrame, asked: DataFrame, k: int, block: int = 2048) -> Iterator[DataFrame]:
    """Exact results of queries that found too few rows, by blocks of about ``block`` queries."""
    asked = stage(asked, "short")
    blocks = -(-asked.count() // block)
    for number in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("query_id"), F.lit(blocks)) == number).collect()
        if part:
            ids, vectors = (np.array([r[c] for r in part]) for c in ("query_id", "vec"))
            yield stage(exact_search(entries, ids, vectors, k), "exact")

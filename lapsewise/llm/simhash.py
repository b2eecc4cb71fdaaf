"""SimHash near-duplicates by bit-sliced comparison.

Fingerprints that differ in at most ``radius`` bits agree on at least two of
``radius + 2`` blocks of bits, whichever the differing bits are.  So every pair of
blocks is a table, and the distinct fingerprints that agree on both blocks of a
table form a bucket; nothing else needs comparing.  Buckets are compared bit by
bit: bit planes lie vertically, 64 comparisons to a machine word, a carry-save
counter adds each plane's differences, and blocks in which every comparison has
passed the radius are abandoned.  Buckets of more than ``chunk`` fingerprints are
split at random into chunks, each pair of which is a cell of its own, so that no
task holds a bucket whole; a cell hands on only a spanning forest of its links.
The smallest reachable doc_id comes from alternating min-label stars.

Defined results: a text without words (also null) has fingerprint zero, linked
like any other; a component's id is its smallest non-null doc_id (null if it has
none); rows that repeat each get a row; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lapsewise.llm.common import map_arrow, on_workers, row_key, text_bytes, text_hash, texts
from lapsewise.sources import stage

SEED = 42
BITS = 64
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)
STEP = 1 << 16


def fingerprint(text: bytes, shingle: int = 3) -> int:
    """Unsigned fingerprint: each bit that is set in over half the shingles' hashes."""
    words = text.lower().split()  # of bytes: A-Z alone, and the six ASCII spaces
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > shingle:
        starts, ends = starts[: 1 - shingle], ends[shingle - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest, counts = xxhash.xxh64_intdigest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), STEP):
        spans = zip(starts[at : at + STEP].tolist(), ends[at : at + STEP].tolist())
        hashes = np.array([digest(line[a:b], SEED) for a, b in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    set_bits = (2 * counts > len(starts)).astype(np.uint8)
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def fingerprints(documents: DataFrame, shingle: int = 3) -> DataFrame:
    """(doc_id, text_hash, fp): the fingerprint as a signed 64-bit number."""

    def rows(batch: pa.RecordBatch) -> dict:
        made = np.array([fingerprint(t, shingle) for t in texts(batch)], dtype=np.uint64)
        kept = {c: batch.column(c) for c in ("doc_id", "text_hash")}
        return {**kept, "fp": pa.array(made.view(np.int64))}

    source = documents.select("doc_id", text_hash(), text_bytes())
    return map_arrow(source, rows, "doc_id long, text_hash long, fp long")


# -- bit-sliced comparison ----------------------------------------------------------


def planes(values: np.ndarray) -> np.ndarray:
    """Bit planes (64, words): bit j of word w of plane k is bit k of value 64 w + j."""
    padded = np.zeros(-(-len(values) // 64) * 64, np.uint64)
    padded[: len(values)] = values
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return np.packbits(np.ascontiguousarray(bits.T), axis=1, bitorder="little").view(np.uint64)


def within(difference, rows: int, words: int, radius: int) -> np.ndarray:
    """Lanes (rows, words) whose differing bits number at most ``radius``.

    ``difference(k, alive)`` gives plane k of the rows ``alive``.  A row in which
    every lane has passed the radius is abandoned.
    """
    n_counters = radius.bit_length()
    alive = np.arange(rows)
    counters = np.zeros((n_counters, rows, words), np.uint64)
    over = np.zeros((rows, words), np.uint64)
    for k in range(BITS):
        carry = difference(k, alive)
        for counter in counters:
            carry, counter[...] = counter & carry, counter ^ carry
        over |= carry
        if k % 4 == 3:
            open_rows = (over != FULL).any(axis=1)
            if not open_rows.all():
                alive, over, counters = alive[open_rows], over[open_rows], counters[:, open_rows]
                if not len(alive):
                    break
    # The counters hold up to 2 ** n - 1; those above the radius go as well.
    near = ~over
    if radius + 1 < 1 << n_counters:
        tied, more = np.full_like(near, FULL), np.zeros_like(near)
        for bit in reversed(range(n_counters)):
            if radius >> bit & 1:
                tied &= counters[bit]
            else:
                more |= tied & counters[bit]
                tied &= ~counters[bit]
        near &= ~more
    out = np.zeros((rows, words), np.uint64)
    out[alive] = near
    return out


def _lanes(mask: np.ndarray, n: int) -> np.ndarray:
    return np.unpackbits(mask.view(np.uint8), axis=-1, bitorder="little")[..., :n]


def links_in_block(left: np.ndarray, right: np.ndarray | None, radius: int) -> list[tuple[int, int]]:
    """Spanning forest of the links within ``left``, or between ``left`` and ``right``."""
    against = left if right is None else right
    table = planes(against)
    root = np.arange(len(left) + (0 if right is None else len(right)))
    offset = 0 if right is None else len(left)
    links = []
    step = max(1, (1 << 13) // table.shape[1])
    for at in range(0, len(left), step):
        asked = left[at : at + step]
        masks = np.where(asked[None, :] >> np.arange(BITS, dtype=np.uint64)[:, None] & np.uint64(1), FULL, np.uint64(0))
        near = within(lambda k, alive: table[k][None, :] ^ masks[k][alive][:, None], len(asked), table.shape[1], radius)
        for row in np.flatnonzero(near.any(axis=1)):
            found = np.flatnonzero(_lanes(near[row], len(against))) + offset
            for other in found[root[found] != root[at + row]].tolist():
                if root[other] != root[at + row]:
                    root[root == root[other]] = root[at + row]
                    links.append((int(left[at + row]), int(against[other - offset])))
    return links


def links_in_pairs(left: np.ndarray, right: np.ndarray, radius: int) -> np.ndarray:
    """Which of the paired values are within the radius: one lane a pair."""
    out = np.zeros(len(left), bool)
    for at in range(0, len(left), STEP):
        difference = planes(left[at : at + STEP] ^ right[at : at + STEP])
        rows = difference.shape[1]  # one word to a row, so that each is abandoned by itself
        near = within(lambda k, alive: difference[k][alive][:, None], rows, 1, radius)
        out[at : at + STEP] = _lanes(near[:, 0], len(left[at : at + STEP]))
    return out


def _links(cells: np.ndarray, sides: np.ndarray, values: np.ndarray, radius: int, small: int = 16) -> np.ndarray:
    """Links (a, b) within the cells of sorted rows; small cells share lanes."""
    starts = np.flatnonzero(np.r_[True, cells[1:] != cells[:-1]])
    sizes = np.diff(np.r_[starts, len(cells)])
    size = np.repeat(sizes, sizes)
    rank = np.arange(len(cells)) - np.repeat(starts, sizes)
    links = []
    for shift in range(1, small):
        first = np.flatnonzero((size <= small) & (rank + shift < size))
        if not len(first):
            break
        first = first[(sides[first] < 0) | (sides[first] != sides[first + shift])]
        a, b = values[first], values[first + shift]
        near = links_in_pairs(a, b, radius)
        links.append(np.column_stack([a[near], b[near]]))
    for start, n in zip(starts[sizes > small].tolist(), sizes[sizes > small].tolist()):
        held, side = values[start : start + n], sides[start : start + n]
        if side[0] < 0:
            found = links_in_block(held, None, radius)
        else:
            found = links_in_block(held[side == 0], held[side == 1], radius)
        links.append(np.array(found, np.uint64).reshape(-1, 2))
    return np.concatenate([np.zeros((0, 2), np.uint64), *links])


# -- candidates and links -------------------------------------------------------------


def _signed(value: int) -> int:
    return value - (1 << BITS) if value >> (BITS - 1) else value


def table_masks(radius: int) -> list[int]:
    """Masks of the bits on which the fingerprints of a table's bucket agree."""
    cuts = [round(i * BITS / (radius + 2)) for i in range(radius + 3)]
    blocks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(blocks, 2)]


def near_links(distinct: DataFrame, radius: int = 3, chunk: int = 4096) -> DataFrame:
    """(a, b): links between distinct fingerprints ``fp``; their components are those of all links."""
    tables = [
        F.struct(F.lit(t).alias("table"), F.col("fp").bitwiseAND(F.lit(_signed(mask))).alias("bits"))
        for t, mask in enumerate(table_masks(radius))
    ]
    keyed = distinct.select("fp", F.explode(F.array(*tables)).alias("k")).select("fp", "k.*")
    crowded = (
        keyed.groupBy("table", "bits").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)
    ).select("table", "bits", F.ceil(F.col("n") / chunk).cast("int").alias("chunks"))

    # Chunk c of a bucket stands in the cells (c, d) and (d, c) with every chunk d.
    own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
    cells = (
        keyed.join(crowded, ["table", "bits"])
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            "fp",
            F.xxhash64(
                "table", "bits", F.least("own", "other"), F.greatest("own", "other")
            ).alias("cell"),
            F.when(F.col("own") == F.col("other"), -1)
            .otherwise((F.col("own") > F.col("other")).cast("int"))
            .alias("side"),
        )
        .repartition("cell")
        .sortWithinPartitions("cell", "side", "fp")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole cells gather until there are rows enough to fill lanes.
        held: list[np.ndarray] = []

        def linked(rows: np.ndarray) -> pa.RecordBatch:
            found = _links(rows[0], rows[1], rows[2].view(np.uint64), radius).view(np.int64)
            return pa.RecordBatch.from_pydict({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

        for batch in batches:
            held.append(np.stack([batch.column(c).to_numpy().astype(np.int64) for c in ("cell", "side", "fp")]))
            if sum(x.shape[1] for x in held) >= STEP:
                rows = np.concatenate(held, axis=1)
                last = np.flatnonzero(rows[0] != rows[0, -1])
                cut = last[-1] + 1 if len(last) else 0
                held = [rows[:, cut:]]
                if cut:
                    yield linked(np.ascontiguousarray(rows[:, :cut]))
        rows = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
        if rows.shape[1]:
            yield linked(rows)

    return on_workers(cells).mapInArrow(run, "a long, b long").distinct()


# -- components ------------------------------------------------------------------------


def connected(links: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, root): the smallest node that each linked node reaches.

    Alternates large stars (a node's larger neighbours move to its smallest one)
    and small stars (a node and its smaller neighbours move to the smallest) until
    every component is a star.  Each round's edges are written to the shared
    checkpoint folder, so that no lineage grows and lost executors cost a round.
    """
    edges = stage(
        links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
        "links",
    )
    before = None
    for _ in range(max_rounds):
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _stars(both).where("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
        joined = _stars(large.where("u > v").distinct())
        small = joined.where("v <> least").select(F.col("v").alias("u"), F.col("least").alias("v"))
        own = joined.select("u", F.col("least").alias("v"))
        edges = stage(small.union(own).where("u > v").distinct(), "links")
        now = edges.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components still change after {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _stars(edges: DataFrame) -> DataFrame:
    """Edges (u, v) with ``least``, the smallest of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least")).withColumn("least", F.least("u", "least"))
    return edges.join(least, "u")


def hex_digits(fp: str = "fp") -> Column:
    return F.lower(F.lpad(F.hex(F.col(fp)), 16, "0"))


def near_duplicates(documents: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """doc_id, text_hash, fingerprint (16 hex digits) and component_id of every row.

    ``component`` is the component's smallest fingerprint, which tells components
    apart even where rows of several share a doc_id.
    """
    prints = stage(fingerprints(documents, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    root = connected(near_links(distinct.select("fp"), radius))
    linked = (
        distinct.join(root.withColumnRenamed("node", "fp"), "fp", "left")
        .select("fp", "first", F.coalesce("root", "fp").alias("root"))
    )
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(smallest, "root").select("fp", "component_id", hex_digits("root").alias("component"))
    return prints.join(named, "fp").select(
        "doc_id", "text_hash", hex_digits().alias("fingerprint"), "component_id", "component"
    )


def keep_one(documents: DataFrame, shingle: int = 3, radius: int = 3) -> DataFrame:
    """One whole row of each component: of those with its smallest doc_id, that with the smallest text hash."""
    found = near_duplicates(documents, shingle, radius)
    order = F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")
    first = found.groupBy("component").agg(F.min(order).alias("first")).select("first.doc_id", "first.text_hash")
    rows = documents.select(F.struct("*").alias("row"), *row_key())
    kept = rows.join(first.select(*row_key(hashed="text_hash")), ["_id", "_hash"], "left_semi")
    again = Window.partitionBy("_id", "_hash").orderBy("_hash")
    return kept.withColumn("_n", F.row_number().over(again)).where("_n = 1").select("row.*")

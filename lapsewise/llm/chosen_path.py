"""MinHash near-duplicates by a chosen-path set similarity join.

A document is the set of its distinct shingles; equal sets are one set.  A tree branches
sets by tokens: its root, and every node after it, chooses one or two of ``HASHES``
minwise functions (1 / threshold on average), and a set goes to the child named by its
minimum under each.  Two sets of the threshold's similarity thus share one child a level
on average, unlike ones soon part.  Nodes of at most ``leaf`` sets are compared
exhaustively; those still larger after ``depth`` levels are compared exhaustively, too,
cut into chunks, each pair of which is a cell of its own.  ``trees_for`` gives the number
of independent trees that find a pair of the threshold's similarity with the target
recall even if every node on its way is branched ``depth`` times.

Large groups of copies stay linear: before anything is branched or compared, every set of
a node meets the node's first set only, and what that leaves apart meets one set of the
node's biggest component.  What is linked then needs no further comparison among itself:
nodes of one component are done, and pairs within a component are passed over.  A node that
is mostly one component is not branched, since its sets would stay together: a component
that fills chunks has chunks of its own, which do not meet, and the other sets meet each.
Small nodes with the same members, from several trees, are one.

Sets are first compared by sketch, one byte of each minimum: pairs more than five
standard deviations below the threshold's agreement (for 256 bytes: below a similarity of
about 0.74) are dropped, less than one in a million of those at the threshold.  The others
are confirmed on the full sets, made again from the texts: with the first set of a node as
pairs, which are fewer than the members of nodes, and within a cell by intersections of all
sets that had a near sketch there, of which a spanning forest of the links is handed on.
So what is written grows with the members of nodes, not with the pairs of a group, and goes
once nothing reads it any more.

Defined results: a text without words (also null) has no shingles and is linked with
nothing; fewer words than a shingle's are one shingle; a component's id is its smallest
non-null doc_id (null if it has none), and a null doc_id is kept where that is null; rows
that repeat each get a row; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import map_arrow, on_workers, row_key, slices, text_bytes, text_hash, texts
from lapsewise.llm.simhash import connected
from lapsewise.sources import stage, unstage

SEED = 42
HASHES = 256
#: Rows of numbers that may be broadcast.
SMALL = 250_000
#: The chunks that small components share; components have numbers from 0 on.
COMMON = -1
#: Chunks of other sets that a component's chunks meet without the node being branched first.
DENSE = 8
#: Leaves' worth of members in all that are compared without being branched any further.
FEW = 128
STEP = 1 << 11
WORD = np.uint64
_draw = np.random.default_rng(SEED)
_ODD = _draw.integers(0, 1 << 32, HASHES, np.uint32) | np.uint32(1)
_MASK = _draw.integers(0, 1 << 32, HASHES, np.uint32)
_MIX = np.uint32(0x9E3779B1)


def shingles(text: bytes, size: int = 3) -> np.ndarray:
    """The sorted 64-bit hashes of a text's distinct shingles."""
    words = text.lower().split()  # of bytes: A-Z alone, and the six ASCII spaces
    if not words:
        return np.zeros(0, WORD)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    if len(words) > size:
        starts, ends = starts[: 1 - size], ends[size - 1 :]
    else:
        starts, ends = starts[:1], ends[-1:]
    digest = xxhash.xxh64_intdigest
    spans = zip(starts.tolist(), ends.tolist())
    return np.unique(np.fromiter((digest(line[a:b], SEED) for a, b in spans), WORD, len(starts)))


def minima(tokens: np.ndarray, n_roots: int) -> tuple[np.ndarray, np.ndarray]:
    """The sketch, a byte of each function's minimum, and the tokens that are minimal under the first ``n_roots``."""
    folded = (tokens ^ (tokens >> WORD(32))).astype(np.uint32)
    least = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    at = np.zeros(n_roots, np.int64)
    for start in range(0, len(folded), STEP):
        hashed = (folded[start : start + STEP, None] ^ _MASK) * _ODD
        first = hashed[:, :n_roots]
        where = first.argmin(axis=0)
        better = (first[where, np.arange(n_roots)] < least[:n_roots]) | (start == 0)
        at = np.where(better, where + start, at)
        least = np.minimum(least, hashed.min(axis=0))
    return ((least * _MIX) >> np.uint32(24)).astype(np.uint8), tokens[at]


# -- the trees ----------------------------------------------------------------------------


def mixed(*parts: np.ndarray) -> np.ndarray:
    """A 64-bit hash of numbers, elementwise."""
    out = np.zeros(1, WORD)
    with np.errstate(over="ignore"):
        for part in parts:
            out = out ^ np.asarray(part).astype(WORD)
            out = out + WORD(0x9E3779B97F4A7C15)
            out = (out ^ (out >> WORD(30))) * WORD(0xBF58476D1CE4E5B9)
            out = (out ^ (out >> WORD(27))) * WORD(0x94D049BB133111EB)
            out = out ^ (out >> WORD(31))
    return out


def lost(threshold: float, depth: int) -> float:
    """The chance that a pair of the threshold's similarity shares no node after ``depth`` levels."""
    two = 1 / threshold - 1
    none = 0.0
    for _ in range(depth):
        apart = 1 - threshold * (1 - none)
        none = (1 - two) * apart + two * apart * apart
    return none


def trees_for(threshold: float, recall: float, depth: int) -> int:
    return math.ceil(math.log(1 - recall) / math.log(lost(threshold, depth)))


def root_functions(threshold: float, trees: int) -> list[int]:
    """The tree of each function that a root chooses: functions 0, 1, ..., one or two a tree."""
    two = int((1 / threshold - 1) * (1 << 20))
    draws = mixed(np.arange(trees), WORD(SEED)) % WORD(1 << 20)
    return [t for t, d in enumerate(draws.tolist()) for _ in range(2 if d < two else 1)]


def branched(nodes: np.ndarray, sketches: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """(row, child) for the one or two functions that each row's node chooses."""
    two = int((1 / threshold - 1) * (1 << 20))
    rows = np.arange(len(nodes))
    first = (mixed(nodes, WORD(1)) % WORD(HASHES)).astype(np.int64)
    second = (first + 1 + (mixed(nodes, WORD(2)) % WORD(HASHES - 1)).astype(np.int64)) % HASHES
    again = rows[mixed(nodes, WORD(3)) % WORD(1 << 20) < WORD(two)]
    rows, chosen = np.concatenate([rows, again]), np.concatenate([first, second[again]])
    return rows, mixed(nodes[rows], chosen, sketches[rows, chosen])


# -- comparisons --------------------------------------------------------------------------


def fewest_equal(threshold: float, deviations: float = 5.0) -> int:
    """Bytes of a sketch on which a pair must agree to be worth confirming."""
    p = threshold + (1 - threshold) / 256
    return math.floor(HASHES * p - deviations * math.sqrt(HASHES * p * (1 - p)))


def _percent(threshold: float) -> int:
    return round(100 * threshold)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether 100 |a n b| >= percent |a u b|, for sorted distinct tokens."""
    joint = np.concatenate([a, b])
    joint.sort()
    both = int((joint[1:] == joint[:-1]).sum())
    return 100 * both >= percent * (len(joint) - both)


def close_pairs(left: np.ndarray, right: np.ndarray, least: int) -> np.ndarray:
    """Which rows of two arrays of sketches agree on ``least`` bytes."""
    out = np.zeros(len(left), bool)
    for at in range(0, len(left), 1 << 14):
        out[at : at + (1 << 14)] = (left[at : at + (1 << 14)] == right[at : at + (1 << 14)]).sum(axis=1) >= least
    return out


def pairs_in_cell(sides: np.ndarray, components: np.ndarray, sizes: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs of a cell that are not known to be linked and whose sizes allow a link."""
    if sides[0] < 0:
        i, j = np.triu_indices(len(sides), 1)
    else:
        i, j = (x.ravel() for x in np.meshgrid(np.flatnonzero(sides == 0), np.flatnonzero(sides == 1), indexing="ij"))
    a, b = sizes[i], sizes[j]
    open_ = (components[i] != components[j]) & (100 * np.minimum(a, b) >= percent * np.maximum(a, b))
    return i[open_], j[open_]


def _sketches(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, HASHES)


# -- on Spark -----------------------------------------------------------------------------


def prints(documents: DataFrame, shingle: int, roots: Iterable[int]) -> DataFrame:
    """(doc_id, text_hash, n_shingles, k1, k2, nodes, sketch): k1 and k2 stand for the set; null without words."""
    trees = np.array(list(roots), WORD)
    functions = np.arange(len(trees), dtype=WORD)

    def rows(batch: pa.RecordBatch) -> dict:
        sizes, k1, k2, nodes, sketches = [], [], [], [], []
        for text in texts(batch):
            tokens = shingles(text, shingle)
            sizes.append(len(tokens))
            if not len(tokens):
                for column in (k1, k2, nodes, sketches):
                    column.append(None)
                continue
            data = tokens.tobytes()
            k1.append(xxhash.xxh64_intdigest(data, 1) >> 1)
            k2.append(xxhash.xxh64_intdigest(data, 2) >> 1)
            sketch, least = minima(tokens, len(trees))
            nodes.append(mixed(least, trees, functions).view(np.int64))
            sketches.append(sketch.tobytes())
        kept = {c: batch.column(c) for c in ("doc_id", "text_hash")}
        return {
            **kept,
            "n_shingles": pa.array(sizes, pa.int64()),
            "k1": pa.array(k1, pa.int64()),
            "k2": pa.array(k2, pa.int64()),
            "nodes": pa.array(nodes, pa.list_(pa.int64())),
            "sketch": pa.array(sketches, pa.binary()),
        }

    source = documents.select("doc_id", text_hash(), text_bytes())
    schema = "doc_id long, text_hash long, n_shingles long, k1 long, k2 long, nodes array<long>, sketch binary"
    return map_arrow(source, rows, schema)


def distinct_sets(printed: DataFrame) -> DataFrame:
    """(s, k1, k2, first, doc_id, text_hash, n, nodes, sketch): each set once, under a number.

    ``first`` is its smallest doc_id; doc_id and text_hash name a row that has it.
    """
    row = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "text_hash")
    held = printed.where("n_shingles > 0").groupBy("k1", "k2").agg(
        F.min("doc_id").alias("first"),
        F.min(row).alias("row"),
        *(F.first(c).alias(c) for c in ("n_shingles", "nodes", "sketch")),
    )
    return held.select(
        F.monotonically_increasing_id().alias("s"),
        "k1", "k2", "first", "row.doc_id", "row.text_hash", F.col("n_shingles").alias("n"), "nodes", "sketch",
    )


def _sizes_allow(a: str, b: str, percent: int):
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def first_pairs(members: DataFrame, percent: int) -> DataFrame:
    """(a, b): every set of a node with the node's first, where sizes allow a link."""
    first = stage(members.groupBy("node").agg(F.min("s").alias("a"), F.min_by("n", "s").alias("m")), "first-sets")
    met = members.join(first, "node").where((F.col("s") > F.col("a")) & _sizes_allow("n", "m", percent))
    return met.select("a", F.col("s").alias("b")).distinct()


def pairs_with_biggest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b): a set of each node's biggest component, drawn by hash, with every set there of another component."""
    size = F.count(F.lit(1)).alias("n")
    kinds = members.groupBy("node", "component").agg(size, F.min_by("s", F.xxhash64("node", "s")).alias("a"))
    kept = [F.max_by(c, F.struct("n", "component")).alias(x) for c, x in (("a", "a"), ("component", "biggest"))]
    drawn = stage(kinds.groupBy("node").agg(*kept, F.count(F.lit(1)).alias("kinds")).where("kinds > 1"), "drawn-sets")
    met = members.join(drawn, "node").where("component <> biggest").select("a", F.col("s").alias("b")).distinct()
    one, other = sets.select(F.col("s").alias("a"), F.col("n")), sets.select(F.col("s").alias("b"), F.col("n").alias("m"))
    return met.join(one, "a").join(other, "b").where(_sizes_allow("n", "m", percent)).select("a", "b")


def _with_both(pairs: DataFrame, held: DataFrame, column: str) -> DataFrame:
    """Pairs with ``column`` of both sides, as ``left`` and ``right``."""
    one = held.select(F.col("s").alias("a"), F.col(column).alias("left"))
    other = held.select(F.col("s").alias("b"), F.col(column).alias("right"))
    return pairs.join(one, "a").join(other, "b").select("a", "b", "left", "right")


def sketched_alike(pairs: DataFrame, sets: DataFrame, least: int) -> DataFrame:
    """The pairs (a, b) whose sketches agree on ``least`` bytes."""

    def rows(batch: pa.RecordBatch) -> dict:
        near = close_pairs(_sketches(batch.column("left")), _sketches(batch.column("right")), least)
        kept = batch.filter(pa.array(near))
        return {"a": kept.column("a"), "b": kept.column("b")}

    return map_arrow(_with_both(pairs, sets, "sketch"), rows, "a long, b long")


def full_sets(asked: DataFrame, documents: DataFrame, sets: DataFrame, shingle: int) -> DataFrame:
    """(s, tokens): the sets ``asked`` for, made again from their texts and written."""
    asked = stage(sets.select("s", *row_key(hashed="text_hash")).join(asked.distinct(), "s", "left_semi"), "asked-sets")
    rows = documents.select(text_bytes(), *row_key())
    found = rows.join(F.broadcast(asked) if asked.count() <= SMALL else asked, ["_id", "_hash"])

    def tokens(batch: pa.RecordBatch) -> dict:
        made = [shingles(t, shingle).tobytes() for t in texts(batch)]
        return {"s": batch.column("s"), "tokens": pa.array(made, pa.binary())}

    # A row that repeats is one text.
    return stage(map_arrow(found.select("s", "text"), tokens, "s long, tokens binary").dropDuplicates(["s"]), "full-sets")


def confirmed(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that are similar by their full sets."""

    def judged(batch: pa.RecordBatch) -> dict:
        sides = zip(*(batch.column(c).to_pylist() for c in ("left", "right")))
        near = [similar(np.frombuffer(x, WORD), np.frombuffer(y, WORD), percent) for x, y in sides]
        kept = batch.filter(pa.array(near, pa.bool_()))
        return {"a": kept.column("a"), "b": kept.column("b")}

    return map_arrow(_with_both(pairs, full, "tokens"), judged, "a long, b long")


def _once(nodes: DataFrame, leaf: int) -> DataFrame:
    """(node, held, biggest): of small nodes with the same members, which different trees come to, one.

    Staged, so that a node with very many sets can be split where it is joined.
    """
    small = nodes.where(F.col("held") <= leaf).groupBy("held", "mark").agg(F.min("node").alias("node"))
    small = small.select("node", "held", F.lit(0).cast("long").alias("biggest"))
    return stage(small.unionByName(nodes.where(F.col("held") > leaf).select("node", "held", "biggest")), "nodes")


def crowded_nodes(nodes: DataFrame, leaf: int) -> DataFrame:
    """(node): nodes of more than one set."""
    held = nodes.groupBy("node").agg(F.count(F.lit(1)).alias("held"), F.bit_xor(F.xxhash64("s")).alias("mark"))
    return _once(held.where("held > 1").withColumn("biggest", F.lit(1).cast("long")), leaf).select("node")


def _open_nodes(members: DataFrame, leaf: int) -> DataFrame:
    """(node, held, biggest): nodes of more than one component; how many sets the biggest one has in a large node."""
    kinds = members.groupBy("node", "component").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("s")).alias("mark"))
    nodes = kinds.groupBy("node").agg(
        F.sum("n").alias("held"), F.max("n").alias("biggest"), F.bit_xor("mark").alias("mark")
    )
    return _once(nodes.where("biggest < held"), leaf)


def _branches(members: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The children (node, s, component) of members of large nodes."""

    def rows(batch: pa.RecordBatch) -> dict:
        at, child = branched(batch.column("node").to_numpy().view(WORD), _sketches(batch.column("sketch")), threshold)
        taken = pa.array(at)
        return {
            "node": pa.array(child.view(np.int64)),
            "s": batch.column("s").take(taken),
            "component": batch.column("component").take(taken),
        }

    source = members.join(sets.select("s", "sketch"), "s").select("node", "s", "component", "sketch")
    return map_arrow(source, rows, "node long, s long, component long")


def _chunked(members: DataFrame, size: int) -> DataFrame:
    """(cell, side, s, component) for nodes too large to be compared at once.

    Sets of small components are dealt to common chunks, a component of more than a chunk
    has chunks of its own.  Every pair of chunks is a cell, but for two of one component.
    """
    held = members.groupBy("node", "component").agg(F.count(F.lit(1)).alias("held"))
    kind = F.when(F.col("held") > size, F.col("component")).otherwise(COMMON).alias("kind")
    kinds = held.groupBy("node", kind).agg(F.ceil(F.sum("held") / size).cast("int").alias("chunks"))
    kinds = stage(kinds, "chunks")
    large = kinds.where(F.col("kind") != COMMON).select("node", F.col("kind").alias("component"), F.lit(1).alias("large"))
    dealt = members.join(large, ["node", "component"], "left").withColumn(
        "kind", F.when(F.col("large").isNotNull(), F.col("component")).otherwise(COMMON)
    )
    chunk = F.pmod(F.xxhash64("s"), F.col("chunks")).cast("int")
    dealt = dealt.join(kinds, ["node", "kind"]).select(
        "node", "s", "component", F.struct("kind", chunk.alias("chunk")).alias("here")
    )
    every = F.transform(F.sequence(F.lit(0), F.col("chunks") - 1), lambda c: F.struct("kind", c.alias("chunk")))
    met = dealt.join(kinds.select("node", F.explode(every).alias("there")), "node").where(
        (F.col("here.kind") != F.col("there.kind")) | (F.col("here.kind") == COMMON)
    )
    return met.select(
        F.xxhash64("node", F.least("here", "there"), F.greatest("here", "there")).alias("cell"),
        F.when(F.col("here") == F.col("there"), -1).otherwise((F.col("here") > F.col("there")).cast("int")).alias("side"),
        "s",
        "component",
    )


def cells(
    members: DataFrame, sets: DataFrame, threshold: float, depth: int, leaf: int
) -> tuple[DataFrame, list[DataFrame]]:
    """(cell, side, s, component): what is compared exhaustively, from the members of the first nodes,
    which are unstaged, and the staged frames that this reads."""
    parts, staged = [], []
    for level in range(1, depth + 1):
        open_ = stage(members.join(_open_nodes(members, leaf), "node"), "open-members")
        unstage(members)
        staged.append(open_)
        small = open_.where(F.col("held") <= leaf)
        parts.append(small.select(F.col("node").alias("cell"), F.lit(-1).alias("side"), "s", "component"))
        large = open_.where(F.col("held") > leaf)
        # Branching does not part what is alike: the sets beside a component that is most of a
        # node meet its chunks at once, unless they fill many chunks themselves.
        beside = F.col("held") - F.col("biggest")
        dense = F.lit(level == depth) | ((beside <= F.col("biggest")) & (beside <= DENSE * leaf))
        rest = large.where(~dense)
        last = rest.count() <= FEW * leaf  # not worth more levels
        parts.append(_chunked((large if last else large.where(dense)).select("node", "s", "component"), 2 * leaf))
        if last:
            break
        members = stage(_branches(rest.select("node", "s", "component"), sets, threshold), "members")
    made = parts[0]
    for part in parts[1:]:
        made = made.union(part)
    return made, staged


def _by_cell(dealt: DataFrame, columns: list[str], done: Callable[..., pa.RecordBatch], schema: str, rows: int) -> DataFrame:
    """``done(numbers, column)`` on whole cells, at least ``rows`` rows at once: cell, side, s, component, n, and the last column."""
    source = dealt.withColumn("side", F.col("side").cast("long")).select(*columns)
    source = source.repartition("cell").sortWithinPartitions("cell")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        last_column: list[bytes] = []
        for batch in slices(batches):
            held.append(np.stack([batch.column(c).to_numpy() for c in columns[:-1]]))
            last_column += batch.column(columns[-1]).to_pylist()
            if len(last_column) >= rows:
                numbers = np.concatenate(held, axis=1)
                others = np.flatnonzero(numbers[0] != numbers[0, -1])
                cut = int(others[-1]) + 1 if len(others) else 0
                if cut:
                    yield done(numbers[:, :cut], last_column[:cut])
                held, last_column = [numbers[:, cut:]], last_column[cut:]
        if last_column:
            yield done(np.concatenate(held, axis=1), last_column)

    return on_workers(source).mapInArrow(run, schema)


def _cuts(cell: np.ndarray) -> Iterator[tuple[int, int]]:
    starts = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]).tolist()
    return ((a, b) for a, b in zip(starts, [*starts[1:], len(cell)]) if b - a > 1)


def sketched_cells(dealt: DataFrame, sets: DataFrame, percent: int, least: int) -> DataFrame:
    """The members of cells that agree on ``least`` bytes with another, whom no component links with them yet.

    What is left of a cell gets a number made from its members, so that cells of several
    trees that come to the same are one.
    """

    def done(numbers: np.ndarray, sketches: list[bytes]) -> pa.RecordBatch:
        cell, side, s, component, n = numbers
        sketch = np.frombuffer(b"".join(sketches), np.uint8).reshape(-1, HASHES)
        kept, named = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for a, b in _cuts(cell):
            i, j = pairs_in_cell(side[a:b], component[a:b], n[a:b], percent)
            if not len(i):
                continue
            near = close_pairs(sketch[a:b][i], sketch[a:b][j], least)
            rows = np.unique(np.concatenate([i[near], j[near]])) + a
            if len(rows):
                rows = rows[np.argsort(s[rows])]
                name = xxhash.xxh64_intdigest(np.stack([s[rows], side[rows]]).tobytes(), SEED) >> 1
                kept.append(rows)
                named.append(np.full(len(rows), name))
        at = np.concatenate(kept)
        columns = {"cell": np.concatenate(named), "side": side[at], "s": s[at], "component": component[at], "n": n[at]}
        return pa.RecordBatch.from_pydict({c: pa.array(v) for c, v in columns.items()})

    source = dealt.join(sets.select("s", "n", "sketch"), "s")
    schema = "cell long, side long, s long, component long, n long"
    return _by_cell(source, ["cell", "side", "s", "component", "n", "sketch"], done, schema, 1 << 15).distinct()


def links_in_cell(
    sides: np.ndarray, components: np.ndarray, tokens: list[np.ndarray], percent: int, width: int = 1 << 12
) -> list[tuple[int, int]]:
    """A spanning forest of the links between different components, by the full sets."""
    sizes = np.array([len(t) for t in tokens])
    owner = np.repeat(np.arange(len(tokens)), sizes)
    held, at, times = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)
    # Tokens of one set alone are in no intersection.
    column = np.cumsum(times > 1) - 1
    shared = times[at] > 1
    owner, at = owner[shared], column[at[shared]]
    both = np.zeros((len(tokens), len(tokens)), np.float32)
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, width):
        a, b = np.searchsorted(at, [low, low + width])
        part = np.zeros((len(tokens), width), np.float32)
        part[owner[a:b], at[a:b] - low] = 1
        both += part @ part.T
    both = both.astype(np.int64)
    linked = 100 * both >= percent * (sizes[:, None] + sizes[None, :] - both)
    if sides[0] >= 0:
        linked &= sides[:, None] != sides[None, :]
    root = np.unique(components, return_inverse=True)[1]
    links = []
    for row in range(len(tokens)):
        for other in np.flatnonzero(linked[row] & (root != root[row])).tolist():
            if root[other] != root[row]:
                root[root == root[other]] = root[row]
                links.append((row, other))
    return links


def linked_cells(dealt: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """(a, b): spanning forests of the links within cells, by the full sets."""

    def done(numbers: np.ndarray, data: list[bytes]) -> pa.RecordBatch:
        cell, side, s, component, _ = numbers
        tokens = [np.frombuffer(x, WORD) for x in data]
        found = [
            (s[a + i], s[a + j])
            for a, b in _cuts(cell)
            for i, j in links_in_cell(side[a:b], component[a:b], tokens[a:b], percent)
        ]
        pairs = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_pydict({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})

    columns = ["cell", "side", "s", "component", "n", "tokens"]
    return _by_cell(dealt.join(full, "s"), columns, done, "a long, b long", 1 << 10).distinct()


def components(
    documents: DataFrame, sets: DataFrame, shingle: int, threshold: float, depth: int, leaf: int
) -> DataFrame:
    """(s, root): the smallest set that each linked set reaches."""
    percent, least = _percent(threshold), fewest_equal(threshold)
    nodes = sets.select("s", "n", F.explode("nodes").alias("node"))
    members = stage(nodes.join(crowded_nodes(nodes, leaf), "node"), "first-nodes")

    def linked(pairs: DataFrame) -> DataFrame:
        near = stage(sketched_alike(pairs, sets, least), "near-pairs")
        asked = near.select(F.col("a").alias("s")).union(near.select(F.col("b").alias("s")))
        full = full_sets(asked, documents, sets, shingle)
        links = stage(confirmed(near, full, percent), "links")
        unstage(near, full)
        return links

    def placed(links: DataFrame) -> DataFrame:
        """Members with a set of their component: of each set's neighbours and theirs the smallest by two steps.

        What has the same one is linked; that some of a component has another only costs comparisons.
        """
        ends = links.union(links.select("b", "a")).toDF("s", "other").groupBy("s").agg(F.min("other").alias("root"))
        near = stage(ends.select("s", F.least("s", "root").alias("root")), "neighbours")
        further = near.select(F.col("s").alias("root"), F.col("root").alias("further"))
        known = near.join(further, "root", "left").select("s", F.coalesce("further", "root").alias("root"))
        return stage(members.join(known, "s", "left").select("node", "s", F.coalesce("root", "s").alias("component")), "members")

    links = linked(first_pairs(members, percent))
    known = placed(links)
    links = links.union(linked(pairs_with_biggest(known, sets, percent)))
    unstage(known)
    known = placed(links)
    unstage(members)
    dealt, parts = cells(known, sets, threshold, depth, leaf)
    open_ = stage(sketched_cells(dealt, sets, percent, least), "open-cells")
    unstage(*parts)
    full = full_sets(open_.select("s"), documents, sets, shingle)
    more = linked_cells(open_, full, percent)
    reached = connected(links.union(more)).select(F.col("node").alias("s"), "root")
    unstage(open_, full)
    return reached


def near_duplicates(
    documents: DataFrame,
    shingle: int = 3,
    threshold: float = 0.85,
    recall: float = 1 - 1e-6,
    depth: int = 6,
    leaf: int = 256,
) -> DataFrame:
    """doc_id, n_shingles, component_id and kept (doc_id is the component's) of every row."""
    roots = root_functions(threshold, trees_for(threshold, recall, depth))
    printed = stage(prints(documents, shingle, roots), "prints")
    sets = stage(distinct_sets(printed), "sets")
    rows = stage(printed.select("doc_id", "n_shingles", "k1", "k2"), "rows")
    unstage(printed)
    linked = sets.join(components(documents, sets, shingle, threshold, depth, leaf), "s", "left")
    linked = linked.select("k1", "k2", "first", F.coalesce("root", "s").alias("root"))
    smallest = linked.groupBy("root").agg(F.min("first").alias("component_id"))
    named = linked.join(smallest, "root").select("k1", "k2", "component_id")
    id_ = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return (
        rows.join(named, ["k1", "k2"], "left")
        .select("doc_id", "n_shingles", id_.alias("component_id"))
        .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
    )

"""Spelling variants: words one edit apart, found with a bit-sliced position index.

Words are counted map-side, and those long and frequent enough form the vocabulary.  A
block of it is indexed by one bitset per position and letter: bit i is set where word i
has the letter there.  Reading a word letter by letter, two sets are carried along,
64 words of the block to a machine word: those that agree so far, and those with one
error, either a letter replaced (positions stay) or a letter more (read one position
on).  A letter fewer is a letter more of the longer word, so each pair is found from its
shorter word and handed on for both.

Of two words one edit apart the front or the back half of the shorter's length is the
same.  So words meet only in buckets of a length and a half, and the search grows with
the buckets, not with the square of the vocabulary.  Small buckets of a length share a
block, each word's sets beginning with its own bucket; buckets of more than ``block``
words are split at random into chunks, each pair of which is a cell of its own, so that
no task holds a bucket whole.  A cell hands on one row for each word with a near one:
how many, and the best.  What form a word takes leads to a word at least ``factor``
times as frequent, so chains are short and are followed by doubling.

Defined results: a null text has no words; a null doc_id is written as nothing before
the colon; a word that loses its only letter is gone; rows that repeat count each time;
words of any length take part; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import on_workers, slices, text_bytes, texts
from lapsewise.sources import stage

#: Runs after lower-casing A-Z.
RUN = re.compile("[a-zÀ-ÿ]+")
SLIP = 199
FRONT, BACK = 0, 1
#: Counted words that a task holds before it hands them on.
HELD = 200_000
STEP = 1 << 16
FULL = np.uint64(0xFFFFFFFFFFFFFFFF)


# -- words ------------------------------------------------------------------------------


def slipped(run: str, seed: int, every: int = SLIP) -> str:
    """``run`` as it counts: one letter short if its checksum, begun with ``seed``, says so."""
    h = crc32(run.encode(), seed)
    if h % every:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1 :]


def count_runs(documents: Iterable[tuple[int | None, bytes]], total: Counter, every: int = SLIP) -> None:
    for doc_id, data in documents:
        runs = RUN.findall(data.lower().decode(errors="replace"))
        total.update(runs)
        seed = crc32(f"{'' if doc_id is None else doc_id}:".encode())
        changed = {run for run in set(runs) if not crc32(run.encode(), seed) % every}
        for run, n in Counter(filter(changed.__contains__, runs)).items() if changed else ():
            total[run] -= n
            total[slipped(run, seed, every)] += n


def word_counts(documents: DataFrame, min_length: int, every: int = SLIP) -> DataFrame:
    """(word, n): counts of each task's words, of at least ``min_length`` letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter = Counter()

        def counted() -> pa.RecordBatch:
            kept = [(w, n) for w, n in total.items() if n > 0 and len(w) >= min_length]
            total.clear()
            words, n = zip(*kept) if kept else ((), ())
            return pa.RecordBatch.from_pydict({"word": pa.array(words, pa.string()), "n": pa.array(n, pa.int64())})

        for batch in slices(batches):
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                count_runs(zip(part.column("doc_id").to_pylist(), texts(part)), total, every)
                if len(total) >= HELD:
                    yield counted()
        yield counted()

    source = documents.select(F.col("doc_id").cast("long").alias("doc_id"), text_bytes())
    return on_workers(source).mapInArrow(run, "word string, n long")


def vocabulary(documents: DataFrame, min_length: int = 6, min_count: int = 5, every: int = SLIP) -> DataFrame:
    """(word, n) of the words of at least ``min_length`` letters that occur ``min_count`` times."""
    counts = word_counts(documents, min_length, every)
    return counts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


# -- words one edit apart ---------------------------------------------------------------


def _block(length: int, block: int) -> int:
    """Words of a block: fewer of long ones, so that an index has a bounded size."""
    return max(64, min(block, (1 << 22) // (length + 1)))


def _pack(rows: np.ndarray) -> np.ndarray:
    """Bits (n, m) as words (n, ceil(m / 64))."""
    padded = np.zeros((len(rows), -(-rows.shape[1] // 64) * 64), bool)
    padded[:, : rows.shape[1]] = rows
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def near_in_block(words: list[bytes], length: int, cells: np.ndarray, sides: np.ndarray, step: int = 1024) -> np.ndarray:
    """Pairs (i, j): word i of ``length`` letters and word j, one edit apart and no shorter.

    Words have ``length`` letters (Latin-1 bytes) or one more; they meet within a cell,
    and there, where sides are not negative, those of one side the other's.
    """
    letters = np.array(words, f"S{length + 1}").view(np.uint8).reshape(len(words), length + 1)
    long = letters[:, length] > 0
    present = np.unique(letters)
    code = np.zeros(256, np.int64)
    code[present] = np.arange(len(present))
    # index[p][c]: the words with letter c at position p.
    index = np.stack([_pack(letters[:, p][None, :] == present[:, None]) for p in range(length + 1)])
    ends_here, ends_next = _pack(~long[None, :])[0], _pack(long[None, :])[0]
    found = []
    asked = np.flatnonzero(~long)
    for at in range(0, len(asked), step):
        query = asked[at : at + step]
        meets = cells[query][:, None] == cells[None, :]
        meets &= (sides[query] < 0)[:, None] | (sides[query][:, None] != sides[None, :])
        right = _pack(meets)  # agree so far
        wrong = np.zeros_like(right)  # one letter replaced
        more = np.zeros_like(right)  # one letter more
        for p in range(length):
            letter = code[letters[query, p]]
            here, next_ = index[p][letter], index[p + 1][letter]
            more |= right
            more &= next_
            wrong &= here
            wrong |= right & ~here
            right &= here
        near = wrong & ends_here | (more | right) & ends_next
        hit = np.flatnonzero(near.any(axis=1))
        lanes = np.unpackbits(near[hit].view(np.uint8), axis=1, bitorder="little")
        i, j = np.nonzero(lanes)
        found.append(np.column_stack([query[hit[i]], j]))
    return np.concatenate(found) if found else np.zeros((0, 2), np.int64)


def _near_rows(rows: np.ndarray, words: list[str], block: int) -> dict[str, list]:
    """One row for each word with near ones, from whole cells of sorted rows (length, cell, side, half, n)."""
    lengths, cells, sides, halves, n = rows
    starts = np.flatnonzero(np.r_[True, (cells[1:] != cells[:-1]) | (lengths[1:] != lengths[:-1])])
    ends = np.r_[starts[1:], len(cells)]
    coded = [w.encode("latin-1") for w in words]
    blocks: list[tuple[int, int]] = []
    for a, b in zip(starts.tolist(), ends.tolist()):
        if blocks and lengths[a] == lengths[blocks[-1][0]] and b - blocks[-1][0] <= _block(int(lengths[a]), block):
            blocks[-1] = (blocks[-1][0], b)
        else:
            blocks.append((a, b))
    pairs = [np.zeros((0, 2), np.int64)]
    for a, b in blocks:
        if b - a > 1:
            length = int(lengths[a])
            made = near_in_block(coded[a:b], length, cells[a:b], sides[a:b]) + a
            # Words with the same front half meet in its bucket, too.
            half = length // 2
            again = [halves[i] == BACK and coded[i][:half] == coded[j][:half] for i, j in made.tolist()]
            made = made[~np.array(again, bool)]
            grown = lengths[a] < np.fromiter((len(coded[j]) for j in made[:, 1].tolist()), np.int64, len(made))
            pairs += [made, made[grown][:, ::-1]]
    i, j = np.concatenate(pairs).T
    order = np.lexsort((np.array(words, object)[j], -n[j], i)) if len(i) else i
    i, j = i[order], j[order]
    first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]]) if len(i) else i
    return {
        "word": pa.array([words[k] for k in i[first].tolist()], pa.string()),
        "n_near": pa.array(np.diff(np.r_[first, len(i)])),
        "best_n": pa.array(n[j[first]]),
        "best": pa.array([words[k] for k in j[first].tolist()], pa.string()),
    }


def _buckets(words: DataFrame) -> DataFrame:
    """(word, n, length, half, bucket): each word under its own length and the one before it."""
    size = F.length("word")
    keyed = words.select("word", "n", F.explode(F.array(size, size - 1)).alias("length"))
    half = F.floor(F.col("length") / 2).cast("int")

    def bucket(name: int, text: Column) -> Column:
        return F.struct(F.lit(name).alias("half"), F.xxhash64("length", F.lit(name), text).alias("bucket"))

    front = bucket(FRONT, F.substr("word", F.lit(1), half))
    back = bucket(BACK, F.substr("word", (size - half + 1).cast("int"), half))
    return keyed.select("word", "n", "length", F.explode(F.array(front, back)).alias("b")).select(
        "word", "n", "length", "b.*"
    )


def near_words(words: DataFrame, block: int = 4096) -> DataFrame:
    """(word, n_near, best_n, best): how many words are one edit away, and the most frequent of them."""
    keyed = _buckets(words)
    key = ["length", "bucket"]
    limit = F.greatest(F.lit(64), F.least(F.lit(block), F.floor(F.lit(1 << 22) / (F.col("length") + 1))))
    crowded = (
        keyed.groupBy(*key)
        .agg(F.count(F.lit(1)).alias("held"))
        .where("held > 1")
        .select(*key, F.ceil(F.col("held") / limit).cast("int").alias("chunks"))
    )
    # Chunk c of a bucket stands in the cells (c, d) and (d, c) with every chunk d.
    cells = (
        keyed.join(crowded, key)
        .withColumn("own", F.pmod(F.xxhash64("word"), F.col("chunks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        .select(
            F.col("length").cast("long").alias("length"),
            F.xxhash64("bucket", F.least("own", "other"), F.greatest("own", "other")).alias("cell"),
            F.when(F.col("own") == F.col("other"), -1)
            .otherwise((F.col("own") > F.col("other")).cast("int"))
            .cast("long")
            .alias("side"),
            F.col("half").cast("long").alias("half"),
            "n",
            "word",
        )
        .repartition("length", "cell")
        .sortWithinPartitions("length", "cell")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Whole cells gather until there are words enough to fill blocks.
        numbers: list[np.ndarray] = []
        words: list[str] = []
        for batch in slices(batches):
            numbers.append(np.stack([batch.column(c).to_numpy() for c in ("length", "cell", "side", "half", "n")]))
            words += batch.column("word").to_pylist()
            if len(words) >= STEP:
                rows = np.concatenate(numbers, axis=1)
                last = np.flatnonzero((rows[1] != rows[1, -1]) | (rows[0] != rows[0, -1]))
                cut = int(last[-1]) + 1 if len(last) else 0
                if cut:
                    yield pa.RecordBatch.from_pydict(_near_rows(rows[:, :cut], words[:cut], block))
                numbers, words = [rows[:, cut:]], words[cut:]
        if words:
            yield pa.RecordBatch.from_pydict(_near_rows(np.concatenate(numbers, axis=1), words, block))

    parts = on_workers(cells).mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), "best")).alias("b")
    return parts.groupBy("word").agg(F.sum("n_near").alias("n_near"), best).select(
        "word", "n_near", (-F.col("b.less")).alias("best_n"), "b.best"
    )


# -- groups -----------------------------------------------------------------------------


def last_forms(forms: DataFrame) -> DataFrame:
    """(word, root): where the chains of (word, form) end.  Each round doubles the steps taken."""
    links = stage(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        on = links.select(F.col("word").alias("root"), F.col("root").alias("further"))
        moved = stage(links.join(on, "root", "left").select("word", F.coalesce("further", "root").alias("root"), "further"), "forms")
        if moved.where("further is not null").isEmpty():
            return moved.drop("further")
        links = moved.drop("further")


def variant_groups(
    documents: DataFrame, min_length: int = 6, min_count: int = 5, factor: int = 5, every: int = SLIP, block: int = 4096
) -> DataFrame:
    """word, form, root, n, n_near and form_n of every word of the vocabulary."""
    words = stage(vocabulary(documents, min_length, min_count, every), "vocabulary")
    taken = F.col("best_n") >= factor * F.col("n")
    formed = words.join(near_words(words, block), "word", "left").select(
        "word",
        F.when(taken, F.col("best")).alias("form"),
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(taken, F.col("best_n")).alias("form_n"),
    )
    formed = stage(formed, "formed-words")
    roots = last_forms(formed.where("form is not null"))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )

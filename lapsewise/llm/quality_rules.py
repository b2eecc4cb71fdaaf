"""Quality rules: fixed limits first, then gradient-boosted trees over document statistics.

The trees learn ``labels.quality`` from a bounded sample of labelled documents'
statistics by second-order boosting on histograms.  On the features in
``FALLING`` a higher value can never raise a score: no split may turn the other way,
and the middle of a split's two values bounds what is below it.  Trained trees are
flattened into numpy arrays of nodes, so that a batch of rows descends all trees together.

Defined results: a null or empty text has no words and fails the base limits; without
labels of both classes the trees keep everything; rows that repeat are judged alike;
columns other than doc_id and text are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import held_out, labelled_sample, map_arrow, text_bytes, texts

SYMBOLS = b"#*$%&|<>"
SPACES = b" \t\n\x0b\x0c\r"
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words",
    "word_length",
    "symbol_share",
    "dup_line_share",
    "repeat_share",
    "upper_share",
    "digit_share",
    "bang_share",
    "distinct_share",
    "words_per_line",
)
#: Features on which more is never better.
FALLING = ("symbol_share", "dup_line_share", "repeat_share", "upper_share", "bang_share")

_UPPER = bytes(range(ord("A"), ord("Z") + 1))
_DIGITS = b"0123456789"


def _count(text: bytes, chars: bytes) -> int:
    return len(text) - len(text.translate(None, chars))


def repeated_words(words: list[bytes], window: int = 3) -> int:
    """Words that lie in some window of words found at least twice."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    seen: dict[bytes, int] = {}
    codes = np.fromiter((seen.setdefault(w, len(seen)) for w in words), np.int64, len(words))
    keys = codes[:n]
    for shift in range(1, window):
        if int(keys.max() + 1) * len(seen) >= 1 << 62:
            keys = np.unique(keys, return_inverse=True)[1]
        keys = keys * len(seen) + codes[shift : shift + n]
    _, which, counts = np.unique(keys, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[which] > 1)
    covered = np.zeros(len(words), bool)
    for shift in range(window):
        covered[starts + shift] = True
    return int(covered.sum())


def statistics(text: bytes) -> tuple[list[int], list[float]]:
    """The base statistics and the trees' features of a whole text."""
    words = text.split()
    n = len(words)
    lines = [line for line in text.split(b"\n") if line.strip(SPACES)]
    dup_lines = len(lines) - len(set(lines))
    # Code points: bytes that do not continue a character.
    dense = text.translate(None, SPACES)
    chars = len(dense) - _count(dense, bytes(range(0x80, 0xC0)))
    symbols = _count(text, SYMBOLS)
    repeats = repeated_words(words)
    some, length, rows = max(n, 1), max(chars, 1), max(len(lines), 1)
    features = [
        float(np.log1p(n)),
        chars / some,
        symbols / some,
        dup_lines / rows,
        repeats / some,
        _count(dense, _UPPER) / length,
        _count(dense, _DIGITS) / length,
        text.count(b"!") / some,
        len(set(words)) / some,
        n / rows,
    ]
    return [n, chars, symbols, dup_lines, repeats], features


# -- trees ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Trees:
    """Nodes of all trees in one row of arrays; a leaf leads to itself."""

    roots: np.ndarray
    feature: np.ndarray
    threshold: np.ndarray
    left: np.ndarray
    right: np.ndarray
    value: np.ndarray
    depth: int
    bias: float

    def scores(self, rows: np.ndarray) -> np.ndarray:
        at = np.broadcast_to(self.roots, (len(rows), len(self.roots))).copy()
        which = np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            low = rows[which, self.feature[at]] <= self.threshold[at]
            at = np.where(low, self.left[at], self.right[at])
        total = self.value[at].sum(axis=1) + self.bias
        return 1 / (1 + np.exp(-np.clip(total, -500, 500)))


def _constant(bias: float) -> Trees:
    none = np.zeros(0, np.int64)
    return Trees(none, none, none.astype(float), none, none, none.astype(float), 0, bias)


def _bins(column: np.ndarray, n: int) -> np.ndarray:
    """Cut values; a row is at or below cut i if its bin is at most i."""
    cuts = np.unique(np.quantile(column, np.arange(1, n) / n, method="lower"))
    return cuts[cuts < column.max()]


def boost(
    rows: np.ndarray,
    target: np.ndarray,
    weight: np.ndarray,
    directions: np.ndarray,
    n_trees: int = 80,
    depth: int = 4,
    rate: float = 0.15,
    ridge: float = 1.0,
    least_hessian: float = 1.0,
    bins: int = 64,
) -> Trees:
    """Logistic boosting; ``directions`` is -1 for features on which scores may only fall, 1 rise, 0 free."""
    cuts = [_bins(rows[:, f], bins) for f in range(rows.shape[1])]
    binned = np.column_stack([np.searchsorted(c, rows[:, f], side="left") for f, c in enumerate(cuts)])
    share = float((weight * target).sum() / weight.sum())
    bias = float(np.log(share / (1 - share)))
    total = np.full(len(rows), bias)
    nodes: list[list[float]] = []  # feature, threshold, left, right, value
    roots = []

    def grow(members: np.ndarray, level: int, low: float, high: float) -> int:
        g, h = gradient[members], hessian[members]
        value = float(np.clip(-g.sum() / (h.sum() + ridge), low, high))
        number = len(nodes)
        nodes.append([0, np.inf, number, number, rate * value])
        best = _split(binned[members], g, h, level, low, high) if level else None
        if best is None:
            total[members] += rate * value
            return number
        feature, cut, middle = best
        goes_left = binned[members, feature] <= cut
        direction = directions[feature]
        left_range = (low, min(high, middle)) if direction > 0 else (max(low, middle), high) if direction < 0 else (low, high)
        right_range = (max(low, middle), high) if direction > 0 else (low, min(high, middle)) if direction < 0 else (low, high)
        left = grow(members[goes_left], level - 1, *left_range)
        right = grow(members[~goes_left], level - 1, *right_range)
        nodes[number] = [feature, cuts[feature][cut], left, right, 0.0]
        return number

    def _split(x, g, h, level, low, high):
        """Feature, bin and middle value of the split that gains most without turning a direction."""
        most, best = 1e-6, None
        everything = g.sum() ** 2 / (h.sum() + ridge)
        for feature in range(x.shape[1]):
            n = len(cuts[feature])
            if not n:
                continue
            gl = np.cumsum(np.bincount(x[:, feature], g, n + 1))[:-1]
            hl = np.cumsum(np.bincount(x[:, feature], h, n + 1))[:-1]
            gr, hr = g.sum() - gl, h.sum() - hl
            vl = np.clip(-gl / (hl + ridge), low, high)
            vr = np.clip(-gr / (hr + ridge), low, high)
            gain = -(2 * gl * vl + (hl + ridge) * vl**2 + 2 * gr * vr + (hr + ridge) * vr**2) - everything
            allowed = (hl >= least_hessian) & (hr >= least_hessian) & ((vr - vl) * directions[feature] >= 0)
            gain = np.where(allowed, gain, -np.inf)
            cut = int(gain.argmax())
            if gain[cut] > most:
                most, best = gain[cut], (feature, cut, float(vl[cut] + vr[cut]) / 2)
        return best

    for _ in range(n_trees):
        p = 1 / (1 + np.exp(-total))
        gradient, hessian = weight * (p - target), weight * p * (1 - p)
        roots.append(grow(np.arange(len(rows)), depth, -np.inf, np.inf))
    table = np.array(nodes, dtype=float).reshape(-1, 5)
    whole = table[:, [0, 2, 3]].astype(np.int64)
    return Trees(np.array(roots), whole[:, 0], table[:, 1], whole[:, 1], whole[:, 2], table[:, 4], depth, bias)


# -- on Spark ---------------------------------------------------------------------------


def fit(documents: DataFrame, labels: DataFrame, per_class: int = 4000, seed: int = 10) -> Trees:
    """Learns from the statistics of at most ``2 * per_class`` labelled documents outside the held-out fold."""
    sample = labelled_sample(labels, "quality", per_class, seed)

    def rows(batch: pa.RecordBatch) -> dict:
        made = [statistics(t)[1] for t in texts(batch)]
        return {
            "doc_id": batch.column("doc_id"),
            "label": batch.column("label"),
            "features": pa.array(made, pa.list_(pa.float64())),
        }

    chosen = documents.select("doc_id", text_bytes()).join(F.broadcast(sample), "doc_id")
    known = (
        map_arrow(chosen.select("doc_id", "label", "text"), rows, "doc_id long, label int, features array<double>")
        .groupBy("doc_id", "label")
        .agg(F.min("features").alias("features"))
        .orderBy("doc_id")
        .collect()
    )
    shares = {
        r["label"]: r["n"]
        for r in labels.where(F.col("quality").isin(0, 1) & ~held_out())
        .groupBy(F.col("quality").cast("int").alias("label"))
        .agg(F.count(F.lit(1)).alias("n"))
        .collect()
    }
    target = np.array([float(r["label"]) for r in known])
    if len(set(target)) < 2:
        return _constant(20.0)
    # Classes weigh as they do among all labels, at one a row on average.
    good = shares[1] / (shares[0] + shares[1])
    weight = np.where(target == 1, good / target.mean(), (1 - good) / (1 - target.mean()))
    directions = np.array([-1 if f in FALLING else 0 for f in FEATURES])
    return boost(np.array([r["features"] for r in known]), target, weight, directions)


def judge(
    documents: DataFrame,
    trees: Trees,
    least_words: int = 50,
    most_repeated: int = 50,
    threshold: float = 0.3,
) -> DataFrame:
    """Base statistics, base_failed, score and kept of every row.

    The base fails on fewer than ``least_words`` words or more than ``most_repeated``
    per cent of repeated words; of the others those with a score of at least
    ``threshold`` are kept.
    """

    def rows(batch: pa.RecordBatch) -> dict:
        made = [statistics(t) for t in texts(batch)]
        base = np.array([b for b, _ in made], dtype=np.int64)
        scores = trees.scores(np.array([f for _, f in made]))
        words, repeats = base[:, 0], base[:, 4]
        failed = (words < least_words) | (100 * repeats > most_repeated * words)
        return {
            "doc_id": batch.column("doc_id"),
            **{name: pa.array(base[:, i]) for i, name in enumerate(BASE)},
            "base_failed": pa.array(failed),
            "score": pa.array(scores),
            "kept": pa.array(~failed & (scores >= threshold)),
        }

    schema = "doc_id long, " + "".join(f"{n} long, " for n in BASE) + "base_failed boolean, score double, kept boolean"
    return map_arrow(documents.select("doc_id", text_bytes()), rows, schema)

"""Embedding whitening by mixed-precision eigenvectors of a distributed covariance.

Entries become integers, x = floor(64 c) + 1000000, so that the fit list (each distinct
x vector once), its size and its sums are exact whatever the partitioning.  Each
partition hands on one sum of the outer products of its centred vectors; the sums by
entry come to the driver as a matrix of d x d numbers, whatever the number of rows.
Its eigenvectors are found in float32 and corrected by Ogita and Aishima's iteration:
matrix products in extended precision give the error of orthogonality R and of
diagonality S, and from both a correction of the whole basis that squares the error.
Eigenvalues closer than the present error can resolve form a cluster, in which that
correction is not defined; the iteration then only keeps the cluster's span, and a small
eigenproblem within the span, shifted by the cluster's centre, turns its basis.

Rows are whitened in one pass, in which nothing is shuffled.  Only the fit list is: its
copies are combined before the shuffle, so a vector with a third of all rows is one row a
task, and it is written to the shared checkpoint folder for the three passes over it.

Defined results: a row whose vector is null, or holds a null, an entry that is not finite
or one of 2^50 or more, has no result; of vectors of several lengths only those of the most frequent
length (the smaller of equally frequent) take part, and empty vectors have no component;
rows that repeat each get their result, null ids too; a component without variance (only
one distinct vector, or dependent dimensions) has ``whitened`` null and stays out of
``identity_error``; a deviation beyond 64 bits is null; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapsewise.llm.common import map_arrow, on_workers, slices
from lapsewise.sources import stage

STEPS, SHIFT = 64, 1_000_000
#: Entries beyond are not told from infinite ones; 64 times them stay exact in a long.
HUGE = float(2**50)
SCHEMA = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: ``n`` fit vectors, their sums, and components by falling eigenvalue."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray  # (d, k): unit eigenvectors in columns
    values: np.ndarray  # (k,)
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        """x - S / n to double precision: whole parts are subtracted as integers."""
        whole, rest = _whole_and_rest(self.n, self.sums)
        return (x - whole).astype(np.float64) - rest / self.n

    def project(self, x: np.ndarray) -> np.ndarray:
        """Whitened coordinates; NaN where a component has no variance."""
        scale = np.where(self.varies(), np.sqrt(np.abs(self.values)), np.nan)
        return self.centred(x) @ self.vectors / scale

    def varies(self) -> np.ndarray:
        return self.values > 4 * len(self.sums) * np.finfo(float).eps * self.trace

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Exact sums over dimensions of (n x - S)^2."""
        whole, rest = _whole_and_rest(self.n, self.sums)
        y = x - whole
        most = self.n * (int(np.abs(y).max(initial=0)) + 1)
        if most * most * x.shape[1] >= 1 << 63:
            y = y.astype(object)
            rest = rest.astype(object)
        found = ((self.n * y - rest) ** 2).sum(axis=1)
        return [v if v < 1 << 63 else None for v in map(int, found)]


def _whole_and_rest(n: int, sums: tuple[int, ...]) -> tuple[np.ndarray, np.ndarray]:
    return np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)


# -- eigenvectors ---------------------------------------------------------------------


def _clusters(values: np.ndarray, apart: float) -> list[list[int]]:
    """Indices of values that lie in a chain of neighbours at most ``apart``, where more than one."""
    order = np.argsort(values)
    cuts = np.flatnonzero(np.diff(values[order]) > apart) + 1
    return [sorted(part.tolist()) for part in np.split(order, cuts) if len(part) > 1]


def eigenvectors(matrix: np.ndarray, rounds: int = 30) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of a symmetric matrix by falling value, refined from float32 to double.

    A vector's entry of largest size is positive.
    """
    d = len(matrix)
    scale = float(np.abs(matrix).max(initial=0.0))
    if not scale:
        return np.zeros(d), np.eye(d)
    a = matrix.astype(np.longdouble) / scale
    x = np.linalg.eigh(a.astype(np.float32))[1].astype(np.longdouble)
    eye, before = np.eye(d, dtype=np.longdouble), None
    for _ in range(rounds):
        r = eye - x.T @ x
        s = x.T @ a @ x
        values = np.diag(s) / (1 - np.diag(r))
        apart = 2 * (np.sqrt(((s - np.diag(values)) ** 2).sum()) + np.abs(values).max() * np.sqrt((r**2).sum()))
        gap = values[None, :] - values[:, None]
        far = np.abs(gap) > apart
        correction = np.where(far, (s + values[None, :] * r) / np.where(far, gap, 1), r / 2)
        x = x + x @ correction
        clusters = _clusters(values, apart)
        for held in clusters:
            basis = x[:, held]
            inner = basis.T @ (a @ basis - values[held].mean() * basis)
            inner = (inner + inner.T) / 2
            x[:, held] = basis @ np.linalg.eigh((inner / max(np.abs(inner).max(), 1e-300)).astype(np.float64))[1]
        # The next error is the square of this correction; clusters that no longer change are ties.
        if np.abs(correction).max() < 1e-10 and clusters == before:
            break
        before = clusters
    x = x + x @ (eye - x.T @ x) / 2
    values = np.einsum("ij,ij->j", x, a @ x)
    order = np.argsort(-values, kind="stable")
    x, values = x[:, order].astype(np.float64), (values[order] * scale).astype(np.float64)
    return values, x * np.where(np.take_along_axis(x, np.abs(x).argmax(axis=0)[None, :], 0) < 0, -1.0, 1.0)


# -- on Spark ---------------------------------------------------------------------------


def quantised(embeddings: DataFrame, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, x) of the rows that take part."""
    c = F.col("_v")
    known = embeddings.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("_v")).where(
        F.forall(c, lambda e: F.coalesce(F.abs(e) < HUGE, F.lit(False)))
    )
    n = F.size(c)
    most = known.groupBy(n.alias("d")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "d").first()
    rows = known.where(n == (most["d"] if most else 0))
    return rows.select("vec_id", F.transform(c, lambda e: F.floor(e * STEPS) + SHIFT).alias("x"))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    held = batch.column("x")
    return held.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(held), -1)


def _summed(vectors: DataFrame, terms: Callable[[np.ndarray], np.ndarray], kind: str) -> dict[int, object]:
    """Sums of ``terms``, an array of bounded size for each block of vectors, by their place in it.

    Each partition hands on one array; places are summed across partitions after the shuffle.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in slices(batches):
            if batch.num_rows:
                made = terms(_matrix(batch)).ravel()
                total = made if total is None else total + made
        if total is not None:
            yield pa.RecordBatch.from_pydict({"place": pa.array(np.arange(len(total))), "value": pa.array(total)})

    parts = on_workers(vectors).mapInArrow(run, f"place long, value {kind}")
    wide = F.col("value").cast("decimal(38,0)" if kind == "long" else "double")
    return {r["place"]: r["total"] for r in parts.groupBy("place").agg(F.sum(wide).alias("total")).collect()}


def _ordered(total: dict[int, object]) -> list:
    return [total[i] for i in range(len(total))]


def fit(fit_list: DataFrame, k: int = 16) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` of one length; None if there are none."""

    def parts_of(x: np.ndarray) -> np.ndarray:
        # Halves of the numbers, so that no sum of a partition leaves 64 bits.
        return np.concatenate([[len(x)], (x >> 32).sum(axis=0), (x & 0xFFFFFFFF).sum(axis=0)]).astype(np.int64)

    total = [int(v) for v in _ordered(_summed(fit_list, parts_of, "long"))]
    if len(total) < 3:
        return None
    n, d = total[0], len(total) // 2
    sums = tuple((high << 32) + low for high, low in zip(total[1 : 1 + d], total[1 + d :]))
    centre = Whitening(n, sums, np.zeros((d, 0)), np.zeros(0), 0.0)
    upper = np.triu_indices(d)

    def outer(x: np.ndarray) -> np.ndarray:
        y = centre.centred(x)
        return (y.T @ y)[upper]

    matrix = np.zeros((d, d))
    matrix[upper] = _ordered(_summed(fit_list, outer, "double"))
    matrix = (matrix + np.triu(matrix, 1).T) / n
    values, vectors = eigenvectors(matrix)
    return Whitening(n, sums, vectors[:, :k].copy(), values[:k], float(np.trace(matrix)))


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """The largest entry, by size, of the whitened fit list's covariance less the identity."""
    varies = model.varies()
    k = int(varies.sum())
    if not k:
        return 0.0

    def moments(x: np.ndarray) -> np.ndarray:
        w = model.project(x)[:, varies]
        return np.concatenate([w.sum(axis=0), (w.T @ w).ravel()])

    total = np.array(_ordered(_summed(fit_list, moments, "double"))) / model.n
    covariance = total[k:].reshape(k, k) - np.outer(total[:k], total[:k])
    return float(np.abs(covariance - np.eye(k)).max())


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """vec_id, component, deviation, whitened and explained of every row (vec_id, x) and component."""
    k = len(model.values)
    explained = model.values / model.trace if model.trace else np.zeros(k)

    def made(batch: pa.RecordBatch) -> dict:
        x = _matrix(batch)
        at = pa.array(np.repeat(np.arange(len(x)), k))
        return {
            "vec_id": batch.column("vec_id").take(at),
            "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
            "deviation": pa.array(model.deviations(x), pa.int64()).take(at),
            "whitened": pa.array(model.project(x).ravel(), from_pandas=True),
            "explained": pa.array(np.tile(explained, len(x))),
        }

    schema = "vec_id long, component int, deviation long, whitened double, explained double"
    return map_arrow(rows, made, schema, 1 << 20)


def whitening_report(embeddings: DataFrame, k: int = 16, vector: str = "embedding", key: str = "vec_id") -> DataFrame:
    """``SCHEMA`` for every row that takes part and each of its first ``k`` components."""
    rows = quantised(embeddings, vector, key)
    fit_list = stage(rows.select("x").distinct(), "fit-list")
    model = fit(fit_list, k)
    if model is None:
        return embeddings.sparkSession.createDataFrame([], SCHEMA)
    found = whiten(rows, model)
    return found.select(
        "vec_id",
        "component",
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        "explained",
        F.lit(identity_error(fit_list, model)).alias("identity_error"),
    )

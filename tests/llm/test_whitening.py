import math

import corpus
import numpy as np
import pyarrow as pa
import pytest

from lapsewise.llm import whitening


def vectors(spark, rows, **extra):
    """Rows (vec_id, embedding), with columns whose names the operator uses inside."""
    table = {"vec_id": pa.array([i for i, _ in rows], pa.int64())}
    table["embedding"] = pa.array([v for _, v in rows], pa.list_(pa.float32()))
    for name in ("x", "_v", "n", "component", "place", "value"):
        table[name] = pa.array([name] * len(rows), pa.string())
    return spark.createDataFrame(pa.table(table))


def plain(rows, k=16):
    """{(vec_id, component): (n, deviation, |whitened|, explained)} by whole numbers and numpy.linalg."""
    kept = [(i, v) for i, v in rows if v and all(e is not None and math.isfinite(e) for e in v)]
    xs = [[math.floor(64 * float(np.float32(e))) + 1000000 for e in v] for _, v in kept]
    held = sorted(set(map(tuple, xs)))
    n, sums = len(held), [sum(c) for c in zip(*held)]
    centred = np.array([[(n * e - s) / n for e, s in zip(x, sums)] for x in held])
    cov = centred.T @ centred / n
    values, basis = np.linalg.eigh(cov)
    order = np.argsort(-values)
    values, basis = values[order], basis[:, order]
    out = []
    for (i, _), x in zip(kept, xs):
        y = [n * e - s for e, s in zip(x, sums)]
        w = np.array([e / n for e in y]) @ basis
        for c in range(min(k, len(values))):
            out.append((i, c + 1, n, sum(e * e for e in y), abs(w[c]) / math.sqrt(values[c]), values[c] / values.sum()))
    return sorted(out, key=str), cov


def check(df, rows, tolerance=1e-9):
    got = sorted(((r["vec_id"], r["component"], r["n"], r["deviation"], abs(r["whitened"]), r["explained"]) for r in df.collect()), key=str)
    want, _ = plain(rows)
    assert [g[:4] for g in got] == [w[:4] for w in want]
    assert np.allclose([g[4] for g in got], [w[4] for w in want], rtol=0, atol=tolerance)
    assert np.allclose([g[5] for g in got], [w[5] for w in want], rtol=1e-9)


def drawn(n, d, seed=0):
    draw = np.random.default_rng(seed)
    return (draw.normal(size=(n, d)) @ draw.normal(size=(d, d)) / 8).astype(np.float32)


def test_given_embeddings(spark):
    table = spark.read.parquet(f"{corpus.SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in table.collect()]
    report = whitening.whitening_report(table)
    assert report.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(report, rows)
    errors = {r[0] for r in report.select("identity_error").distinct().collect()}
    assert len(errors) == 1 and errors.pop() < 1e-9


def test_awkward_rows(spark):
    made = drawn(60, 5).tolist()
    rows = [(i, v) for i, v in enumerate(made)]
    rows += [(None, made[0]), (3, made[3]), (70, made[3]), (71, made[3])]  # null id, the same row again, copies
    rows += [(80, None), (81, []), (82, [1.0, None, 0.0, 0.0, 0.0]), (83, [float("nan")] + [0.0] * 4), (84, [float("inf")] + [0.0] * 4)]
    rows += [(90, [0.0] * 5), (91, [100.0, 0.0, 0.0, -100.0, 0.5])]
    check(whitening.whitening_report(vectors(spark, rows)), rows, 1e-7)
    other = rows + [(95, [1.0, 2.0])]  # a length that few rows have
    check(whitening.whitening_report(vectors(spark, other)), rows, 1e-7)


def test_no_rows_and_no_variance(spark):
    assert whitening.whitening_report(vectors(spark, [])).count() == 0
    assert whitening.whitening_report(vectors(spark, [(1, None), (2, [])])).count() == 0
    same = whitening.whitening_report(vectors(spark, [(1, [0.5, 0.25]), (2, [0.5, 0.25])])).collect()
    assert [(r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in same] == [(1, 0, None, 0.0, 0.0)] * 4
    flat = whitening.whitening_report(vectors(spark, [(i, [float(i), float(i)]) for i in range(4)])).collect()
    assert {(r["component"], r["whitened"] is None) for r in flat} == {(1, False), (2, True)}
    assert max(r["identity_error"] for r in flat) < 1e-9


def test_deviation_is_exact_or_null(spark):
    rows = [(i, [float(2**35 * (i - 1)), 1.0]) for i in range(3)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitening_report(vectors(spark, rows), k=1).collect()}
    assert got == {0: None, 1: 0, 2: None}
    rows = [(i, [float(2**20 * (i - 1)), 1.0]) for i in range(3)]
    got = {r["vec_id"]: r["deviation"] for r in whitening.whitening_report(vectors(spark, rows), k=1).collect()}
    assert got == {0: 9 * 2**52, 1: 0, 2: 9 * 2**52}


def test_partitions_do_not_matter(spark):
    rows = [(i, v) for i, v in enumerate(drawn(500, 12, 3).tolist())] * 3
    check(whitening.whitening_report(vectors(spark, rows).repartition(17)), rows)


def spectrum(values, seed=0):
    q = np.linalg.qr(np.random.default_rng(seed).normal(size=(len(values),) * 2))[0].astype(np.longdouble)
    q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    q = q + q @ (np.eye(len(values)) - q.T @ q) / 2
    a = (q * np.array(values, np.longdouble)) @ q.T
    return ((a + a.T) / 2).astype(np.float64), q.astype(np.float64)


@pytest.mark.parametrize(
    "values",
    [
        np.linspace(1, 2, 40),
        [1, 1 + 1e-6, 1 + 2e-6, 2, 3],
        [1, 1 + 1e-9, 1 + 2e-9, 5, 5 + 1e-8, 9],
        [1, 1, 1, 2, 2, 7],
        [1] * 9,
        [1e6, 1e3, 1, 1e-3, 1.1e-3, 1e-4],
        [4, 0, 0, 0],
    ],
)
def test_eigenvectors(values):
    a, q = spectrum(values)
    found, x = whitening.eigenvectors(a)
    want = np.sort(np.asarray(values, float))[::-1]
    top = want[0]
    assert np.allclose(found, want, rtol=0, atol=4e-15 * top * len(values))
    assert np.abs(x.T @ x - np.eye(len(values))).max() < 1e-15 * 4
    assert np.abs(a @ x - x * found).max() < 1e-15 * 8 * top
    # Vectors of eigenvalues that stand apart are those of the spectrum.
    q = q[:, np.argsort(-np.asarray(values, float), kind="stable")]
    for i, v in enumerate(want):
        gap = np.abs(np.delete(want, i) - v).min()
        if gap > 0:
            assert min(np.abs(x[:, i] - q[:, i]).max(), np.abs(x[:, i] + q[:, i]).max()) < 1e-14 * top / gap
    assert (x[np.abs(x).argmax(axis=0), range(len(values))] > 0).all()


def test_refinement_beats_its_start():
    a, q = spectrum(np.linspace(1, 2, 30))
    start = np.linalg.eigh(a.astype(np.float32))[1][:, ::-1]
    refined = whitening.eigenvectors(a)[1]
    q = q[:, ::-1]

    def wrong(x):
        return np.abs(np.abs(np.sum(x * q, axis=0)) - 1).max() + np.abs(np.abs(x) - np.abs(q)).max()

    assert wrong(refined) < 1e-13 < 1e-7 < wrong(start)

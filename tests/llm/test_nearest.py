import itertools

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from lapsewise.llm import nearest

SMALL = "/root/testdata/sf0.01"


def table(spark, rows):
    ids, vectors = zip(*rows) if rows else ((), ())
    made = pa.table({
        "vec_id": pa.array(ids, pa.int64()),
        "embedding": pa.array(vectors, pa.list_(pa.float32())),
        "label": pa.array([1] * len(ids), pa.int32()),
        "score": pa.array([0.0] * len(ids)),
        "bucket": pa.array(["b"] * len(ids)),
    })
    return spark.createDataFrame(made)


def plain(rows, queries, k):
    """{query: [(distance, id)]}, nearest first, ties to the smaller id."""
    known = {
        i: np.array(v, dtype=np.float32).astype(float)
        for i, v in rows
        if v is not None and None not in v and np.isfinite(v).all() and np.any(v)
    }
    out = {}
    for q in queries:
        if q in known:
            far = [(float(np.sqrt(((known[q] - v) ** 2).sum())), i) for i, v in known.items() if i != q]
            out[q] = sorted(far)[:k]
    return out


def found(df):
    out = {}
    for r in df.orderBy("query_id", "rank").collect():
        out.setdefault(r["query_id"], []).append((r["score"], r["vec_id"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_on_given_vectors(spark):
    df = spark.read.parquet(f"{SMALL}/embeddings.parquet")
    rows = [(r["vec_id"], r["embedding"]) for r in df.collect()]
    want = plain(rows, [i for i, _ in rows if i % 20 == 0], 10)
    got = found(nearest.search(df, F.col("vec_id") % 20 == 0))
    assert got.keys() == want.keys()
    exact = {(q, i): s for q in want for s, i in plain(rows, [q], len(rows))[q]}
    assert all(s == pytest.approx(exact[q, i], abs=1e-12) for q in got for s, i in got[q])
    assert all(len(pairs) == 10 and pairs == sorted(pairs) for pairs in got.values())
    hits = [len({i for _, i in want[q]} & {i for _, i in got[q]}) for q in want]
    assert np.mean(hits) >= 9


def test_unusable_vectors_and_repeats(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(4).tolist()) for i in range(40)]
    rows += [(100, None), (200, [0.0] * 4), (300, [1.0, None, 0.0, 0.0]), (400, [float("nan"), 1, 1, 1]), (500, [float("inf"), 1, 1, 1]), (600, [])]
    rows += [(700, [1.0, 2.0]), rows[0], (None, rows[1][1])]
    got = found(nearest.search(table(spark, rows), F.col("vec_id") % 100 == 0, k=5, recall=1.0))
    want = plain([r for r in rows if r[0] not in (None, 600, 700)], [0, 100, 200], 5)
    assert list(got) == [0] and [i for _, i in got[0]] == [i for _, i in want[0]]


def test_very_many_equal_vectors(spark):
    rows = [(i, [1.0, 1.0, 0.0]) for i in range(300)] + [(1000 + i, [1.0, 1.0 + i, 0.5]) for i in range(20)]
    got = found(nearest.search(table(spark, rows), F.col("vec_id") % 50 == 0, k=10, chunk=16, group=64, visit_group=5))
    for query, pairs in got.items():
        if query < 300:
            assert pairs == [(0.0, i) for i in range(11) if i != query][:10]
    assert set(got) == {*range(0, 300, 50), 1000}


def test_small_parts_and_groups_lose_nothing(spark):
    rng = np.random.default_rng(2)
    rows = [(i, (rng.standard_normal(6) * 0.05 + 1).tolist()) for i in range(200)]
    options = {"k": 3, "recall": 1.0, "sample": 50}
    whole = found(nearest.search(table(spark, rows), F.col("vec_id") % 10 == 0, **options))
    parts = found(nearest.search(table(spark, rows), F.col("vec_id") % 10 == 0, chunk=8, group=30, visit_group=7, **options))
    assert whole == parts


def test_few_rows(spark):
    rows = [(0, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [3.0, 0.0])]
    got = found(nearest.search(table(spark, rows), F.col("vec_id") == 0, k=10))
    assert [i for _, i in got[0]] == [1, 2]
    assert nearest.search(table(spark, rows[:1]), F.col("vec_id") == 0).count() == 0
    assert nearest.search(table(spark, []), F.col("vec_id") == 0).count() == 0


def test_outliers_are_searched_exactly(spark):
    """A query whose buckets hold no one else still gets its ten."""
    rng = np.random.default_rng(3)
    rows = [(i, rng.standard_normal(8).tolist()) for i in range(1, 150)] + [(0, [1000.0] * 8)]
    got = found(nearest.search(table(spark, rows), F.col("vec_id") == 0, recall=0.5, sample=20))
    assert [i for _, i in got[0]] == [i for _, i in plain(rows, [0], 10)[0]]


@pytest.mark.parametrize("radius", [0.0, 0.3, 1.5, 4.0])
def test_probes_come_in_order_and_miss_none(radius):
    at = np.random.default_rng(5).uniform(-3, 3, 4)
    home = np.floor(at)

    def cost(cell):
        return float((np.maximum(np.maximum(cell - at, at - cell - 1), 0) ** 2).sum())

    visited = list(nearest.probes(at, radius))
    costs = [cost(c) for c in visited]
    assert costs == pytest.approx(sorted(costs)) and costs[0] == 0
    around = (home + np.array(move) for move in itertools.product(range(-4, 5), repeat=4))
    want = {tuple(c) for c in around if cost(c) <= radius}
    assert {tuple(c) for c in visited} == want and len(visited) == len(want)

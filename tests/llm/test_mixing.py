import random
import re
from collections import Counter, defaultdict

import corpus
import numpy as np
import pytest
from local import frame

from lapsewise.llm import mixing


def sums(sizes, counts):
    reached = {0}
    for s, n in zip(sizes, counts):
        reached = {r + s * k for r in reached for k in range(n + 1)}
    return reached


@pytest.mark.parametrize("seed", range(25))
def test_nearest_subset_sum(seed):
    """With everything left to the exact part, the sum is the nearest that can be reached."""
    draw = random.Random(seed)
    sizes = np.array(draw.sample(range(1, 60), draw.randint(1, 6)))
    counts = np.array([draw.randint(1, 4) for _ in sizes])
    budget = draw.randint(0, int((sizes * counts).sum()) + 5)
    taken = mixing.fit_counts(sizes, counts, budget)
    assert ((taken >= 0) & (taken <= counts)).all()
    assert int((taken * sizes).sum()) == max(s for s in sums(sizes.tolist(), counts.tolist()) if s <= budget)


@pytest.mark.parametrize("reserve", [0, 50, 1000])
def test_large_budgets_are_hit(reserve):
    draw = random.Random(reserve)
    sizes = np.array(draw.sample(range(1, 5000), 800))
    counts = np.array([draw.randint(1, 9) for _ in sizes])
    budget = int((sizes * counts).sum() * 0.37)
    taken = mixing.fit_counts(sizes, counts, budget, reserve)
    assert ((taken >= 0) & (taken <= counts)).all()
    assert 0 <= budget - int((taken * sizes).sum()) <= (0 if reserve == 1000 else 60)


def plain_targets(sizes, weights=(3, 1, 2), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    free, done = set(names), {}
    while free:
        level = (share * sum(sizes.values()) - sum(done.values())) / sum(weight[s] for s in free)
        over = [s for s in free if level * weight[s] > most * sizes[s]]
        if not over:
            return done | {s: level * weight[s] for s in free}
        for s in over:
            done[s] = most * sizes[s]
            free.discard(s)
    return done


def check(df):
    rows = df.collect()
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", r["text"] or "")) for r in rows]
    total = defaultdict(int)
    for r, n in zip(rows, size):
        total[r["source"]] += n
    target = plain_targets(total)
    mixed = mixing.mix(df).collect()
    assert sorted(((r["doc_id"], n, r["source"]) for r, n in zip(rows, size)), key=str) == sorted(
        ((r["doc_id"], r["size"], r["source"]) for r in mixed), key=str
    )
    taken, lengths = Counter(), defaultdict(set)
    for r in mixed:
        assert r["source_size"] == total[r["source"]]
        assert r["target"] == pytest.approx(target[r["source"]])
        assert r["taken"] in (0, r["size"], 2 * r["size"]) and r["taken"] == r["copies"] * r["size"]
        taken[r["source"]] += r["taken"]
        lengths[r["source"]].add(r["size"])
    for source, words in taken.items():
        assert words <= target[source] + 1e-6
        assert target[source] - words <= max(lengths[source])
    return mixed


def test_given_documents(spark):
    df = spark.read.parquet(f"{corpus.SMALL}/documents.parquet")
    first = check(df)
    again = mixing.mix(df.repartition(5)).collect()
    assert sorted(map(tuple, first)) == sorted(map(tuple, again))


@pytest.mark.parametrize("seed", range(4))
def test_targets_with_caps(spark, seed):
    draw = random.Random(seed)
    sources = [draw.choice(["", "Z", "a", "é", "中", None, "b"]) for _ in range(80)]
    texts = ["w " * draw.choice([0, 1, 5, 60, 400]) * (1 + (s == "a")) for s in sources]
    check(frame(spark, corpus.rows(texts, None, sources), corpus.DDL))


def test_one_length_with_very_many_documents(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MANY", 8)
    texts = ["five words in each text"] * 300 + ["two words"] * 3 + ["other text of five words"] * 20
    df = frame(spark, corpus.rows(texts, None, ["a"] * 303 + ["b"] * 20), corpus.DDL)
    first = check(df)
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mix(df.repartition(3)).collect()))
    monkeypatch.setattr(mixing, "MANY", 4096)
    assert sorted(map(tuple, first)) == sorted(map(tuple, mixing.mix(df).collect()))


def test_awkward_rows(spark):
    df = corpus.awkward(spark)
    mixed = check(df)
    kept = mixing.take(df)
    assert kept.columns == df.columns
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in mixed for _ in range(r["copies"]))


def test_empty_table(spark):
    assert mixing.mix(corpus.empty(spark)).count() == 0
    assert mixing.take(corpus.empty(spark)).count() == 0


def test_no_words(spark):
    rows = mixing.mix(frame(spark, corpus.rows([None, "", " "]), corpus.DDL)).collect()
    assert [(r["target"], r["taken"]) for r in rows] == [(0.0, 0)] * 3


def test_options(spark):
    with pytest.raises(ValueError):
        mixing.mix(corpus.empty(spark), share=2.5)

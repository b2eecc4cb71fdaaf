import math
import random
from datetime import datetime, timedelta

import pytest
from local import frame
from pyspark.sql import functions as F

from lapsewise import BuildConfig
from lapsewise.operators import cut_after, cuts_after, nth_smallest
from lapsewise.plans.splits import class_train_counts, dataset_metadata, stratified_split, time_split
from lapsewise.sources import read_split, write_splits

CFG = BuildConfig(as_of=datetime(2024, 6, 30).date())
T0 = datetime(2024, 1, 1, 12, 30, 15, 123456)
SCHEMA = f"customer_id bigint, label_timestamp timestamp_ntz, {CFG.label_column} bigint"


def table(spark, rows):
    return frame(spark, rows, SCHEMA).repartition(4)


def expected(rows, train=0.7, valid=0.15):
    rows = sorted(rows, key=lambda r: (r[1], r[0]))
    a, b = int(len(rows) * train), int(len(rows) * (train + valid))
    names = ["train"] * a + ["valid"] * (b - a) + ["test"] * (len(rows) - b)
    return {(r[0], r[1]): s for r, s in zip(rows, names)}


def got(df):
    rows = df.collect()
    parts = {(r["customer_id"], r["label_timestamp"]): r["split"] for r in rows}
    assert len(parts) == len(rows)
    return parts


@pytest.mark.parametrize("n", [1, 2, 7, 90, 201])
def test_positions(spark, n):
    rng = random.Random(n)
    rows = [(i, T0 + timedelta(microseconds=rng.randrange(10**13)), i % 2) for i in range(n)]
    assert got(time_split(table(spark, rows))) == expected(rows)
    if n == 90:
        assert list(expected(rows).values()).count("train") == 62


def test_one_time_for_all_rows(spark):
    rows = [(i * 37 % 1000, T0, 0) for i in range(100)]
    assert got(time_split(table(spark, rows))) == expected(rows)


def test_a_third_of_the_rows_on_one_day_across_the_cut(spark):
    rows = [(i, T0 + timedelta(days=i % 20), 0) for i in range(200)]
    rows += [(1000 + i, T0 + timedelta(days=15), 0) for i in range(100)]
    assert got(time_split(table(spark, rows))) == expected(rows)


def test_ties_need_a_key(spark):
    rows = [(1, T0, 0)] * 10
    with pytest.raises(ValueError, match="tie"):
        time_split(table(spark, rows))


def test_empty(spark):
    assert time_split(table(spark, [])).isEmpty()


@pytest.mark.parametrize("bins", [2, 16, 4096])
def test_nth_smallest(spark, bins):
    rng = random.Random(bins)
    values = [rng.choice([5, rng.randrange(-(10**12), 10**12)]) for _ in range(300)]
    df = frame(spark, [(v,) for v in values], "v bigint")
    ranked = sorted(values)
    for rank in (1, 2, 150, 151, 299, 300):
        value, below = nth_smallest(df, "v", rank, bins)
        assert value == ranked[rank - 1] and below == sum(v < value for v in values)


def test_cut_includes_exactly_the_first_rows(spark):
    rows = [(a, b) for a in range(3) for b in range(50)]
    df = frame(spark, rows, "a bigint, b bigint")
    for rank in (0, 1, 49, 50, 51, 150):
        assert df.where(cut_after(df, ["a", "b"], rank).includes()).count() == rank


def test_stratified_shares_and_repeatability(spark):
    rows = [(i, T0 + timedelta(days=i % 9), 1 if i % 10 else 0) for i in range(503)]
    df = table(spark, rows)
    first, again = got(stratified_split(df, CFG.label_column)), got(stratified_split(df, CFG.label_column))
    other = got(stratified_split(df, CFG.label_column, seed=7))
    assert first == again and first != other
    label = {(r[0], r[1]): r[2] for r in rows}
    counts = {c: sum(v == c for v in label.values()) for c in (0, 1)}
    train = class_train_counts(counts, 0.2)
    assert sum(train.values()) == 503 - math.ceil(0.2 * 503)
    for c in counts:
        assert sum(first[k] == "train" for k in label if label[k] == c) == train[c]


def test_metadata_and_files(spark, tmp_path):
    rows = [(i, T0 + timedelta(days=i), int(i % 4 > 0)) for i in range(40)]
    parts = time_split(table(spark, rows))
    meta = dataset_metadata(parts, CFG).first()
    assert (meta["train_samples"], meta["valid_samples"], meta["test_samples"]) == (28, 6, 6)
    assert meta["total_samples"] == 40 and meta["train_positive_rate"] == 0.75
    assert meta["columns"] == ["customer_id", "label_timestamp", CFG.label_column]
    write_splits(parts, str(tmp_path / "data"))
    whole = [r for s in ("train", "valid", "test") for r in read_split(spark, str(tmp_path / "data"), s).collect()]
    assert len(whole) == 40 and {r["customer_id"] for r in whole} == set(range(40))
    with pytest.raises(FileNotFoundError):
        read_split(spark, str(tmp_path / "nothing"), "train")
    with pytest.raises(ValueError):
        read_split(spark, str(tmp_path / "data"), "holdout")
    assert parts.where(F.col("split").isNull()).isEmpty()


@pytest.mark.parametrize("settings", [{}, {"most": 50, "accuracy": 10}, {"most": 0, "accuracy": 1000, "bins": 3}, {"most": 20, "accuracy": 3, "bins": 2}])
def test_many_cuts_at_once(spark, settings):
    """Skewed, tied, negative and huge values, in groups of one to many rows, against a sort."""
    rng = random.Random(12)
    rows = []
    for group, n in ((0, 1), (1, 400), (2, 60), (3, 333)):
        values = [rng.choice([0, 7, -(2**62), 2**61 + rng.randrange(9), rng.randrange(-50, 50), int(rng.expovariate(1e-9))]) for _ in range(n)]
        rows += [(group, v, i % 5, i) for i, v in enumerate(values)]
    df = frame(spark, rows, "g bigint, a bigint, b bigint, c bigint").repartition(5)
    groups, ranked = [], []
    for group in range(4):
        held = sorted(r[1:] for r in rows if r[0] == group)
        ranks = sorted({0, 1, len(held) // 3, len(held) // 3 + 1, int(0.7 * len(held)), len(held) - 1, len(held)})
        groups.append((F.col("g") == group, len(held), ranks))
        ranked.append(held)
    for (condition, _, ranks), held, cuts in zip(groups, ranked, cuts_after(df, ["a", "b", "c"], groups, **settings)):
        for rank, cut in zip(ranks, cuts):
            before = {tuple(r) for r in df.where(condition & cut.includes()).select("a", "b", "c").collect()}
            assert before == set(held[:rank])


def test_cuts_take_two_passes_a_column(spark, monkeypatch):
    """However many groups and cuts; and ranks beyond a group's rows are refused."""
    df = spark.range(5000).selectExpr("id % 7 AS g", "hash(id) * 4294967296L + id AS a").repartition(4)
    groups = [(F.col("g") == g, df.where(f"g = {g}").count(), [10, 300, 500]) for g in range(7)]
    jobs, collect = [], type(df).collect
    monkeypatch.setattr(type(df), "collect", lambda self: jobs.append(1) or collect(self))
    cuts = cuts_after(df, ["a"], groups, most=200)
    assert len(jobs) == 2
    monkeypatch.undo()
    for (condition, _, ranks), found in zip(groups, cuts):
        assert [df.where(condition & c.includes()).count() for c in found] == ranks
    with pytest.raises(ValueError, match="exceeds"):
        cuts_after(df, ["a"], [(F.col("g") == 0, 10_000, [9_000])], most=200)
    with pytest.raises(ValueError, match="exceeds"):
        cuts_after(df, ["a"], [(F.col("g") == 0, 10_000, [9_000])])

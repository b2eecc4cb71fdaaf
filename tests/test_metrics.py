import random

import pytest
from local import frame

from lapsewise.operators import running_totals
from lapsewise.plans.metrics import evaluation_report, ranking_metrics, score_counts, threshold_metrics


def scored(spark, rows):
    return frame(spark, rows, "score double, label int")


def by_definition(rows):
    pos = [s for s, y in rows if y == 1]
    neg = [s for s, y in rows if y == 0]
    auc = None
    if pos and neg:
        auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap = 0.0
    for cut in sorted({s for s, _ in rows}, reverse=True):
        called = [y for s, y in rows if s >= cut]
        gained = sum(y for s, y in rows if s == cut)
        ap += gained / len(pos) * sum(called) / len(called) if pos else 0.0
    return auc, ap


def ranking(spark, rows):
    return tuple(ranking_metrics(score_counts(scored(spark, rows), "score", "label")).first())


def test_ties(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0)]
    auc, ap = ranking(spark, rows)
    assert auc == 0.875 and ap == pytest.approx(0.8333, abs=1e-4)


def test_one_class(spark):
    assert ranking(spark, [(0.1, 1), (0.2, 1), (0.3, 1)])[0] is None
    assert ranking(spark, [(0.1, 0), (0.2, 0)]) == (None, 0.0)


@pytest.mark.parametrize("seed", range(2))
def test_against_the_definition(spark, seed):
    rng = random.Random(seed)
    rows = [(rng.choice([0.5, rng.random(), round(rng.random(), 1)]), int(rng.random() < 0.8)) for _ in range(400)]
    auc, ap = ranking(spark, rows)
    want_auc, want_ap = by_definition(rows)
    assert auc == pytest.approx(want_auc, abs=1e-12) and ap == pytest.approx(want_ap, abs=1e-12)


@pytest.mark.parametrize("buckets", [1, 2, 16])
def test_running_totals_in_pieces(spark, buckets):
    rng = random.Random(buckets)
    keys = rng.sample(range(10000), 500)
    rows = [(float(k), rng.randrange(5), rng.randrange(5)) for k in keys]
    df = frame(spark, rows, "k double, a bigint, b bigint")
    got = {r["k"]: (r["a_upto"], r["b_upto"]) for r in running_totals(df, "k", ["a", "b"], buckets).collect()}
    for k, _, _ in rows:
        assert got[k] == (sum(r[1] for r in rows if r[0] >= k), sum(r[2] for r in rows if r[0] >= k))


def test_zero_denominators(spark):
    row = threshold_metrics(score_counts(scored(spark, [(0.1, 0), (0.2, 0)]), "score", "label")).first()
    assert tuple(row)[:4] == (1.0, 0.0, 0.0, 0.0)


def test_score_at_the_threshold_is_negative(spark):
    row = threshold_metrics(score_counts(scored(spark, [(0.5, 1), (0.6, 1)]), "score", "label")).first()
    assert row["recall"] == 0.5


def test_report(spark):
    rows = [(0.9, 1), (0.8, 0), (0.8, 1), (0.3, 0)]
    row = evaluation_report(scored(spark, rows), "score", "label", "valid").first()
    assert row["eval_samples"] == 4 and row["eval_split"] == "valid" and row["positive_rate"] == 0.5
    assert row["precision"] == pytest.approx(2 / 3) and row["recall"] == 1.0 and row["f1"] == pytest.approx(0.8)

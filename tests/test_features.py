import random
from datetime import date, timedelta

import pytest
from shop import DAY, Shop, features, labels, rows_of, training

from lapsewise import BuildConfig
from lapsewise.plans.features import features_from_sources
from lapsewise.plans.labels import churn_labels
from lapsewise.plans.training import training_set
from lapsewise.sources import completed_orders, label_date_spine

CFG = BuildConfig(as_of=date(2024, 6, 30))
D = date(2024, 3, 1)


def built(spark, shop, cfg):
    orders, items, products = shop.frames(spark)
    f = features_from_sources(orders, items, products, cfg)
    l = churn_labels(completed_orders(orders, cfg), cfg)
    return f, l


def check(spark, shop, cfg=CFG):
    """Features against their definition; returns the rows by (customer, day)."""
    f, _ = built(spark, shop, cfg)
    rows = rows_of(f)
    assert rows == features(shop, cfg)
    return {(r[0], r[1].date()): r for r in rows}


def check_training(spark, shop, cfg=CFG):
    """Labels and training set against their definitions."""
    f, l = built(spark, shop, cfg)
    want = labels(shop, cfg)
    assert rows_of(l) == want
    assert rows_of(training_set(l, f, cfg)) == training(want, features(shop, cfg))


def test_window_edges(spark):
    shop = Shop()
    shop.order(1, D, items=[(1, 10.0)])
    rows = check(spark, shop)
    assert rows[1, D][2:4] == (1, 1) and rows[1, D][-1] == 0
    assert rows[1, D + 29 * DAY][2:4] == (1, 1)
    assert rows[1, D + 30 * DAY][2:4] == (0, 1)
    assert rows[1, D + 89 * DAY][3] == 1
    gone = rows[1, D + 90 * DAY]
    assert gone[3] == 0 and gone[5] == 0 and gone[6] is None and gone[7:9] == (0, 0)
    assert (1, D - DAY) not in rows


def test_label_horizon(spark):
    for gap, churned in ((0, 1), (60, 0), (61, 1)):
        shop = Shop().order(1, D).order(1, D + gap * DAY).order(2, D + 90 * DAY)
        _, l = built(spark, shop, CFG)
        rows = rows_of(l)
        assert rows == labels(shop, CFG)
        assert {(r[0], r[1].date()): r[2] for r in rows}[1, D] == churned


def test_fanout_scales_counts_and_revenue(spark):
    shop = Shop()
    shop.order(1, D, items=[(1, 10.0), (2, 5.0)]).order(1, D + DAY, items=[(3, 1.0)])
    true = check(spark, shop)[1, D + DAY]
    wide = check(spark, shop, CFG.with_(fanout="reference"))[1, D + DAY]
    assert true[2:6] == (2, 2, 16.0, 16.0)
    assert wide[2:6] == (6, 6, 32.0, 32.0)
    assert true[7:] == wide[7:]


def test_order_without_items(spark):
    shop = Shop().order(1, D)
    for mode in ("corrected", "reference"):
        row = check(spark, shop, CFG.with_(fanout=mode))[1, D]
        assert row[2:7] == (1, 1, 0.0, 0.0, 0.0)


def test_single_order_single_item_is_the_same_in_both_modes(spark):
    shop = Shop().order(1, D, items=[(1, 2.5)])
    assert check(spark, shop) == check(spark, shop, CFG.with_(fanout="reference"))


def test_orders_after_the_last_snapshot_count_in_the_fanout_only(spark):
    shop = Shop().order(1, D, items=[(1, 3.0)])
    later = Shop().order(1, D, items=[(1, 3.0)]).order(1, CFG.as_of + DAY, items=[(2, 4.0)])
    assert check(spark, shop) == check(spark, later)
    wide = check(spark, later, CFG.with_(fanout="reference"))[1, D]
    assert wide[2] == 2 and wide[4] == 6.0


def test_item_dates_apart_from_their_order(spark):
    low = date(2023, 12, 30)  # lookback start of CFG
    shop = Shop()
    shop.order(1, low, items=[(1, 1.0, low - DAY), (2, 2.0, low + 5 * DAY)])
    shop.order(2, low - DAY, items=[(1, 4.0, low)])  # the order itself is out of reach
    shop.order(2, low + 9 * DAY, items=[(3, 8.0, low + 2 * DAY)])
    for mode in ("corrected", "reference"):
        check(spark, shop, CFG.with_(fanout=mode))


def test_status_nulls_and_unknown_products(spark):
    shop = Shop()
    shop.order(1, D, status="Cancelled", items=[(1, 9.0)])
    shop.order(None, D, items=[(1, 9.0)])
    shop.order(3, D, items=[(None, 1.0), (4, 2.0), (77, 3.0), (1, None)])
    for mode in ("corrected", "reference"):
        rows = check(spark, shop, CFG.with_(fanout=mode))
        assert {user for user, _ in rows} == {3}
    assert check(spark, shop)[3, D][7:9] == (3, 1)


def test_product_bought_again_before_and_after_it_expires(spark):
    shop = Shop()
    for gap in (0, 10, 99, 100, 101, 200):
        shop.order(1, date(2023, 12, 30) + gap % 180 * DAY, items=[(1, 1.0), (2, 1.0)])
    check(spark, shop)


def test_no_completed_orders(spark):
    shop = Shop().order(1, D, status="Returned", items=[(1, 1.0)])
    assert check(spark, shop) == {}
    check_training(spark, shop)


def test_order_range_shorter_than_the_horizon(spark):
    shop = Shop().order(1, D).order(2, D + 10 * DAY)
    orders, _, _ = shop.frames(spark)
    view = completed_orders(orders, CFG)
    assert label_date_spine(view, CFG).isEmpty()
    assert churn_labels(view, CFG).isEmpty()


def test_inactive_newest_snapshot_drops_the_label(spark):
    shop = Shop().order(1, date(2024, 1, 5)).order(2, date(2024, 6, 29))
    f, l = built(spark, shop, CFG)
    check_training(spark, shop)
    kept = {r[1].date() for r in training_set(l, f, CFG).collect() if r[0] == 1}
    assert max(kept) == date(2024, 1, 5) + 89 * DAY
    assert max(r[1].date() for r in l.collect() if r[0] == 1) > max(kept)


@pytest.mark.parametrize("step", [1, 7])
@pytest.mark.parametrize("mode", ["corrected", "reference"])
@pytest.mark.parametrize("seed", range(2))
def test_random_shops(spark, seed, mode, step):
    rng = random.Random(seed)
    cfg = BuildConfig(
        as_of=date(2024, 3, 31),
        lookback_months=2,
        churn_days=rng.choice([5, 20]),
        short_days=rng.choice([2, 5]),
        long_days=rng.choice([7, 20]),
        step_days=step,
        fanout=mode,
    )
    shop = Shop([(p, rng.choice(["a", "b", "c", None])) for p in range(1, 6)])
    start = date(2024, 1, 20)
    for _ in range(60):
        day = start + timedelta(days=rng.randrange(80))
        items = [
            (rng.choice([1, 2, 3, 4, 5, 6, None]), rng.choice([None, 0.0, rng.randrange(9999) / 100]),
             day + timedelta(days=rng.choice([0, 0, 0, -2, 3])))
            for _ in range(rng.randrange(4))
        ]
        status = rng.choice(["Complete"] * 4 + ["Cancelled"])
        # Half of all orders belong to one customer.
        shop.order(rng.choice([1, 1, 1, 2, 3, None]), day, status, items, hour=rng.randrange(24))
    check(spark, shop, cfg)
    if mode == "corrected":
        check_training(spark, shop, cfg)

"""Snapshots carried on from day to day, against a full build on every day."""

import random
from datetime import date

import pytest
from shop import DAY, ITEMS, ORDERS, PRODUCTS, Shop, features, rows_of
from local import frame

from lapsewise import BuildConfig
from lapsewise.plans import advance
from lapsewise.plans.advance import SnapshotHistory
from lapsewise.sources import completed_order_items, completed_orders

CFG = BuildConfig(as_of=date(2024, 6, 30), lookback_months=2, short_days=5, long_days=20)
FIRST = date(2024, 4, 1)


def arrived(spark, shop, before, cfg):
    """Views of what the shop has taken in since it had ``before`` orders and items."""
    n_orders, n_items = before
    orders = frame(spark, shop.orders[n_orders:], ORDERS)
    items = frame(spark, shop.items[n_items:], ITEMS)
    products = frame(spark, shop.products, PRODUCTS)
    # The views' own lookback is left to the history.
    wide = cfg.with_(lookback_months=30)
    return completed_orders(orders, wide), completed_order_items(items, orders, wide), products


def expected(shop, last, cfg):
    rows, day = set(), FIRST
    while day <= last:
        rows |= {r for r in features(shop, cfg.with_(as_of=day)) if r[1].date() == day}
        day += DAY
    return rows


def step(spark, history, shop, number, before, as_of, cfg=CFG):
    history.advance(f"daily-{number}", *arrived(spark, shop, before, cfg), as_of)
    return len(shop.orders), len(shop.items)


def test_every_day_equals_a_full_build(spark, tmp_path):
    """A day at a time, with orders of the past, the day and the future; also days without any."""
    draw = random.Random(8)
    shop, before = Shop(), (0, 0)
    history = SnapshotHistory(spark, str(tmp_path / "h"), CFG, FIRST)
    for _ in range(25):
        shop.order(draw.randint(1, 4), FIRST - draw.randint(1, 50) * DAY, items=[(draw.randint(1, 4), draw.randint(1, 9) / 4)])
    for number in range(9):
        day = FIRST + number * DAY
        for _ in range(draw.choice([0, 1, 3])):
            when = day - draw.choice([0, 0, 0, 1, 4, 19, -3]) * DAY
            status = draw.choice(["Complete"] * 5 + ["Cancelled"])
            items = [(draw.choice([None, 1, 2, 3, 4, 9]), draw.choice([None, 0.5, 20.25])) for _ in range(draw.randint(0, 3))]
            shop.order(draw.choice([1, 2, 3, 4, 5, None]), when, status, items)
        before = step(spark, history, shop, number, before, day)
        assert rows_of(history.read()) == expected(shop, day, CFG), day
        assert history.last() == day


def test_many_days_and_late_orders_at_once(spark, tmp_path):
    draw = random.Random(9)
    shop, before = Shop(), (0, 0)
    history = SnapshotHistory(spark, str(tmp_path / "h"), CFG, FIRST)
    ends = [FIRST + 3 * DAY, FIRST + 30 * DAY, FIRST + 30 * DAY, FIRST + 75 * DAY]
    for number, end in enumerate(ends):
        for _ in range(30):
            day = end - draw.randint(-5, 35) * DAY
            shop.order(draw.randint(1, 6), day, items=[(draw.randint(1, 4), draw.randint(1, 99) / 100, day - draw.randint(-2, 2) * DAY)])
        before = step(spark, history, shop, number, before, end)
        assert rows_of(history.read()) == expected(shop, end, CFG)


def test_replays_and_days_without_orders(spark, tmp_path):
    history = SnapshotHistory(spark, str(tmp_path / "h"), CFG, FIRST)
    with pytest.raises(LookupError):
        history.read()
    shop = Shop()
    before = step(spark, history, shop, 0, (0, 0), FIRST)
    assert history.read().isEmpty()
    shop.order(1, FIRST + DAY, items=[(1, 2.0)])
    step(spark, history, shop, 1, before, FIRST + DAY)
    step(spark, history, shop, 1, before, FIRST + DAY)  # again
    before = (len(shop.orders), len(shop.items))
    for number in (2, 3):
        before = step(spark, history, shop, number, before, FIRST + 40 * number * DAY)
    # The order has left the lookback, and so has the customer.
    assert rows_of(history.read()) == expected(shop, FIRST + 120 * DAY, CFG)
    assert history.read().where("feature_timestamp > '2024-07-10'").isEmpty()
    with pytest.raises(ValueError):
        step(spark, history, shop, 4, before, FIRST)


def test_many_parts_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(advance, "MOST_PARTS", 2)
    draw = random.Random(10)
    shop, before = Shop(), (0, 0)
    history = SnapshotHistory(spark, str(tmp_path / "h"), CFG, FIRST)
    for number in range(6):
        end = FIRST + 4 * number * DAY
        for _ in range(4):
            shop.order(draw.randint(1, 3), end - draw.randint(0, 9) * DAY, items=[(draw.randint(1, 4), 1.0)])
        before = step(spark, history, shop, number, before, end)
    assert rows_of(history.read()) == expected(shop, end, CFG)
    kinds = [p["kind"] for p in history.table.version().parts]
    assert kinds.count("facts") <= 4 and kinds.count("pending") <= 4 and kinds.count("running") == 1


def test_only_new_facts_and_state_are_read(spark, tmp_path):
    """The sources hold only what arrived, and a quiet day writes no facts and no corrections."""
    history = SnapshotHistory(spark, str(tmp_path / "h"), CFG, FIRST)
    shop = Shop()
    for user in range(50):
        shop.order(user, FIRST - 3 * DAY, items=[(1, 2.0)])
    before = step(spark, history, shop, 0, (0, 0), FIRST)
    was = {p["path"] for p in history.table.version().parts}
    step(spark, history, shop, 1, before, FIRST + DAY)
    made = [p for p in history.table.version().parts if p["path"] not in was]
    assert sorted(p["kind"] for p in made) == ["running", "snapshots"]
    shop.order(7, FIRST - DAY, items=[(2, 1.0)])
    step(spark, history, shop, 2, before, FIRST + 2 * DAY)
    rows = {p["kind"]: p["rows"] for p in history.table.version().parts if p["path"] not in was | {p["path"] for p in made}}
    # One customer's two past days are corrected: its row for each day, and no other.
    assert rows["corrections"] == 2 and rows["facts"] == 2 and rows["snapshots"] == 50


def test_what_cannot_be_carried_on_is_refused(spark, tmp_path):
    for changed in ({"fanout": "reference"}, {"step_days": 7}, {"long_days": 90}):
        with pytest.raises(ValueError):
            SnapshotHistory(spark, str(tmp_path / "h"), CFG.with_(**changed), FIRST)
